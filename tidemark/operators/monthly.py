"""Monthly facts reduced to arrays with one slot per calendar day.

The stored form, a calendar, has a row for each month and host: ``days``, a word
with a bit for each day of the month that was written, and for each measure an
array of 31 slots. A slot's place follows from its date and from nothing else, so
any day can be written or written again, before or after others or past a gap, and
neither moves nor loses another day's slot. ``month_arrays`` gives the arrays of
the written days alone, newest first.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 31
#: Stored arrays, and the measure each one keeps.
MEASURES = {"hits": "num_hits", "visitors": "unique_users"}


def month_of(day: Column) -> Column:
    """Year and month as one number."""
    return F.year(day) * 100 + F.month(day)


def host_day(
    hosts: DataFrame, day: date, dates: str = "host_activity_datelist"
) -> DataFrame:
    """Rows and distinct users per host that were active on the snapshot's day.

    Every host of the snapshot has a row, with zeros if nobody was active.
    """
    active = F.array_contains(dates, F.lit(day))
    return (
        hosts.where(F.col("date") == F.lit(day))
        .groupBy("host", "date")
        .agg(
            F.count(F.when(active, 1)).cast("int").alias("num_hits"),
            F.count_distinct(F.when(active, F.col("user_id"))).cast("int").alias("unique_users"),
        )
    )


def host_days(active: DataFrame, days: Sequence[date]) -> DataFrame:
    """As ``host_day`` for several days, in one pass over distinct users, hosts and days.

    From its first day on a host has a row for each of the days. The users of a host
    are counted per day first, so a host's list is no longer than the calendar.
    """
    counts = active.groupBy("host", "date_active").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    hosts = counts.groupBy("host").agg(
        F.min("date_active").alias("_first"),
        F.map_from_entries(F.collect_list(F.struct("date_active", "_n"))).alias("_users"),
    )
    asked = F.filter(
        F.array(*[F.lit(d) for d in sorted(set(days))]).cast("array<date>"),
        lambda d: d >= F.col("_first"),
    )
    # The snapshot has one row per user, so hits and users are the same number.
    users = F.coalesce(F.try_element_at("_users", F.col("date")), F.lit(0))
    return hosts.select("host", "_users", F.explode(asked).alias("date")).select(
        "host", "date", *[users.alias(m) for m in MEASURES.values()]
    )


def _bit(day: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), day - 1)


def _has(days: Column | str, slot: Column) -> Column:
    return F.call_function("getbit", days, slot) == 1


def calendar_of(counts: DataFrame) -> DataFrame:
    """Calendar rows of counts with one row per host and date."""
    measures = list(MEASURES.values())
    day = F.struct(F.dayofmonth("date"), F.struct(*measures))
    rows = counts.groupBy(month_of(F.col("date")).alias("month"), "host").agg(
        F.bit_or(_bit(F.dayofmonth("date"))).alias("days"),
        F.map_from_entries(F.collect_list(day)).alias("_by_day"),
    )

    def slots(array: str) -> Column:
        places = F.sequence(F.lit(1), F.lit(SLOTS))
        held = F.transform(places, lambda i: F.try_element_at("_by_day", i)[MEASURES[array]])
        return held.alias(array)

    return rows.select("month", "host", "days", *[slots(array) for array in MEASURES])


def write_days(
    calendar: DataFrame, counts: DataFrame, replaced: Sequence[date] = ()
) -> DataFrame:
    """Calendar rows changed by the counts of any days; upsert them by key.

    A slot that has a count is written, whether it was or not. ``replaced`` are days
    that the counts tell in full: hosts without a count lose their slot of those.
    Rows that nothing changes are not returned.
    """
    t, y = calendar_of(counts).alias("t"), calendar.alias("y")
    month = F.coalesce("t.month", "y.month")
    words: dict[int, int] = {}
    for d in replaced:
        key = d.year * 100 + d.month
        words[key] = words.get(key, 0) | 1 << d.day - 1
    cleared = F.lit(0)
    for key, word in words.items():
        cleared = F.when(month == key, F.lit(word)).otherwise(cleared)
    written = F.coalesce(F.col("t.days"), F.lit(0))
    kept = F.coalesce(F.col("y.days"), F.lit(0)).bitwiseAND(F.bitwise_not(cleared))
    kept = kept.bitwiseAND(F.bitwise_not(written))

    def slots(array: str) -> Column:
        new, old = F.col(f"t.{array}"), F.col(f"y.{array}")
        return F.transform(
            F.sequence(F.lit(0), F.lit(SLOTS - 1)),
            lambda i: F.when(_has(written, i), F.get(new, i)).when(_has(kept, i), F.get(old, i)),
        ).alias(array)

    same = (F.col("t.host") == F.col("y.host")) & (F.col("t.month") == F.col("y.month"))
    lost = F.col("y.days").bitwiseAND(cleared) != 0
    return (
        t.join(y, same, "full_outer")
        .where(F.col("t.host").isNotNull() | lost)
        .select(
            month.alias("month"),
            F.coalesce("t.host", "y.host").alias("host"),
            written.bitwiseOR(kept).alias("days"),
            *[slots(array) for array in MEASURES],
        )
    )


def calendar_through(active: DataFrame, day: date, first: date) -> DataFrame:
    """Calendar of all days from ``first`` to ``day`` in one pass.

    ``active`` has distinct users, hosts and days, none before ``first``.
    """
    days = [date.fromordinal(n) for n in range(first.toordinal(), day.toordinal() + 1)]
    return calendar_of(host_days(active.where(F.col("date_active") <= F.lit(day)), days))


def month_arrays(calendar: DataFrame, by_year: bool = False) -> DataFrame:
    """Each month's arrays with a slot for each written day, newest first.

    Without ``by_year`` the same month of every year shares one row, whose ``month``
    is its number alone.
    """
    names = {"hits": "hit_array", "visitors": "unique_visitors"}

    def told(array: str) -> Column:
        return F.reverse(F.filter(array, lambda _, i: _has(F.col("days"), i)))

    rows = calendar.where(F.col("days") != 0).select(
        "month", "host", *[told(array).alias(name) for array, name in names.items()]
    )
    if by_year:
        return rows
    year = F.struct("month", *names.values())
    years = rows.groupBy((F.col("month") % 100).alias("_month"), "host").agg(
        F.sort_array(F.collect_list(year), asc=False).alias("_years")
    )

    def flat(name: str) -> Column:
        return F.flatten(F.transform("_years", lambda y: y[name])).alias(name)

    return years.select(F.col("_month").alias("month"), "host", *map(flat, names.values()))
