"""Cumulative lists of active dates, newest first, and their bit words."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import bits
from tidemark.functions.scalars import same_day


def active_days(
    events: DataFrame,
    keys: list[str],
    first: date | None = None,
    last: date | None = None,
    moment: str = "event_time",
) -> DataFrame:
    """Distinct keys and days with an event; rows with a null key are left out.

    The day range is a filter on the event time itself, so it reaches the scan.
    Copies and busy keys collapse before the shuffle, which is by key and day.
    """
    rows = events
    if first is not None:
        rows = rows.where(F.col(moment) >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col(moment) < F.date_add(F.lit(last), 1))
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows.select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.to_date(moment).alias("date_active"),
    ).distinct()


def browser_events(events: DataFrame, devices: DataFrame) -> DataFrame:
    """One browser, the greatest, per user and event time."""
    known = events.where(F.col("user_id").isNotNull())
    named = devices.where(F.col("browser_type").isNotNull())
    return (
        known.join(named, "device_id")
        .groupBy("user_id", "event_time")
        .agg(F.max("browser_type").alias("browser_type"))
    )


def datelist_step(
    prev: DataFrame, today: DataFrame, keys: list[str], dates: str
) -> DataFrame:
    """Next day's lists from yesterday's and the keys active today."""
    t, y = today.alias("t"), prev.alias("y")
    same_key = [F.col(f"y.{k}") == F.col(f"t.{k}") for k in keys]
    day, old = F.col("t.date_active"), F.col(f"y.{dates}")
    grown = (
        F.when(old.isNull(), F.array(day))
        .when(day.isNull(), old)
        .otherwise(F.concat(F.array(day), old))
    )
    return t.join(y, same_key, "full_outer").select(
        *[F.coalesce(F.col(f"t.{k}"), F.col(f"y.{k}")).alias(k) for k in keys],
        grown.alias(dates),
        F.coalesce(day, F.date_add("y.date", 1)).alias("date"),
    )


def datelist_through(active: DataFrame, keys: list[str], dates: str, day: date) -> DataFrame:
    """Lists as of ``day`` in one pass, equal to the steps from an empty start.

    ``active`` holds distinct days, so a list is no longer than the calendar.
    """
    return (
        active.where(F.col("date_active") <= F.lit(day))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("date_active"), asc=False).alias(dates))
        .withColumn("date", F.lit(day))
    )


def datelist_as_of(snapshot: DataFrame, dates: str, day: date) -> DataFrame:
    """An earlier day's lists, cut from a later snapshot without a shuffle."""
    return (
        snapshot.withColumn(dates, F.filter(dates, lambda d: d <= F.lit(day)))
        .where(F.size(dates) > 0)
        .withColumn("date", F.lit(day))
    )


def activity_bits(
    snapshot: DataFrame,
    keys: list[str],
    dates: str,
    first: date,
    last: date,
    combine: str = "sum",
    keep_today: bool = False,
    as_of: str = "date",
) -> DataFrame:
    """32-bit activity word per key with monthly, weekly and daily day counts.

    The list is folded into a number in place of a join with a date series.
    As defined, the bit of the as-of day falls outside the word; ``keep_today``
    moves every day down one bit. Rows of one key are summed, so two rows active
    on one day carry into the next bit; ``combine="or"`` unites them.
    """
    top = bits.WORD_BITS - 1 if keep_today else bits.WORD_BITS
    word = bits.datelist_word(F.col(dates), F.col(as_of), F.lit(first), F.lit(last), top)
    merge = F.bit_or if combine == "or" else F.sum
    words = snapshot.select(*keys, word.alias("_word")).groupBy(*keys).agg(
        bits.low_word(merge("_word")).alias("_word")
    )
    return words.select(
        *keys,
        bits.word_text(F.col("_word")).alias("activity_bits"),
        bits.active_days(F.col("_word")).alias("monthly_active"),
        bits.active_days(F.col("_word"), bits.WEEK_MASK).alias("weekly_active"),
        bits.active_days(F.col("_word"), bits.DAY_MASK).alias("daily_active"),
    )


def events_on(events: DataFrame, day: date, moment: str = "event_time") -> DataFrame:
    """Events of one day."""
    return events.where(same_day(F.col(moment), F.lit(day)))
