"""Growth accounting: daily and weekly user states, state counts, retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIVE_STATES = ("Retained", "Resurrected", "New")


def _daily_state(is_new: Column, today: Column, last: Column, yesterday: Column) -> Column:
    """``today`` is null when idle; ``last`` is the last active day before it."""
    day_before = F.date_sub(today, 1)
    return (
        F.when(is_new, "New")
        .when(last == day_before, "Retained")
        .when(last < day_before, "Resurrected")
        .when(today.isNull() & (last == yesterday), "Churned")
        .otherwise("Stale")
    )


def _weekly_state(
    is_new: Column, today: Column, last: Column, yesterday: Column, corrected: bool
) -> Column:
    if corrected:
        # Active within the seven days ending today, and ending yesterday.
        now = F.coalesce(today, last) > F.date_sub(yesterday, 6)
        before = last > F.date_sub(yesterday, 7)
        return (
            F.when(is_new, "New")
            .when(before & now, "Retained")
            .when(now, "Resurrected")
            .when(before, "Churned")
            .otherwise("Stale")
        )
    # As defined: a user idle today is retained for seven more days, after which
    # the state is already stale, so nobody is ever churned by week.
    return (
        F.when(is_new, "New")
        .when(last < F.date_sub(today, 7), "Resurrected")
        .when(last >= F.date_sub(yesterday, 7), "Retained")
        .otherwise("Stale")
    )


def growth_step(prev: DataFrame, today: DataFrame, corrected: bool = False) -> DataFrame:
    """Next day's table from yesterday's and the users active today."""
    t, y = today.alias("t"), prev.alias("y")
    day, last, yesterday = F.col("t.date_active"), F.col("y.last_active_date"), F.col("y.date")
    is_new = F.col("y.user_id").isNull()
    nothing = F.array().cast("array<date>")
    return t.join(y, F.col("y.user_id") == F.col("t.user_id"), "full_outer").select(
        F.coalesce("t.user_id", "y.user_id").alias("user_id"),
        F.coalesce("y.first_active_date", day).alias("first_active_date"),
        F.coalesce(day, last).alias("last_active_date"),
        _daily_state(is_new, day, last, yesterday).alias("daily_active_state"),
        _weekly_state(is_new, day, last, yesterday, corrected).alias("weekly_active_state"),
        F.concat(
            F.coalesce("y.dates_active", nothing),
            F.when(day.isNotNull(), F.array(day)).otherwise(nothing),
        ).alias("dates_active"),
        F.coalesce(day, F.date_add(yesterday, 1)).alias("date"),
    )


def _listed(active: DataFrame, end: date) -> DataFrame:
    """Each user's distinct days up to ``end``, at most one per calendar day."""
    return (
        active.where(F.col("date_active") <= F.lit(end))
        .groupBy("user_id")
        .agg(F.sort_array(F.collect_list("date_active")).alias("_days"))
    )


def growth_as_of(active: DataFrame, day: date, corrected: bool = False) -> DataFrame:
    """The table of one day, equal to the steps up to it; no other day is made."""
    users = _listed(active, day).select(
        "user_id",
        "_days",
        F.element_at("_days", 1).alias("first_active_date"),
        F.element_at("_days", -1).alias("last_active_date"),
        F.size("_days").alias("_i"),
        F.try_element_at("_days", F.lit(-2)).alias("_previous"),
        F.lit(day).alias("date"),
    )
    return _states(users, corrected)


def growth_backfill(active: DataFrame, end: date, corrected: bool = False) -> DataFrame:
    """Every day's table up to ``end`` in one pass, equal to the chained steps.

    Every active day covers the days up to the next one, so a day's state takes no
    search through the list.
    """
    spans = _listed(active, end).select(
        "user_id",
        "_days",
        F.element_at("_days", 1).alias("first_active_date"),
        F.posexplode("_days").alias("_i", "last_active_date"),
    )
    until = F.coalesce(
        F.date_sub(F.try_element_at("_days", F.col("_i") + 2), 1), F.lit(end)
    )
    previous = F.when(F.col("_i") > 0, F.element_at("_days", F.greatest("_i", F.lit(1))))
    spine = spans.withColumn("_previous", previous).withColumn(
        "date", F.explode(F.sequence("last_active_date", until))
    )
    return _states(spine.withColumn("_i", F.col("_i") + 1), corrected)


def _states(spine: DataFrame, corrected: bool) -> DataFrame:
    """Rows of users and days with their states.

    ``_i`` days of the list are past, the last of them ``last_active_date`` and the
    one before it ``_previous``.
    """
    is_active = F.col("date") == F.col("last_active_date")
    day = F.when(is_active, F.col("date"))
    last = F.when(is_active, F.col("_previous")).otherwise(F.col("last_active_date"))
    is_new, yesterday = F.col("date") == F.col("first_active_date"), F.date_sub("date", 1)
    states = (is_new, day, last, yesterday)
    return spine.select(
        "user_id",
        "first_active_date",
        "last_active_date",
        _daily_state(*states).alias("daily_active_state"),
        _weekly_state(*states, corrected).alias("weekly_active_state"),
        F.slice("_days", F.lit(1), F.col("_i")).alias("dates_active"),
        "date",
    )


def state_counts(growth: DataFrame) -> DataFrame:
    """Users per day and daily state."""
    return growth.groupBy("date", "daily_active_state").agg(
        F.count(F.lit(1)).alias("users")
    )


def retention(growth: DataFrame, first_active: date | None = None) -> DataFrame:
    """Active share of users by day and days since first active."""
    if first_active is not None:
        growth = growth.where(F.col("first_active_date") == F.lit(first_active))
    age = F.date_diff("date", "first_active_date").alias("days_since_first_active")
    active = F.count(F.when(F.col("daily_active_state").isin(*ACTIVE_STATES), 1))
    total = F.count(F.lit(1))
    return growth.groupBy("date", age).agg(
        active.alias("active_users"),
        total.alias("total_users"),
        (active.cast("double") / total * 100).alias("pct_active"),
    )


def activity_count(growth: DataFrame, day: date) -> DataFrame:
    """Rows per user on one day; more than one breaks the key."""
    return (
        growth.where(F.col("date") == F.lit(day))
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("activity_count"))
    )
