"""Retention kept up to date: a matrix of cohorts by day, to which each day adds.

A cohort is the users of one first active day. What is kept of users is that day alone,
once for each user and never again; what is kept of days is a row for each cohort. A day
reads the cohorts of its own users and the matrix of the day before, no older activity.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cohorts_through(active: DataFrame, end: date) -> tuple[DataFrame, DataFrame]:
    """First days of users, and the matrix of all days up to ``end``, in one pass.

    ``active`` has one row a user and active day, no null in either.
    """
    past = active.where(F.col("date_active") <= F.lit(end))
    firsts = past.groupBy("user_id").agg(F.min("date_active").alias("first_active_date"))
    sizes = firsts.groupBy("first_active_date").agg(F.count(F.lit(1)).alias("total_users"))
    spine = sizes.withColumn(
        "date", F.explode(F.sequence("first_active_date", F.lit(end)))
    ).alias("s")
    hits = (
        past.join(firsts, "user_id")
        .groupBy("first_active_date", F.col("date_active").alias("date"))
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
    matrix = spine.join(hits, ["first_active_date", "date"], "left").select(
        "first_active_date", "date", F.coalesce("active_users", F.lit(0)).alias("active_users"),
        "total_users",
    )
    return firsts, matrix


def cohort_step(
    firsts: DataFrame, matrix: DataFrame, active: DataFrame, day: date
) -> tuple[DataFrame, DataFrame]:
    """Users whose first day this is, and the day's column of the matrix.

    ``firsts`` and ``matrix`` are those stored, ``active`` as in ``cohorts_through``. Only
    first days before ``day`` and the matrix of the day before are read, so a day may be
    made again; a change of its users makes the days after it due again as well.
    """
    today = active.where(F.col("date_active") == F.lit(day)).select("user_id").alias("t")
    known = firsts.where(F.col("first_active_date") < F.lit(day)).alias("k")
    met = today.join(known, F.col("t.user_id") == F.col("k.user_id"), "left").select(
        "t.user_id", F.coalesce("k.first_active_date", F.lit(day)).alias("first_active_date")
    )
    new = met.where(F.col("first_active_date") == F.lit(day))
    hits = met.groupBy("first_active_date").agg(F.count(F.lit(1)).alias("_hits")).alias("h")
    before = matrix.where(F.col("date") == F.lit(day - timedelta(days=1))).alias("b")
    cohort = F.coalesce("b.first_active_date", "h.first_active_date")
    hit = F.coalesce("h._hits", F.lit(0))
    column = before.join(
        hits, F.col("b.first_active_date") == F.col("h.first_active_date"), "full_outer"
    ).select(
        cohort.alias("first_active_date"),
        F.lit(day).alias("date"),
        hit.alias("active_users"),
        # A cohort that starts today has as many users as it has active ones.
        F.coalesce("b.total_users", hit).alias("total_users"),
    )
    return new, column


def cohort_curve(matrix: DataFrame) -> DataFrame:
    """What ``growth.retention`` gives, from the matrix."""
    share = F.col("active_users").cast("double") / F.col("total_users") * 100
    return matrix.select(
        "date",
        F.date_diff("date", "first_active_date").alias("days_since_first_active"),
        "active_users",
        "total_users",
        share.alias("pct_active"),
    )
