"""Grouping-set reports: device dashboard and leaderboards.

Measures are summed at the finest level first, so the expansion into grouping
sets multiplies group rows, not fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of

OVERALL = "(overall)"
UNKNOWN = "unknown"
FULL_LEVEL = "os_type__device_type__browser"


def _label(column: str) -> Column:
    """The group's value as text, or the overall label where it is rolled up."""
    return F.when(F.grouping(column) == 1, OVERALL).otherwise(F.col(column).cast("string"))


def grouping_set_sums(
    rows: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]], measure: str
) -> DataFrame:
    """Sum of the measure over each grouping set, with text labels."""
    fine = rows.groupBy(*dims).agg(F.sum(measure).alias("_sum"))
    return fine.groupingSets([list(s) for s in sets], *dims).agg(
        *[_label(d).alias(f"_{d}") for d in dims],
        *[F.grouping(d).alias(f"_rolled_{d}") for d in dims],
        F.sum("_sum").alias("total"),
    ).select(
        *[F.col(f"_{d}").alias(d) for d in dims],
        *[f"_rolled_{d}" for d in dims],
        "total",
    )


def device_dashboard(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Hits by operating system, device and browser together, and by each alone.

    Hits are counted per device before the join, so a device with a large share
    of all events joins as one row.
    """
    dims = ("os_type", "device_type", "browser_type")
    hits = events.groupBy("device_id").agg(F.count(F.lit(1)).alias("_hits"))
    named = hits.join(devices, "device_id").select(
        *[F.coalesce(d, F.lit(UNKNOWN)).alias(d) for d in dims], "_hits"
    )
    sums = grouping_set_sums(named, dims, (dims, *[(d,) for d in dims]), "_hits")
    shown = [F.when(F.col(f"_rolled_{d}") == 0, F.lit(d)) for d in dims]
    is_full = all_of([F.col(f"_rolled_{d}") == 0 for d in dims])
    level = F.when(is_full, FULL_LEVEL).otherwise(F.coalesce(*shown))
    return sums.select(
        level.alias("aggregation_level"), *dims, F.col("total").alias("number_of_hits")
    ).orderBy(F.desc("number_of_hits"))


def leaderboard(
    rows: DataFrame, player: str, other: str, measure: str, corrected: bool = False
) -> DataFrame:
    """Greatest total per player over the sets (player, other), each alone, and all.

    As defined a player's greatest total is usually the one over everything, and
    the overall row leads; corrected, only the pair totals count.
    """
    if corrected:
        totals = rows.groupBy(F.col(player).cast("string").alias("player"), other).agg(
            F.sum(measure).alias("total")
        )
    else:
        sets = ((player, other), (player,), (other,), ())
        totals = grouping_set_sums(rows, (player, other), sets, measure).withColumnRenamed(
            player, "player"
        )
    return (
        totals.where(F.col("total").isNotNull())
        .groupBy("player")
        .agg(F.max("total").alias("max_points"))
        .orderBy(F.desc("max_points"))
    )


def season_points(details: DataFrame, games: DataFrame) -> DataFrame:
    """Points per player row with the game's season."""
    return details.select("game_id", "player_id", "pts").join(
        games.select("game_id", "season"), "game_id"
    )


def winner() -> Column:
    return F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(
        F.col("visitor_team_id")
    )


def wins_leaderboard(
    games: DataFrame, details: DataFrame | None = None, corrected: bool = False
) -> DataFrame:
    """Wins per team and overall.

    As defined a win counts once per player row of the game; those are counted
    per game before the join. Corrected, a win counts once.
    """
    if corrected:
        won = games.select(winner().alias("team"), F.lit(1).cast("long").alias("_wins"))
    else:
        rows = details.groupBy("game_id").agg(F.count(F.lit(1)).alias("_wins"))
        won = games.join(rows, "game_id").select(winner().alias("team"), "_wins")
    return (
        grouping_set_sums(won, ("team",), (("team",), ()), "_wins")
        .select("team", F.col("total").alias("total_wins"))
        .orderBy(F.desc("total_wins"))
    )
