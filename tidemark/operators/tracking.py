"""Player state changes from season to season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEW, CONTINUED, RETURNED = "New", "Continued Playing", "Returned from Retirement"
RETIRED, STAYED = "Retired", "Stayed Retired"


def tracked_seasons(players: DataFrame, scd: DataFrame) -> DataFrame:
    """Players with the earliest history start that one of their seasons reaches.

    The history is reduced to its earliest start before the join, and the season
    test needs only the latest season, so nothing is unnested.
    """
    starts = scd.groupBy("player_name").agg(F.min("start_season").alias("start_season"))
    latest = F.array_max(F.transform("season_stats", lambda s: s["season"]))
    return (
        players.select(
            "player_name",
            "is_active",
            F.col("current_season").alias("season"),
            latest.alias("_latest"),
        )
        .join(starts, "player_name")
        .where(F.col("_latest") >= F.col("start_season"))
        .select("player_name", "season", "start_season", "is_active")
        .distinct()
    )


def _state(is_first: Column, active: Column, before: Column, corrected: bool) -> Column:
    """State from the one before, null if there is none.

    As defined only 'Retired' is a retirement to return from or stay in;
    corrected, so is 'Stayed Retired'.
    """
    was_retired = before.isin(RETIRED, STAYED) if corrected else before == RETIRED
    was_playing = before.isin(NEW, CONTINUED, RETURNED)
    from_retirement = F.when(active, RETURNED).when(~active, STAYED).otherwise(CONTINUED)
    return (
        F.when(is_first, NEW)
        .when(was_playing & ~active, RETIRED)
        .when(was_retired, from_retirement)
        .otherwise(CONTINUED)
    )


def track_state_step(prev: DataFrame, today: DataFrame, corrected: bool = False) -> DataFrame:
    """Next season's states; ``today`` comes from ``tracked_seasons``."""
    t, y = today.alias("t"), prev.alias("y")
    active = F.col("t.is_active")
    is_first = F.col("t.start_season") == F.col("t.season")
    state = _state(is_first, active, F.col("y.state"), corrected)
    joined = t.join(y, F.col("y.player_name") == F.col("t.player_name"), "full_outer")
    return joined.select(
        F.coalesce("t.player_name", "y.player_name").alias("player_name"),
        F.coalesce(F.col("t.season"), F.col("y.season") + 1).alias("season"),
        F.coalesce("y.start_season", "t.start_season").alias("start_season"),
        F.when(active, F.col("t.season")).otherwise(F.col("y.last_season")).alias("last_season"),
        state.alias("state"),
    )


def track_state_through(seasons: DataFrame, corrected: bool = False) -> DataFrame:
    """All seasons' states in one shuffle, equal to the chained steps.

    Each player's seasons (one row each, consecutive) are folded in order, the
    last emitted state being the state of the season before.
    """
    tracked = "array<struct<season:int,start_season:int,last_season:int,state:string>>"

    def fold(done: Column, row: Column) -> Column:
        old = F.try_element_at(done, F.lit(-1))
        is_first = row["start_season"] == row["season"]
        state = _state(is_first, row["is_active"], old["state"], corrected)
        last = F.when(row["is_active"], row["season"]).otherwise(old["last_season"])
        step = F.struct(
            row["season"].alias("season"),
            F.coalesce(old["start_season"], row["start_season"]).alias("start_season"),
            last.alias("last_season"),
            state.alias("state"),
        )
        return F.concat(done, F.array(step)).cast(tracked)

    players = seasons.groupBy("player_name").agg(
        F.sort_array(F.collect_list(F.struct("season", "start_season", "is_active"))).alias("_s")
    )
    states = F.aggregate("_s", F.array().cast(tracked), fold)
    return players.select("player_name", F.inline(states))
