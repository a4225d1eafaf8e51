"""Conformed fact table from raw game rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of, clock_minutes, mentions
from tidemark.operators.quality import one_per_key

GRAIN = ("game_id", "team_id", "player_id")

# Comment markers and the flag each one sets.
COMMENT_FLAGS = {
    "DNP": "dim_did_not_play",
    "DND": "dim_did_not_dress",
    "NWT": "dim_not_with_team",
}

MEASURES = (
    "fgm",
    "fga",
    "fg3m",
    "fg3a",
    "ftm",
    "fta",
    "dreb",
    "oreb",
    "reb",
    "ast",
    "stl",
    "blk",
    "turnovers",
    "pf",
    "pts",
    "plus_minus",
)


# Of several rows of a key the first in this order is kept: all columns outside the key.
TIES = (
    "team_abbreviation",
    "player_name",
    "start_position",
    "comment",
    "min",
    "pts",
    "fgm",
    "fga",
    "fg3m",
    "fg3a",
    "ftm",
    "fta",
    "oreb",
    "dreb",
    "reb",
    "ast",
    "stl",
    "blk",
    "turnovers",
    "pf",
    "plus_minus",
)

MATCH = ("game_date_est", "season", "home_team_id")


def game_month() -> Column:
    """Year and month of a game's date as a number, 0 where it has none."""
    day = F.col("game_date_est")
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))


def fact_rows(details: DataFrame, games: DataFrame) -> DataFrame:
    """One row per game, team and player, with the game's attributes and its month.

    Copies are dropped before the game attributes are joined.
    """
    unique = one_per_key(details.select(*GRAIN, *TIES), GRAIN, TIES)
    dated = unique.join(games.select("game_id", *MATCH), "game_id")
    return dated.withColumn("month", game_month())


def merge_facts(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored fact rows and those of a batch, one row per key.

    Both come from ``fact_rows`` and hold a key once, and keys are never null. Of a
    key in both the first in the order of all columns stays, so batches may come in
    any order, again, or with further copies, and leave what one pass over all rows
    would. Of a game's attributes the batch's count.
    """
    o, n = stored.alias("o"), batch.alias("n")
    same = all_of([F.col(f"o.{k}") == F.col(f"n.{k}") for k in GRAIN])

    def ties(side: str) -> Column:
        row = F.struct(*[F.col(f"{side}.{c}").alias(c) for c in TIES])
        return F.when(F.col(f"{side}.game_id").isNotNull(), row)

    either = [F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in (*GRAIN, *MATCH, "month")]
    merged = o.join(n, same, "full_outer").select(*either, F.least(ties("o"), ties("n")).alias("_r"))
    return merged.select(*GRAIN, "_r.*", *MATCH, "month")


def shape_fact(rows: DataFrame) -> DataFrame:
    """Fact rows with ``dim_`` and ``m_`` columns."""
    return rows.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        *[mentions(F.col("comment"), word).alias(flag) for word, flag in COMMENT_FLAGS.items()],
        clock_minutes(F.col("min")).alias("m_minutes"),
        *[F.col(m).alias(f"m_{m}") for m in MEASURES],
    )


def build_fact(details: DataFrame, games: DataFrame) -> DataFrame:
    """The fact in one pass over all rows."""
    return shape_fact(fact_rows(details, games))
