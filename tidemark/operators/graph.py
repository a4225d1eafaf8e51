"""Property graph of players, teams and games, kept as vertex and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import any_of, json_object, ratio_or_whole
from tidemark.operators.cubes import winner
from tidemark.operators.quality import one_per_key

# A game with more players than this is paired block by block.
BLOCK_ROWS = 1000


def _vertex(kind: str, identifier: str, *properties: Column) -> list[Column]:
    return [
        F.col(identifier).cast("string").alias("identifier"),
        F.lit(kind).alias("type"),
        json_object(*properties).alias("properties"),
    ]


def _edge(
    subject: str, target: str, target_kind: str, kind: Column, *properties: Column
) -> list[Column]:
    return [
        F.col(subject).cast("string").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col(target).cast("string").alias("object_identifier"),
        F.lit(target_kind).alias("object_type"),
        kind.alias("edge_type"),
        json_object(*properties).alias("properties"),
    ]


def game_vertices(games: DataFrame) -> DataFrame:
    return games.select(
        *_vertex(
            "game",
            "game_id",
            F.col("pts_home"),
            F.col("pts_away"),
            winner().alias("winning_team"),
        )
    )


def without_names(details: DataFrame) -> DataFrame:
    """Details with null player names, for who reads identifiers only."""
    return details.withColumn("player_name", F.lit(None).cast("string"))


def player_careers(details: DataFrame) -> DataFrame:
    """Games, points and teams of each player."""
    return details.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"),
        F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").alias("total_points"),
        F.array_sort(F.collect_set("team_id")).alias("teams"),
    )


def player_vertices(details: DataFrame) -> DataFrame:
    names = ("player_name", "number_of_games", "total_points", "teams")
    return player_careers(details).select(*_vertex("player", "player_id", *map(F.col, names)))


def team_vertices(teams: DataFrame) -> DataFrame:
    names = ("abbreviation", "nickname", "city", "arena")
    return one_per_key(teams, ["team_id"]).select(
        *_vertex(
            "team", "team_id", *map(F.col, names), F.col("yearfounded").alias("year_founded")
        )
    )


def vertex_counts(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("type").agg(F.count(F.lit(1)).alias("n_vertices"))


# Of several rows of a player and game, the first in this order is kept.
EDGE_ORDER = ("start_position", "pts", "team_id", "team_abbreviation")


def player_games(details: DataFrame, *extra: str) -> DataFrame:
    """One row per player and game, with the columns edges are made of."""
    keys = ["player_id", "game_id"]
    return one_per_key(details.select(*keys, *EDGE_ORDER, *extra), keys, EDGE_ORDER)


def plays_in_of(played: DataFrame) -> DataFrame:
    """Edges of rows with one player and game each."""
    return played.select(
        *_edge("player_id", "game_id", "game", F.lit("plays_in"), *map(F.col, EDGE_ORDER))
    )


def plays_in_edges(details: DataFrame) -> DataFrame:
    return plays_in_of(player_games(details))


PAIR = ("subject_id", "object_id", "edge_type")
SUMS = ("num_games", "subject_points", "object_points", "subject_known", "object_known")


def _met(played: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each pair of players who met, once per game, with their points.

    The pairs are the result, so they must be made, but not by one task per game:
    a game with more than ``block_rows`` players is cut into blocks, and each
    two blocks are a join key of their own. Smaller games are one block, which
    is a plain join by game. The key is the same from either side, so that both
    sides are one shuffle, read twice.
    """
    seen = played.select("game_id", "player_id", "player_name", "team_abbreviation", "pts")
    large = (
        seen.groupBy("game_id")
        .agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("_blocks"))
        .where(F.col("_blocks") > 1)
    )
    blocks = F.coalesce(F.col("_blocks"), F.lit(1))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    placed = (
        seen.join(large, "game_id", "left")
        .withColumn("_blocks", blocks)
        .withColumn("_block", F.pmod(F.xxhash64("player_id"), "_blocks"))
        .withColumn("_other", others)
        .withColumn("_low", F.least("_block", "_other"))
        .withColumn("_high", F.greatest("_block", "_other"))
    )
    left, right = placed.alias("l"), placed.alias("r")
    within = (F.col("l._block") == F.col("l._other")) & (F.col("r._block") == F.col("r._other"))
    met = left.join(
        right,
        (F.col("l.game_id") == F.col("r.game_id"))
        & (F.col("l._low") == F.col("r._low"))
        & (F.col("l._high") == F.col("r._high"))
        & (within | (F.col("l._block") != F.col("r._block")))
        & (F.col("l.player_name") > F.col("r.player_name")),
    )
    same_team = F.col("l.team_abbreviation") == F.col("r.team_abbreviation")
    relation = F.when(same_team, "shares_team").otherwise("plays_against")
    return met.select(
        F.col("l.player_id").alias("subject_id"),
        F.col("r.player_id").alias("object_id"),
        relation.alias("edge_type"),
        F.col("l.pts").alias("subject_pts"),
        F.col("r.pts").alias("object_pts"),
    )


def meetings(played: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each pair of players who met, once per relation, with games and points.

    ``subject_known`` and ``object_known`` count games with points, so that sums can
    be added and taken away again.
    """
    return (
        _met(played, block_rows)
        .groupBy(*PAIR)
        .agg(
            F.count(F.lit(1)).alias("num_games"),
            F.sum("subject_pts").alias("subject_points"),
            F.sum("object_pts").alias("object_points"),
            F.count("subject_pts").alias("subject_known"),
            F.count("object_pts").alias("object_known"),
        )
    )


def pair_edges_of(pairs: DataFrame) -> DataFrame:
    """Edges of summed pairs."""
    return pairs.select(
        *_edge("subject_id", "object_id", "player", F.col("edge_type"), *map(F.col, SUMS[:3]))
    )


def player_edges(details: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    # Pairs of identifiers are dealt as edges are, so grouping edges shuffles them no more.
    played = player_games(details, "player_name")
    named = played.withColumn("player_id", F.col("player_id").cast("string"))
    return pair_edges_of(meetings(named, block_rows))


def changed_games(
    stored: DataFrame, batch: DataFrame, games: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Players of the games in a batch, as stored and as they are with it.

    Both inputs hold a player and game once, as ``player_games`` gives them. ``games``
    hold all games of the batch, and may hold more: naming them saves finding them.
    """
    games = (batch if games is None else games).select("game_id").distinct()
    before = stored.join(games, "game_id", "left_semi")
    both = before.unionByName(batch.select(*before.columns))
    return before, one_per_key(both, ["player_id", "game_id"], EDGE_ORDER)


def pair_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What pairs gain and lose when some games' players change.

    New games are paired within themselves only; games that came before give back
    what they gave. Pairs that nothing changes are left out. Both are summed at once, a
    pair of a game counting for one or for less one.
    """
    sign = F.col("_sign")
    gained = _met(after).withColumn("_sign", F.lit(1).cast("long"))
    lost = _met(before).withColumn("_sign", F.lit(-1).cast("long"))
    sides = ("subject", "object")
    sums = [
        F.sum(sign).alias("num_games"),
        *[F.sum(F.col(f"{x}_pts") * sign).alias(f"{x}_points") for x in sides],
        *[F.sum(F.when(F.col(f"{x}_pts").isNotNull(), sign)).alias(f"{x}_known") for x in sides],
    ]
    changes = gained.unionByName(lost).groupBy(*PAIR).agg(*sums)
    changes = changes.select(*PAIR, *[F.coalesce(c, F.lit(0)).alias(c) for c in SUMS])
    return changes.where(any_of([F.col(c) != 0 for c in SUMS]))


def summed_pairs(changes: DataFrame) -> DataFrame:
    """Pairs of all changes together; points are null where no game has any."""
    sums = changes.groupBy(*PAIR).agg(*[F.sum(c).alias(c) for c in SUMS])
    points = {
        f"{x}_points": F.when(F.col(f"{x}_known") > 0, F.col(f"{x}_points"))
        for x in ("subject", "object")
    }
    return sums.where(F.col("num_games") > 0).withColumns(points)


def best_game(careers: DataFrame, played: DataFrame) -> DataFrame:
    """Most points of each player in one game.

    Games are reduced to one row per player before they meet the careers.
    """
    best = played.groupBy("player_id").agg(F.max("pts").alias("max_points"))
    return (
        careers.join(best, "player_id")
        .groupBy("player_name")
        .agg(F.max("max_points").alias("max_points"))
        .orderBy(F.desc_nulls_first("max_points"))
    )


def pair_stats(careers: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each player's career average beside the statistics of each relation."""
    average = ratio_or_whole(F.col("total_points"), F.col("number_of_games"))
    players = careers.select(
        F.col("player_id").alias("subject_id"), "player_name", average.alias("avg_points")
    )
    return pairs.join(players, "subject_id").select(
        "player_name",
        F.col("object_id").cast("string").alias("object_identifier"),
        "avg_points",
        *[F.col(c).cast("string").alias(c) for c in ("subject_points", "num_games")],
    )
