"""Queries on the property graph; JSON properties are returned as columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import json_fields
from tidemark.operators import facts, graph
from tidemark.sources import views
from tidemark.sources.schemas import EDGES, PAIR_CHANGES, PLAYER_GAMES, VERTICES
from tidemark.sources.store import BucketedStore, SnapshotStore, new_folder, new_store
from tidemark.sources.views import Reader

#: Least buckets of the stored tables; a larger input has more.
BUCKETS = 2
#: Days that are loaded one at a time, after everything else.
LOADED_DAYS = [date(1998, 3, 30), date(1998, 3, 31), date(1998, 4, 1)]

VERTEX_FIELDS = (
    *("pts_home", "pts_away", "winning_team"),
    *("player_name", "number_of_games", "total_points", "teams"),
    *("abbreviation", "nickname", "city", "arena", "year_founded"),
)
EDGE_FIELDS = (
    *("start_position", "pts", "team_id", "team_abbreviation"),
    *("num_games", "subject_points", "object_points"),
)


def _with_fields(rows: DataFrame, *fields: str) -> DataFrame:
    columns = [c for c in rows.columns if c != "properties"]
    return rows.select(*columns, json_fields("properties", *fields))


def game_vertices(table: Reader) -> DataFrame:
    vertices = graph.game_vertices(views.games(table))
    return _with_fields(vertices, "pts_home", "pts_away", "winning_team")


def player_vertices(table: Reader) -> DataFrame:
    vertices = graph.player_vertices(views.game_details(table))
    return _with_fields(vertices, "player_name", "number_of_games", "total_points", "teams")


def team_vertices(table: Reader) -> DataFrame:
    vertices = graph.team_vertices(views.teams(table))
    return _with_fields(
        vertices, "abbreviation", "nickname", "city", "arena", "year_founded"
    )


def vertex_counts(table: Reader) -> DataFrame:
    vertices = (
        graph.game_vertices(views.games(table))
        .unionByName(
            graph.player_vertices(graph.without_names(views.game_details(table, names=False)))
        )
        .unionByName(graph.team_vertices(views.teams(table)))
    )
    return graph.vertex_counts(vertices)


def plays_in_edges(table: Reader) -> DataFrame:
    edges = graph.plays_in_edges(views.game_details(table, names=False))
    return _with_fields(edges, "start_position", "pts", "team_id", "team_abbreviation")


def player_pair_edges(table: Reader) -> DataFrame:
    edges = graph.player_edges(views.game_details(table))
    return _with_fields(edges, "num_games", "subject_points", "object_points")


def vertices_stored(table: Reader) -> DataFrame:
    """All kinds of vertices kept as a table, and read back from it."""
    vertices = (
        graph.game_vertices(views.games(table))
        .unionByName(graph.player_vertices(views.game_details(table)))
        .unionByName(graph.team_vertices(views.teams(table)))
    )
    store = SnapshotStore(vertices.sparkSession, new_folder(vertices.sparkSession))
    store.replace(VERTICES, vertices, gather=True)
    return store.result(_with_fields(store.read(VERTICES), *VERTEX_FIELDS), VERTICES)


def _load_games(store: BucketedStore, load: int, details: DataFrame, games: DataFrame) -> None:
    """Bring the games of some rows into the store; a load again changes nothing.

    Changes of pairs are written first: where a load stops in between, the same load
    finds them again from players of games that are still as before.
    """
    dated = games.select("game_id", facts.game_month().alias("month"))
    played = graph.player_games(details, "player_name").join(dated, "game_id")
    months = [r.month for r in dated.select("month").distinct().collect()]
    stored = store.read(PLAYER_GAMES).where(F.col("month").isin(months))
    before, after = graph.changed_games(stored, played, dated)
    # Read twice below: kept, so that inputs are scanned once a load.
    after = after.checkpoint()
    changes = graph.pair_changes(before, after).withColumn("load", F.lit(load))
    # Grouped by pair, as buckets are: written as they come.
    store.replace(PAIR_CHANGES, changes)
    store.upsert(PLAYER_GAMES, after, months, gather=True)


def edges_stored(table: Reader) -> DataFrame:
    """All kinds of edges, kept up to date load by load, stored, and read back.

    The first load holds all games but those of two days. These come one day at a
    time and out of order; one comes with some of its players first and whole later.
    """
    games = views.games(table)
    views.game_details(table)  # all tables are looked up: their size says how many buckets
    store = new_store(games.sparkSession, BUCKETS)
    first, second, _ = LOADED_DAYS
    is_late = F.coalesce(F.col("game_date_est").isin(first, second), F.lit(False))
    loads = [(~is_late, None)] + [
        (F.col("game_date_est") == F.lit(day), part)
        for day, part in (
            (second, None),
            (first, F.col("player_id") % 2 == 0),
            (first, None),
        )
    ]
    for load, (days, part) in enumerate(loads):
        chosen = games.where(days)
        held = views.game_details(table, of=chosen)
        _load_games(store, load, held if part is None else held.where(part), chosen)
    edges = graph.plays_in_of(store.read(PLAYER_GAMES)).unionByName(
        graph.pair_edges_of(graph.summed_pairs(store.read(PAIR_CHANGES)))
    )
    # No step joins edges by key: they are kept by kind, without buckets.
    kept = SnapshotStore(store.spark, store.folder)
    kept.replace(EDGES, edges)
    found = _with_fields(kept.read(EDGES), *EDGE_FIELDS)
    return store.handed_over(found, EDGES, PLAYER_GAMES, PAIR_CHANGES)


def best_game(table: Reader) -> DataFrame:
    careers = graph.player_careers(views.game_details(table))
    return graph.best_game(careers, graph.player_games(views.game_details(table, names=False)))


def pair_stats(table: Reader) -> DataFrame:
    details = views.game_details(table)
    pairs = graph.meetings(graph.player_games(details, "player_name"))
    return graph.pair_stats(graph.player_careers(details), pairs)


QUERIES = {
    f.__name__: f
    for f in (
        game_vertices,
        player_vertices,
        team_vertices,
        vertex_counts,
        plays_in_edges,
        player_pair_edges,
        vertices_stored,
        edges_stored,
        best_game,
        pair_stats,
    )
}
