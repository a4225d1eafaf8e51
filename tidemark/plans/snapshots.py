"""Queries on cumulative snapshots, type-2 history and player states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cumulative, late, scd, segments, tracking
from tidemark.operators.cumulative import ACTOR_HISTORY, PLAYER_HISTORY
from tidemark.operators.scd import ACTOR_SCD, PLAYER_SCD
from tidemark.sources import views
from tidemark.sources.repair import Derived, RepairedTables
from tidemark.sources.schemas import (
    ACTOR_HEADS,
    ACTOR_HISTORY_SCD,
    ACTOR_SEGMENTS,
    ACTORS,
    PLAYER_COVERS,
    PLAYER_SEASONS,
    PLAYER_TRACKING,
    PLAYERS,
    PLAYERS_SCD,
    Table,
)
from tidemark.sources.store import BucketedStore, ShelfStore, new_folder, shelved
from tidemark.sources.views import Reader

FIRST = 1995
STEP = 1998
BUILD = 2000
LAST = 2001
SPINE_END = 2002
#: Buckets of the stored tables: a fact of the tables, whatever the session.
BUCKETS = 8
#: Shelves of the tables that take late and corrected periods.
SHELVES = 8
#: Order that seasons come in, one of them again, and the one that is wrong at first.
COMING = (1999, 1996, 2001, 1995, 2000, 1998, 1997, 1996)
WRONG = 1996
#: Season whose facts are corrected, and the country whose players lacked it.
CORRECTED, LACKING = 1997, "3"
#: Films of a segment: few, so that the given actors have several.
SEGMENT_FILMS = 4


def _players(table: Reader, end: int = SPINE_END, **form: object) -> DataFrame:
    return cumulative.cumulate_backfill(views.player_seasons(table), PLAYER_HISTORY, end, **form)


def _classed(table: Reader, end: int, only_end: bool = False) -> DataFrame:
    """Snapshots of players as far as their history reads them."""
    return _players(table, end, attributes="none", elements=False, only_end=only_end)


def _actors(
    table: Reader, end: int, elements: bool = True, only_end: bool = False
) -> DataFrame:
    return cumulative.cumulate_backfill(
        views.actor_films(table),
        ACTOR_HISTORY,
        end,
        fold=True,
        attributes="latest",
        elements=elements,
        only_end=only_end,
    )


def _flat_players(players: DataFrame) -> DataFrame:
    season = F.transform(
        "season_stats",
        lambda s: F.concat_ws(
            ":",
            s["season"].cast("string"),
            s["gp"].cast("string"),
            F.floor(s["pts"] * 1000).cast("string"),
            F.floor(s["reb"] * 4).cast("string"),
            F.floor(s["ast"] * 4).cast("string"),
        ),
    )
    return players.withColumn("season_stats", F.array_join(season, ","))


def _flat_actors(actors: DataFrame) -> DataFrame:
    film = F.transform(
        "films",
        lambda f: F.concat_ws(
            ":",
            f["film"],
            f["votes"].cast("string"),
            F.floor(f["rating"] * 4).cast("string"),
            f["filmid"],
        ),
    )
    return actors.withColumn("films", F.array_join(film, ","))


def cumulative_players_step(table: Reader) -> DataFrame:
    facts = views.player_seasons(table)
    prev = cumulative.cumulate_backfill(
        facts.where(F.col("season") < STEP),
        PLAYER_HISTORY,
        STEP - 1,
        attributes="latest",
        only_end=True,
    )
    today = facts.where(F.col("season") == STEP)
    return _flat_players(cumulative.cumulate_step(prev, today, PLAYER_HISTORY))


def cumulative_actors_step(table: Reader) -> DataFrame:
    films = views.actor_films(table)
    prev = _actors(table, STEP - 1, only_end=True)
    today = films.where(F.col("year") == STEP)
    return _flat_actors(cumulative.cumulate_step(prev, today, ACTOR_HISTORY, fold=True))


def cumulative_players_backfill(table: Reader) -> DataFrame:
    return _flat_players(_players(table))


def cumulative_actors_backfill(table: Reader) -> DataFrame:
    return _flat_actors(_actors(table, LAST))


def scd2_build_players(table: Reader) -> DataFrame:
    return scd.scd2_build(_classed(table, BUILD), PLAYER_SCD, BUILD)


def scd2_build_actors(table: Reader) -> DataFrame:
    return scd.scd2_build(_actors(table, BUILD, elements=False), ACTOR_SCD, BUILD)


def scd2_step_players(table: Reader) -> DataFrame:
    history = scd.scd2_build(_classed(table, BUILD), PLAYER_SCD, BUILD)
    snapshot = _classed(table, BUILD + 1, only_end=True)
    return scd.scd2_step(history, snapshot, PLAYER_SCD, BUILD)


def scd2_step_actors(table: Reader) -> DataFrame:
    return _step_actors(table, scd2_build_actors(table))


def scd2_step_actors_stored(table: Reader) -> DataFrame:
    """As scd2_step_actors, from the history stored and read back."""
    history = scd2_build_actors(table)
    store = BucketedStore(history.sparkSession, new_folder(history.sparkSession), BUCKETS)
    store.replace(ACTOR_HISTORY_SCD, history)
    found = _step_actors(table, store.read(ACTOR_HISTORY_SCD, BUILD).select(*history.columns))
    return store.result(found, ACTOR_HISTORY_SCD)


def _step_actors(table: Reader, history: DataFrame) -> DataFrame:
    snapshot = _actors(table, BUILD + 1, elements=False, only_end=True)
    return scd.scd2_step(
        history,
        snapshot,
        ACTOR_SCD,
        BUILD,
        extend_unchanged=False,
        closed_of_all_versions=True,
    )


def unnest_seasons(table: Reader) -> DataFrame:
    # A season stands in the snapshots of itself and of later seasons.
    players = _players(table).where(F.col("current_season") >= BUILD)
    return cumulative.unnest_history(
        players,
        ["player_name", "current_season"],
        "season_stats",
        lambda s: s["season"] == BUILD,
    )


def unnest_latest_seasons(table: Reader) -> DataFrame:
    latest = _players(table, LAST, only_end=True)
    return cumulative.unnest_history(latest, ["player_name"], "season_stats")


def season_bounds(table: Reader) -> DataFrame:
    # The last snapshot holds every season of the ones before.
    latest = _players(table, only_end=True)
    return cumulative.history_bounds(latest, "season_stats", "season")


def first_latest_change(table: Reader) -> DataFrame:
    latest = _players(table, LAST, only_end=True)
    return cumulative.first_latest_change(latest, "player_name", "season_stats", "pts")


def _tracked(table: Reader) -> DataFrame:
    players = _players(table, LAST)
    return tracking.tracked_seasons(players, scd.scd2_build(players, PLAYER_SCD, LAST))


def player_tracking(table: Reader) -> DataFrame:
    return tracking.track_state_through(_tracked(table))


def player_tracking_corrected(table: Reader) -> DataFrame:
    return tracking.track_state_through(_tracked(table), corrected=True)


def player_tracking_step(table: Reader) -> DataFrame:
    seasons = _tracked(table)
    before = tracking.track_state_through(seasons.where(F.col("season") < LAST))
    prev = before.where(F.col("season") == LAST - 1)
    return tracking.track_state_step(prev, seasons.where(F.col("season") == LAST))


def player_tracking_yearly(table: Reader) -> DataFrame:
    """As player_tracking, by stored steps: each season adds a snapshot, the history
    as of it, and the states, from what the season before left."""
    facts = views.player_seasons(table)
    store = BucketedStore(facts.sparkSession, new_folder(facts.sparkSession), BUCKETS)
    for season in range(FIRST, LAST + 1):
        today = facts.where(F.col("season") == season)
        step = cumulative.cumulate_step(store.read(PLAYERS, season - 1), today, PLAYER_HISTORY)
        store.replace(PLAYERS, step)
        players = store.read(PLAYERS, season)
        history = scd.scd2_step(
            store.read(PLAYERS_SCD, season - 1), players, PLAYER_SCD, season - 1
        )
        store.replace(PLAYERS_SCD, history)
        tracked = tracking.tracked_seasons(players, store.read(PLAYERS_SCD, season))
        before = store.read(PLAYER_TRACKING, season - 1)
        store.replace(PLAYER_TRACKING, tracking.track_state_step(before, tracked))
    return store.result(store.read(PLAYER_TRACKING), PLAYERS, PLAYERS_SCD, PLAYER_TRACKING)


def scd2_players_any_order(table: Reader) -> DataFrame:
    """As scd2_build_players up to LAST, from seasons spliced in one by one, in no order."""
    classed = _classed(table, LAST).checkpoint()
    spark, covers = classed.sparkSession, shelved(PLAYER_COVERS)
    store = ShelfStore(spark, new_folder(spark), SHELVES)
    for n, season in enumerate(COMING):
        told = classed.where(F.col("current_season") == season)
        if season == WRONG and season in COMING[n + 1 :]:
            told = told.withColumns(
                {"scoring_class": F.lit("bad"), "is_active": ~F.col("is_active")}
            )
        told = store.on_shelves(told, "player_name")
        shelves = store.touched(told)
        spans = late.splice(store.read_shelves(covers, shelves), told, PLAYER_SCD)
        store.rewrite(covers, store.on_shelves(spans, "player_name"), shelves)
    return store.result(late.history_of(store.read(covers), PLAYER_SCD, LAST), covers)


def _player_tables(store: ShelfStore) -> RepairedTables:
    """Snapshots, history and states up to LAST, each made from those before it."""
    facts, players, history, states = (
        shelved(t) for t in (PLAYER_SEASONS, PLAYERS, PLAYERS_SCD, PLAYER_TRACKING)
    )

    def snapshots(made: dict[str, DataFrame]) -> DataFrame:
        rows = made[facts.name].drop("shelf")
        return cumulative.cumulate_backfill(rows, PLAYER_HISTORY, LAST, attributes="latest")

    def versions(made: dict[str, DataFrame]) -> DataFrame:
        return scd.scd2_build(made[players.name], PLAYER_SCD, LAST)

    def tracked(made: dict[str, DataFrame]) -> DataFrame:
        seasons = tracking.tracked_seasons(made[players.name], made[history.name])
        return tracking.track_state_through(seasons)

    derived = [Derived(players, snapshots), Derived(history, versions), Derived(states, tracked)]
    return RepairedTables(store, "player_name", facts, derived)


def _repaired(table: Reader) -> tuple[ShelfStore, list[Table]]:
    """Players loaded with a wrong season, a missing and a made-up one, then put right."""
    facts = views.player_seasons(table).checkpoint()
    spark = facts.sparkSession
    store = ShelfStore(spark, new_folder(spark), SHELVES)
    tables = _player_tables(store)
    past, in_it = F.col("country") == LACKING, F.col("season") == CORRECTED
    wrong = facts.where(~(past & in_it)).withColumn(
        "pts", F.when(in_it, F.col("pts") + 9).otherwise(F.col("pts"))
    )
    made_up = facts.where(F.col("season") == FIRST).withColumn("season", F.lit(FIRST - 1))
    tables.correct(wrong.unionByName(made_up))
    right = facts.where(in_it).withColumn("withdrawn", F.lit(False))
    tables.correct(right.unionByName(made_up.withColumn("withdrawn", F.lit(True))))
    return store, [tables.facts, *[d.table for d in tables.derived]]


def player_tracking_repaired(table: Reader) -> DataFrame:
    """As player_tracking, after corrections of stored past seasons."""
    store, tables = _repaired(table)
    states = store.read(tables[-1]).select(*PLAYER_TRACKING.schema.names)
    return store.result(states, *tables)


def scd2_players_repaired(table: Reader) -> DataFrame:
    """As scd2_build_players up to LAST, after corrections of stored past seasons."""
    store, tables = _repaired(table)
    history = store.read(tables[-2]).select(*PLAYERS_SCD.schema.names)
    return store.result(history, *tables)


def actors_yearly(table: Reader) -> DataFrame:
    """As cumulative_actors_backfill, by one stored step per year."""
    films = views.actor_films(table)
    store = BucketedStore(films.sparkSession, new_folder(films.sparkSession), BUCKETS)
    for year in range(FIRST, LAST + 1):
        today = films.where(F.col("year") == year)
        prev = store.read(ACTORS, year - 1)
        store.replace(ACTORS, cumulative.cumulate_step(prev, today, ACTOR_HISTORY, fold=True))
    return store.result(_flat_actors(store.read(ACTORS)), ACTORS)


def _segments_yearly(table: Reader) -> BucketedStore:
    """Films by stored steps: each year writes its heads and the segments it closes."""
    films = views.actor_films(table)
    store = BucketedStore(films.sparkSession, new_folder(films.sparkSession), BUCKETS)
    for year in range(FIRST, LAST + 1):
        today = films.where(F.col("year") == year).checkpoint()
        heads, closed = segments.segment_step(
            store.read(ACTOR_HEADS, year - 1), today, ACTOR_HISTORY, year, SEGMENT_FILMS
        )
        store.replace(ACTOR_SEGMENTS, closed)
        store.replace(ACTOR_HEADS, heads)
    return store


def actors_yearly_segments(table: Reader) -> DataFrame:
    """As cumulative_actors_backfill, from rows of a bounded size."""
    store = _segments_yearly(table)
    whole = segments.whole_histories(
        store.read(ACTOR_HEADS), store.read(ACTOR_SEGMENTS), ACTOR_HISTORY
    )
    return store.result(_flat_actors(whole), ACTOR_HEADS, ACTOR_SEGMENTS)


QUERIES = {
    f.__name__: f
    for f in (
        actors_yearly,
        actors_yearly_segments,
        cumulative_players_step,
        cumulative_actors_step,
        cumulative_players_backfill,
        cumulative_actors_backfill,
        scd2_build_players,
        scd2_build_actors,
        scd2_step_players,
        scd2_step_actors,
        scd2_step_actors_stored,
        unnest_seasons,
        unnest_latest_seasons,
        season_bounds,
        first_latest_change,
        player_tracking,
        player_tracking_corrected,
        player_tracking_step,
        player_tracking_yearly,
        player_tracking_repaired,
        scd2_players_any_order,
        scd2_players_repaired,
    )
}
