from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators.cumulative import (
    ACTOR_HISTORY,
    PLAYER_HISTORY,
    cumulate_backfill,
    cumulate_step,
    first_latest_change,
    history_bounds,
    unnest_history,
)
from tidemark.sources.schemas import ACTORS, PLAYERS

SEASONS = (
    "player_name string, height string, college string, country string, draft_year string, "
    "draft_number string, draft_round string, season int, gp int, pts double, reb double, "
    "ast double"
)
FILMS = (
    "actor string, actorid string, film string, year int, votes int, rating double, "
    "filmid string"
)


def season(name, year, pts, height="H1", college="C"):
    return (name, height, college, "X", "1990", "1", "1", year, 10, pts, 1.0, 2.0)


PLAYED = [
    season("a", 1996, 25.0, height=None),
    season("a", 1997, 15.0, height="H2"),
    season("a", 2000, 10.5, height=None),
    season("b", 1998, 0.0),
    season("b", 1999, 16.0),
    season("c", 2000, None),
]


def run_steps(spark, facts, h, table, first, last, fold=False):
    """Snapshots of every period, chained from an empty one."""
    snapshot = spark.createDataFrame([], table.schema).select(*h.columns)
    every = []
    for period in range(first, last + 1):
        today = facts.where(F.col(h.period) == period)
        snapshot = cumulate_step(snapshot, today, h, fold)
        every.append(snapshot)
    return every


def test_player_step_branches(spark, frame):
    facts = frame(SEASONS, PLAYED)
    last = run_steps(spark, facts, PLAYER_HISTORY, PLAYERS, 1996, 2000)[-1]
    got = {r.player_name: r for r in last.collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert [s.season for s in a.season_stats] == [1996, 1997, 2000]
    assert (a.height, a.scoring_class, a.years_since_last_season, a.is_active) == (
        "H2",
        "average",
        0,
        True,
    )
    assert (b.scoring_class, b.years_since_last_season, b.is_active) == ("good", 1, False)
    assert (c.scoring_class, len(c.season_stats), c.current_season) == ("bad", 1, 2000)


def test_steps_equal_backfill(spark, frame):
    facts = frame(SEASONS, PLAYED)
    every = run_steps(spark, facts, PLAYER_HISTORY, PLAYERS, 1996, 2001)
    stepped = every[0]
    for snapshot in every[1:]:
        stepped = stepped.unionByName(snapshot)
    backfill = cumulate_backfill(facts, PLAYER_HISTORY, 2001, attributes="latest")
    assert rows_of(stepped) == rows_of(backfill)


def test_backfill_takes_greatest_attributes_and_cuts_the_span(frame):
    facts = frame(SEASONS, [*PLAYED, season("d", 1990, 30.0), season("e", 2009, 30.0)])
    got = cumulate_backfill(facts, PLAYER_HISTORY, 2000, start=1996)
    rows = {(r.player_name, r.current_season): r for r in got.collect()}
    assert rows["a", 1996].height == "H2"
    assert not any(name == "e" for name, _ in rows)
    # Facts before the span give spine rows with no history.
    assert [r for r in rows if r[0] == "d"] == [("d", y) for y in range(1996, 2001)]
    d = rows["d", 1996]
    assert (d.season_stats, d.scoring_class, d.is_active) == ([], "bad", None)
    assert d.years_since_last_season is None


def test_thresholds_are_strict(frame):
    facts = frame(SEASONS, [season(str(p), 2000, float(p)) for p in (21, 20, 16, 15, 11, 10)])
    got = cumulate_backfill(facts, PLAYER_HISTORY, 2000)
    assert {r.player_name: r.scoring_class for r in got.collect()} == {
        "21": "star",
        "20": "good",
        "16": "good",
        "15": "average",
        "11": "average",
        "10": "bad",
    }


def film(actor, actorid, year, filmid, rating):
    return (actor, actorid, f"film {filmid}", year, 5, rating, filmid)


PLAYED_IN = [
    film("Ann", "A1", 1980, "F2", 9.0),
    film("Ann", "A1", 1980, "F1", 8.0),
    film("Ann", "A1", 1982, "F3", 6.5),
    film("Bob", "A2", 1981, "F4", 8.0),
]


def test_actor_steps_equal_backfill(spark, frame):
    facts = frame(FILMS, PLAYED_IN)
    every = run_steps(spark, facts, ACTOR_HISTORY, ACTORS, 1980, 1983, fold=True)
    stepped = every[0]
    for snapshot in every[1:]:
        stepped = stepped.unionByName(snapshot)
    backfill = cumulate_backfill(facts, ACTOR_HISTORY, 1983, fold=True, attributes="latest")
    assert rows_of(stepped) == rows_of(backfill)

    rows = {(r.actorid, r.current_year): r for r in backfill.collect()}
    # Ordered by film id inside a year; the class comes from the year's average.
    assert [f.filmid for f in rows["A1", 1982].films] == ["F1", "F2", "F3"]
    assert rows["A1", 1980].quality_class == "star"
    assert (rows["A1", 1981].quality_class, rows["A1", 1981].is_active) == ("star", False)
    assert rows["A1", 1982].quality_class == "average"

    light = cumulate_backfill(
        facts, ACTOR_HISTORY, 1983, fold=True, attributes="latest", elements=False
    )
    assert rows_of(light) == rows_of(backfill.drop("films"))


def test_two_names_of_one_id_share_the_average(spark, frame):
    facts = frame(
        FILMS, [film("Ann", "A1", 1980, "F1", 10.0), film("Anna", "A1", 1980, "F2", 5.0)]
    )
    (got,) = run_steps(spark, facts, ACTOR_HISTORY, ACTORS, 1980, 1980, fold=True)
    rows = {r.actor: r for r in got.collect()}
    assert {n: [f.filmid for f in r.films] for n, r in rows.items()} == {
        "Ann": ["F1"],
        "Anna": ["F2"],
    }
    assert {r.quality_class for r in rows.values()} == {"good"}


def test_reading_histories(frame):
    players = cumulate_backfill(frame(SEASONS, PLAYED), PLAYER_HISTORY, 2000).where(
        "current_season = 2000"
    )
    flat = unnest_history(players, ["player_name"], "season_stats")
    assert rows_of(flat, "player_name", "season") == rows_of(
        frame("n string, s int", [(p[0], p[7]) for p in PLAYED])
    )
    bounds = history_bounds(players, "season_stats", "season")
    assert rows_of(bounds) == [(1996, 2000)]
    change = first_latest_change(players, "player_name", "season_stats", "pts")
    assert {r.player_name: r.percentage for r in change.collect()} == {
        "a": -58.0,
        "b": 0.0,
        "c": None,
    }
