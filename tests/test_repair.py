"""Shelved tables after corrections against tables built from the right facts."""

import random
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import cumulative, scd, tracking
from tidemark.operators.cumulative import PLAYER_HISTORY
from tidemark.operators.scd import PLAYER_SCD
from tidemark.plans.snapshots import LAST, _player_tables
from tidemark.sources.schemas import PLAYER_SEASONS, PLAYER_TRACKING, PLAYERS, PLAYERS_SCD
from tidemark.sources.store import ShelfStore, shelved

NAMES = PLAYER_SEASONS.schema.names


def season(name, year, pts=12.0):
    return (name, year, "H1", "c", "3", "1990", "1", "1", 10, pts, 1.0, 2.0)


def drawn(seed=4, players=12):
    made = random.Random(seed)
    return [
        season(f"p{k}" if k else None, year, made.choice([3.0, 12.0, 17.0, 25.0]))
        for k in range(players)
        for year in range(1995, LAST + 1)
        if made.random() < 0.6
    ]


def rebuilt(frame, rows):
    facts = frame(PLAYER_SEASONS.schema, rows)
    players = cumulative.cumulate_backfill(facts, PLAYER_HISTORY, LAST, attributes="latest")
    history = scd.scd2_build(players, PLAYER_SCD, LAST)
    states = tracking.track_state_through(tracking.tracked_seasons(players, history))
    return [(PLAYERS, players), (PLAYERS_SCD, history), (PLAYER_TRACKING, states)]


def same(store, frame, rows):
    for table, want in rebuilt(frame, rows):
        names = table.schema.names
        assert rows_of(store.read(shelved(table)), *names) == rows_of(want, *names)
    assert rows_of(store.read(shelved(PLAYER_SEASONS)), *NAMES) == sorted(rows, key=repr)


def files(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_corrections_equal_a_rebuild_and_leave_other_shelves(spark, frame, tmp_path):
    rows = drawn()
    store = ShelfStore(spark, str(tmp_path / "s"), 16)
    tables = _player_tables(store)
    tables.correct(frame(PLAYER_SEASONS.schema, rows))
    same(store, frame, rows)
    before = files(store.folder)

    gone = [r for r in rows if r[0] == "p3"]
    right = [(*r[:9], r[9] + 9, *r[10:]) for r in rows if r[0] == "p5" and r[1] < 1999]
    new = [season("p5", 1980, 30.0)]
    late = frame(
        StructType([*PLAYER_SEASONS.schema.fields]).add("withdrawn", "boolean"),
        [(*r, True) for r in gone] + [(*r, None) for r in right + new],
    )
    shelves = tables.correct(late)
    after_rows = [r for r in rows if r not in gone and (r[0] != "p5" or r[1] >= 1999)] + right + new
    same(store, frame, after_rows)
    after = files(store.folder)
    untouched = [p for p in before if int(p.parent.name.removeprefix("shelf=")) not in shelves]
    assert 0 < len(shelves) <= 2 and untouched
    assert all(after[p] == before[p] for p in untouched)
    # Given again it changes nothing, as after a failure halfway.
    assert tables.correct(late) == shelves
    same(store, frame, after_rows)


def test_a_shelf_may_become_empty_and_full_again(spark, frame, tmp_path):
    rows = [season("only", 1996), season("only", 1999)]
    store = ShelfStore(spark, str(tmp_path / "s"), 3)
    tables = _player_tables(store)
    assert tables.correct(frame(PLAYER_SEASONS.schema, [])) == []
    first = frame(PLAYER_SEASONS.schema, rows)
    tables.correct(first)
    tables.correct(first.withColumn("withdrawn", F.lit(True)))
    assert store.read(shelved(PLAYERS)).count() == 0
    assert store.read(shelved(PLAYER_SEASONS)).count() == 0
    # Repeated rows count once, the greatest by its values; other columns are left out.
    again = first.unionByName(first.withColumn("gp", F.lit(1))).withColumn("_best", F.lit(0))
    tables.correct(again)
    same(store, frame, rows)


def test_another_number_of_shelves_is_refused(spark, frame, tmp_path):
    folder = str(tmp_path / "s")
    with pytest.raises(ValueError, match="say how many shelves"):
        ShelfStore(spark, folder)
    tables = _player_tables(ShelfStore(spark, folder, 4))
    tables.correct(frame(PLAYER_SEASONS.schema, [season("p", 1996)]))
    assert ShelfStore(spark, folder).shelves == 4
    with pytest.raises(ValueError, match="4 shelves, not 5"):
        ShelfStore(spark, folder, 5)
    store = ShelfStore(spark, folder)
    stray = store.on_shelves(frame(PLAYER_SEASONS.schema, [season("q", 1996)]), "player_name")
    with pytest.raises(ValueError, match="not named"):
        store.rewrite(shelved(PLAYER_SEASONS), stray, [])
