"""Histories in bounded rows against histories in one array."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators.cumulative import ACTOR_HISTORY, PLAYER_HISTORY, cumulate_step
from tidemark.operators.segments import history_elements, segment_step, whole_histories
from tidemark.sources.schemas import ACTOR_HEADS, ACTOR_SEGMENTS, ACTORS
from tidemark.sources.store import BucketedStore

FACTS = "actor string, actorid string, film string, year int, votes int, rating double, filmid string"


def film(actor, n, year, rating=7.5):
    return (f"Name {actor}", actor, f"film {n}", year, n, rating, f"F{n:05}")


def sample():
    made = random.Random(6)
    rows = [film(f"A{made.randrange(8)}", n, 2000 + made.randrange(5), made.choice([3.0, 7.0, 9.0]))
            for n in range(90)]
    return rows + [film("busy", 1000 + n, 2001 + n % 3) for n in range(70)]


def stepped(spark, frame, rows, bound, years=range(2000, 2006)):
    """Heads of every year, closed segments, and the snapshots of one array."""
    heads = spark.createDataFrame([], ACTOR_HEADS.schema)
    arrays = spark.createDataFrame([], ACTORS.schema)
    every, closed, whole = heads, spark.createDataFrame([], ACTOR_SEGMENTS.schema), arrays
    for year in years:
        today = frame(FACTS, [r for r in rows if r[3] == year])
        now, full = segment_step(heads, today, ACTOR_HISTORY, year, bound)
        heads = spark.createDataFrame(
            now.select(*ACTOR_HEADS.schema.names).collect(), ACTOR_HEADS.schema
        )
        full = spark.createDataFrame(
            full.select(*ACTOR_SEGMENTS.schema.names).collect(), ACTOR_SEGMENTS.schema
        )
        step = cumulate_step(arrays, today, ACTOR_HISTORY, fold=True)
        arrays = spark.createDataFrame(
            step.select(*ACTORS.schema.names).collect(), ACTORS.schema
        )
        every, closed, whole = every.union(heads), closed.union(full), whole.union(arrays)
    return every, closed, whole


@pytest.mark.parametrize("bound", [1, 4, 1000])
def test_same_snapshots_as_one_array(spark, frame, bound):
    heads, closed, arrays = stepped(spark, frame, sample(), bound)
    got = whole_histories(heads, closed, ACTOR_HISTORY)
    assert rows_of(got.select(*ACTORS.schema.names)) == rows_of(arrays)
    assert heads.where(F.size("films") >= bound).count() == 0
    assert closed.where(F.size("films") != bound).count() == 0
    assert closed.groupBy("actorid", "segment").count().where("count > 1").count() == 0


def test_elements_without_an_array_of_all(spark, frame):
    heads, closed, arrays = stepped(spark, frame, sample(), 4)
    for year in (2002, 2005):
        got = history_elements(heads.where(F.col("current_year") == year), closed, ACTOR_HISTORY)
        want = arrays.where(F.col("current_year") == year).select(
            "actorid", "actor", F.posexplode("films").alias("place", "_e")
        )
        assert rows_of(got) == rows_of(want.select("actorid", "actor", "place", "_e.*"))


def test_a_key_with_very_many_elements_has_bounded_rows(spark, frame):
    rows = spark.range(0, 120_000, 1, 4).select(
        F.lit("a").alias("actor"), F.lit("x").alias("actorid"),
        F.concat(F.lit("f"), "id").alias("film"), F.lit(2000).alias("year"),
        F.col("id").cast("int").alias("votes"), F.lit(8.5).alias("rating"),
        F.format_string("%09d", "id").alias("filmid"),
    )
    none = spark.createDataFrame([], ACTOR_HEADS.schema)
    heads, closed = segment_step(none, rows, ACTOR_HISTORY, 2000, 1000)
    assert closed.count() == 120 and closed.agg(F.max(F.size("films"))).first()[0] == 1000
    (head,) = heads.collect()
    assert (head.elements, head.films, head.quality_class) == (120_000, [], "star")
    more = rows.where("id < 1").withColumn("year", F.lit(2001))
    known = spark.createDataFrame([head], heads.schema)
    heads, closed = segment_step(known, more, ACTOR_HISTORY, 2001, 1000)
    # The next period writes what it brings, none of what was closed.
    assert closed.count() == 0 and [len(r.films) for r in heads.collect()] == [1]


def test_closed_segments_are_not_written_again(spark, frame, tmp_path):
    store = BucketedStore(spark, str(tmp_path), 2)
    rows = sample()

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "actor_segments").rglob("*.parquet")}

    before = {}
    for year in (2000, 2001, 2002, 2002):
        today = frame(FACTS, [r for r in rows if r[3] == year])
        heads, closed = segment_step(store.read(ACTOR_HEADS, year - 1), today, ACTOR_HISTORY, year, 2)
        store.replace(ACTOR_SEGMENTS, closed)
        store.replace(ACTOR_HEADS, heads)
        now = files()
        old = {p: t for p, t in before.items() if f"closed_in={year}" not in p}
        assert old.items() <= now.items() and len(now) > len(old), year
        before = now
    # A year built again leaves the same rows.
    assert store.read(ACTOR_SEGMENTS).groupBy("actorid", "segment").count().where("count > 1").count() == 0


def test_histories_with_idle_periods(spark, frame):
    h = PLAYER_HISTORY
    columns = (
        "player_name string, height string, college string, country string, draft_year string, "
        "draft_number string, draft_round string, season int, gp int, pts double, reb double, "
        "ast double"
    )
    own = ("p", "H", "C", "N", "1990", "1", "1")
    heads, seen = None, []
    empty = (
        columns.split(", season")[0] + ", season_stats array<struct<season:int,gp:int,pts:double,"
        "reb:double,ast:double>>, scoring_class string, years_since_last_season int, "
        "current_season int, is_active boolean, elements bigint"
    )
    heads = frame(empty, [])
    for season in (2000, 2001, 2002):
        rows = [(*own, season, 3, 21.0, 1.0, 1.0)] if season != 2001 else []
        new, _ = segment_step(heads, frame(columns, rows), h, season, 2)
        heads = spark.createDataFrame(new.collect(), new.schema)
        row = heads.first()
        seen.append((row.years_since_last_season, row.is_active, row.elements, row.scoring_class))
    assert seen == [(0, True, 1, "star"), (1, False, 1, "star"), (0, True, 2, "star")]
