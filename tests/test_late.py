"""Late, corrected and withdrawn periods against a full build."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators.late import covers, history_of, splice
from tidemark.operators.scd import ACTOR_SCD, PLAYER_SCD, scd2_build

SNAPSHOT = "player_name string, current_season int, scoring_class string, is_active boolean"
ACTOR = "actorid string, actor string, current_year int, is_active boolean, quality_class string"
COVER = "player_name string, scoring_class string, is_active boolean, start_season int, end_season int"


def told(seed, keys=6, years=range(1990, 2004)):
    """Periods of keys, some missing, in a drawn order."""
    made = random.Random(seed)
    rows = [
        (f"p{k}" if k else None, year, made.choice(["star", "bad", None]), made.choice([True, False]))
        for k in range(keys)
        for year in years
        if made.random() < 0.7
    ]
    made.shuffle(rows)
    return rows


def spliced(spark, frame, loads, s=PLAYER_SCD, ddl=SNAPSHOT, cover=COVER):
    spans = frame(cover, [])
    for load in loads:
        got = splice(spans, frame(ddl, load), s)
        spans = spark.createDataFrame(got.collect(), got.schema)
    return spans


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_equals_the_full_build(spark, frame, seed, null_safe):
    rows = told(seed)
    spans = spliced(spark, frame, [rows[i::5] for i in range(5)])
    every = frame(SNAPSHOT, rows)
    assert rows_of(spans) == rows_of(covers(every, PLAYER_SCD))
    for as_of in (1989, 1996, 2003):
        got = history_of(spans, PLAYER_SCD, as_of, null_safe)
        assert rows_of(got) == rows_of(scd2_build(every, PLAYER_SCD, as_of, null_safe))


def test_a_late_period_splits_widens_and_joins(spark, frame):
    def after(*loads):
        return [r[1:] for r in rows_of(spliced(spark, frame, [[("p", *t) for t in x] for x in loads]))]

    wide = [(y, "star", True) for y in range(2000, 2005)]
    assert after(wide) == [("star", True, 2000, 2004)]
    assert after(wide, [(2002, "bad", True)]) == [
        ("bad", True, 2002, 2002), ("star", True, 2000, 2001), ("star", True, 2003, 2004)]
    assert after(wide, [(2002, "bad", True)], [(2002, "star", True)]) == [("star", True, 2000, 2004)]
    assert after(wide, [(1999, "star", True), (2005, "star", True)]) == [("star", True, 1999, 2005)]
    assert after(wide, [(2000, "bad", True), (2004, "bad", True)]) == [
        ("bad", True, 2000, 2000), ("bad", True, 2004, 2004), ("star", True, 2001, 2003)]
    # Unknown periods stay unknown: a later one may still differ.
    assert after([(2000, "star", True)], [(2004, "star", True)]) == [
        ("star", True, 2000, 2000), ("star", True, 2004, 2004)]


def test_corrections_and_withdrawals(spark, frame):
    rows = told(7)
    spans = covers(frame(SNAPSHOT, rows), PLAYER_SCD)
    gone = {r[:2] for r in rows[::4]}
    changed = {r[:2]: ("good", True) for r in rows[1::4]}
    late = frame(
        SNAPSHOT + ", withdrawn boolean",
        [(*k, None, None, True) for k in gone] + [(*k, *v, None) for k, v in changed.items()],
    )
    right = [(*r[:2], *changed.get(r[:2], r[2:])) for r in rows if r[:2] not in gone]
    want = covers(frame(SNAPSHOT, right), PLAYER_SCD)
    got = splice(spans, late, PLAYER_SCD)
    assert rows_of(got) == rows_of(want)
    # The same rows again change nothing; a key that lost all its periods is gone.
    assert rows_of(splice(got, late, PLAYER_SCD)) == rows_of(want)
    every = late.select("player_name", "current_season", "scoring_class", "is_active")
    all_gone = frame(SNAPSHOT, rows).unionByName(every).withColumn("withdrawn", F.lit(True))
    assert splice(got, all_gone, PLAYER_SCD).count() == 0


def test_odd_rows(spark, frame):
    spans = frame(COVER, [])
    late = frame(SNAPSHOT, [("p", None, "star", True), ("q", 2000, "bad", True), ("q", 2000, "star", True)])
    assert rows_of(splice(spans, late, PLAYER_SCD)) == [("q", "star", True, 2000, 2000)]
    one = frame(COVER, [("p", "star", True, 2000, 2001)])
    assert rows_of(splice(one, late.limit(0), PLAYER_SCD)) == rows_of(one)
    assert splice(spans, late.limit(0), PLAYER_SCD).count() == 0
    more = late.withColumns({"_cuts": F.lit(1), "start_season": F.lit(5), "_span": F.lit("x")})
    assert rows_of(splice(spans, more, PLAYER_SCD)) == [("q", "star", True, 2000, 2000)]


def test_carried_names(spark, frame):
    rows = [("a", "Bo", 2000, True, "star"), ("a", "Bow", 2001, True, "star"), ("a", "Bow", 2002, True, "star")]
    cover = ("actorid string, actor string, is_active boolean, quality_class string, "
             "start_year int, end_year int")
    spans = spliced(spark, frame, [[rows[2]], [rows[0]], [rows[1]]], ACTOR_SCD, ACTOR, cover)
    assert rows_of(history_of(spans, ACTOR_SCD, 2002)) == rows_of(
        scd2_build(frame(ACTOR, rows), ACTOR_SCD, 2002))
    assert spans.count() == 2
