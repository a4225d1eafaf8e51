"""Physical plans: what is pushed down, split, shared, and never used."""

import re
from datetime import date
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark import session
from tidemark.operators import facts, late
from tidemark.operators.scd import PLAYER_SCD
from tidemark.plans import QUERIES
from tidemark.plans.games import _months_apart
from tidemark.sources import views
from tidemark.sources.schemas import FACT_ROWS, PLAYER_COVERS
from tidemark.sources.store import BUCKET_SETTINGS, BucketedStore, ShelfStore, shelved
from tidemark.sources.views import parquet_reader

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test data")


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_of(spark, name):
    df = entry.queries()[name](spark, str(FOLDER))
    return df._jdf.queryExecution().executedPlan().toString()


# A stored query's plan reads its checkpoint; its steps are those of other queries.
STORED = ("_daily", "_yearly", "_stored", "_repaired", "_appended", "_any_order")
PLANNED = sorted(n for n in QUERIES if not n.endswith(STORED))


@pytest.mark.parametrize("name", PLANNED)
def test_no_pairing_of_everything_and_no_python(no_broadcast, name):
    plan = plan_of(no_broadcast, name)
    for banned in ("CartesianProduct", "NestedLoopJoin", "Python", "BroadcastExchange"):
        assert banned not in plan


ONE_PERIOD = (
    "cumulative_players_step",
    "cumulative_actors_step",
    "unnest_latest_seasons",
    "season_bounds",
    "first_latest_change",
    "growth_accounting_step",
    "user_activity_count",
)


@pytest.mark.parametrize("name", ONE_PERIOD)
def test_one_period_is_made_alone(spark, name):
    """No spine of all periods stands below a filter of one."""
    frame = entry.queries()[name](spark, str(FOLDER))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence" not in plan


def test_player_history_reads_no_statistics(spark):
    for name in ("scd2_build_players", "scd2_step_players"):
        frame = entry.queries()[name](spark, str(FOLDER))
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "draft_year" not in plan and "_new" not in plan


def test_day_filter_reaches_the_scan(spark):
    plan = plan_of(spark, "users_cumulated")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_of(spark, "fact_game_details")
    assert re.search(r"WindowGroupLimit .*Final", plan)
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_history_build_has_one_exchange_after_the_snapshots(spark, frame):
    from tidemark.operators.scd import PLAYER_SCD, scd2_build

    snapshots = frame(
        "player_name string, current_season int, scoring_class string, is_active boolean", []
    )
    built = scd2_build(snapshots, PLAYER_SCD, 2000)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_players_backfill_has_one_exchange(spark, frame):
    from tidemark.operators.cumulative import PLAYER_HISTORY, cumulate_backfill

    facts = frame(
        "player_name string, height string, college string, country string, draft_year string, "
        "draft_number string, draft_round string, season int, gp int, pts double, reb double, "
        "ast double",
        [],
    )
    plan = cumulate_backfill(facts, PLAYER_HISTORY, 2000)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange hashpartitioning") == 1


def test_late_periods_are_spliced_without_pairing_everything(no_broadcast, frame):
    ddl = "player_name string, scoring_class string, is_active boolean"
    spans = frame(f"{ddl}, start_season int, end_season int", [("p", "star", True, 2000, 2004)])
    told = frame(f"{ddl}, current_season int", [("p", "bad", True, 2002)])
    plan = late.splice(spans, told, PLAYER_SCD)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan


def test_other_shelves_are_not_listed(spark, frame, tmp_path):
    store, covers = ShelfStore(spark, str(tmp_path / "s"), 8), shelved(PLAYER_COVERS)
    rows = [(f"p{n}", "star", True, 2000, 2004) for n in range(40)]
    told = store.on_shelves(frame(PLAYER_COVERS.schema, rows), "player_name")
    store.rewrite(covers, told, range(8))
    plan = store.read_shelves(covers, [3])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*shelf#\d+ = 3", plan)


def test_streaks_shuffle_the_rows_once(spark, frame):
    from tidemark.operators.sequences import longest_streak

    rows = frame("p int, d date, g bigint, h boolean", [])
    plan = longest_streak(rows, "p", "d", "g", "h")._jdf.queryExecution().executedPlan()
    # Rows by cell, then cell summaries by day, then day summaries by key.
    assert plan.toString().count("Exchange hashpartitioning") == 3
    assert "Join" not in plan.toString()


def test_busy_key_of_a_join_is_split(spark, frame):
    """Half of the rows share one key: its partition is read by several tasks."""
    from pyspark.sql import functions as F

    from tidemark.operators.quality import one_per_key

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        ids = spark.range(0, 40000, 1, 8)
        key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50)
        rows = ids.select(key.alias("k"), F.col("id").alias("v"))
        names = spark.range(50).select(F.col("id").alias("k"), F.lit("n").alias("name"))
        # The window could reuse the join's partitioning and keep the key whole.
        joined = one_per_key(rows.join(names, "k"), ["k", "v"])
        assert joined.collect() and joined.count() == 40000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def test_details_of_some_games_are_chosen_before_items_are_read_into_them(no_broadcast):
    """Also of a game that is given twice with other teams; the rows are the same."""
    reader = parquet_reader(no_broadcast, str(FOLDER))
    twice = reader("orders").limit(40).withColumn("o_custkey", F.col("o_custkey") + 1)
    orders = reader("orders").unionByName(twice).localCheckpoint()
    table = lambda name: orders if name == "orders" else reader(name)
    chosen = views.games(table).where("home_team_id % 5 = 1")
    some = views.game_details(table, of=chosen)
    all_of_them = views.game_details(table)
    want = all_of_them.join(chosen.select("game_id"), "game_id", "left_semi")
    assert rows_of(some) == rows_of(want) != []
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner, (l_partkey") < plan.index("Join LeftSemi")
    assert plan.index("Join Inner, (l_orderkey") < plan.index("Join LeftSemi")


def test_stored_edges_are_not_copied(spark, tmp_path):
    """What is returned is read from the stored edges, and games are kept once a load."""
    kept = set(Path(session.shared_folder(spark)).glob("**/rdd-*"))
    edges = entry.queries()["edges_stored"](spark, str(FOLDER))
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan
    assert len(set(Path(session.shared_folder(spark)).glob("**/rdd-*")) - kept) <= 4


def test_stored_fact_in_parts_is_the_whole_and_not_copied(spark, monkeypatch):
    """A part of about 20 KB: months are stored some at a time, with no checkpoint of rows."""
    monkeypatch.setattr(session, "PART_BYTES", 20_000)
    written = []
    replace = BucketedStore.replace
    monkeypatch.setattr(
        BucketedStore, "replace", lambda s, t, *a, **k: written.append(t.name) or replace(s, t, *a, **k)
    )
    kept = set(Path(session.shared_folder(spark)).glob("**/rdd-*"))
    found = entry.queries()["fact_game_details_stored"](spark, str(FOLDER))
    assert written.count("fact_rows") > 4 + 3
    assert rows_of(found) == rows_of(entry.queries()["fact_game_details"](spark, str(FOLDER)))
    assert "ExistingRDD" not in found._jdf.queryExecution().executedPlan().toString()
    assert set(Path(session.shared_folder(spark)).glob("**/rdd-*")) == kept


def test_parts_are_of_whole_months(frame):
    days = [date(2000, m, d) for m in range(1, 13) for d in range(1, m + 1)] + [None] * 5
    games = frame("game_id int, game_date_est date", list(enumerate(days)))
    parts = [[r.game_date_est for r in p.collect()] for p in _months_apart(games, 3)]
    assert len(parts) == 3 and all(len(p) < 40 for p in parts)
    assert sorted(map(str, sum(parts, []))) == sorted(map(str, days))
    months = [{d and d.month for d in p} for p in parts]
    assert sum(map(len, months)) == len(set.union(*months)) == 13
    assert _months_apart(games, 1) == [games]
    assert _months_apart(games.where("false"), 3) == []


def test_a_stored_month_of_facts_is_not_moved_to_be_merged(no_broadcast, frame, tmp_path):
    """Only the batch is dealt; fact rows of the month lie by game already."""
    spark, store = no_broadcast, BucketedStore(no_broadcast, str(tmp_path), 3)
    width = len(FACT_ROWS.schema)
    rows = [(g, 1, p, *[None] * (width - 4), 200001) for g in range(9) for p in (1, 2)]
    held = frame(FACT_ROWS.schema, rows)
    store.replace(FACT_ROWS, store.dealt(FACT_ROWS, held))
    merged = facts.merge_facts(store.read(FACT_ROWS, 200001), store.dealt(FACT_ROWS, held))
    for name, value in BUCKET_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        plan = merged.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in BUCKET_SETTINGS:
            spark.conf.unset(name)
    assert plan.count("Exchange hashpartitioning(game_id") == plan.count("Exchange") == 1
    assert merged.count() == 18
    store.replace(FACT_ROWS, merged)
    assert store.read(FACT_ROWS).count() == 18
    assert len(list((tmp_path / "fact_rows" / "month=200001").glob("*.parquet"))) <= 3
