import os
import subprocess
import sys
import time
from datetime import date
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import datelist
from tidemark.operators.scd import PLAYER_SCD, scd2_build, scd2_step
from tidemark.sources.schemas import (
    DEVICE_HITS_DASHBOARD,
    HOST_ACTIVITY_REDUCED,
    PLAYERS,
    PLAYERS_SCD,
    USERS_CUMULATED,
    VERTICES,
)
from tidemark.sources.store import BucketedStore, SnapshotStore, upsert_rows


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path))


@pytest.fixture(params=["plain", "bucketed"])
def any_store(request, spark, tmp_path):
    if request.param == "plain":
        return SnapshotStore(spark, str(tmp_path))
    return BucketedStore(spark, str(tmp_path), 3)


def test_never_written_is_empty(any_store):
    assert any_store.read(USERS_CUMULATED).count() == 0
    assert any_store.read(USERS_CUMULATED, date(2024, 1, 1)).columns == USERS_CUMULATED.schema.names


def test_daily_steps_are_repeatable(any_store, frame):
    """Building a day again from the day before leaves the same table."""
    active = frame(
        "user_id string, date_active date",
        [("a", date(2024, 1, 1)), ("a", date(2024, 1, 2)), ("b", date(2024, 1, 2))],
    )
    for n in (1, 2, 2, 3, 2):
        before = date(2024, 1, n - 1) if n > 1 else date(2023, 12, 31)
        prev = any_store.read(USERS_CUMULATED, before)
        today = active.where(active.date_active == date(2024, 1, n))
        step = datelist.datelist_step(prev, today, ["user_id"], "dates_active")
        any_store.replace(USERS_CUMULATED, step)
    assert rows_of(any_store.read(USERS_CUMULATED)) == rows_of(
        frame(
            USERS_CUMULATED.schema,
            [
                ("a", [date(2024, 1, 1)], date(2024, 1, 1)),
                ("a", [date(2024, 1, 2), date(2024, 1, 1)], date(2024, 1, 2)),
                ("b", [date(2024, 1, 2)], date(2024, 1, 2)),
                ("a", [date(2024, 1, 2), date(2024, 1, 1)], date(2024, 1, 3)),
                ("b", [date(2024, 1, 2)], date(2024, 1, 3)),
            ],
        )
    )


def test_one_period_is_a_pruned_read(any_store, frame):
    rows = [("u", [date(2024, 1, n)], date(2024, 1, n)) for n in (1, 2, 3)]
    any_store.replace(USERS_CUMULATED, frame(USERS_CUMULATED.schema, rows))
    one = any_store.read(USERS_CUMULATED, date(2024, 1, 2))
    assert len(one.inputFiles()) == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert rows_of(one, "date") == [(date(2024, 1, 2),)]


def test_columns_are_written_by_name(any_store, frame):
    shuffled = frame(
        "end_season int, start_season int, is_active boolean, current_season int, "
        "player_name string, scoring_class string",
        [(2001, 2000, True, 2001, "p", "star")],
    )
    any_store.replace(PLAYERS_SCD, shuffled)
    assert rows_of(any_store.read(PLAYERS_SCD)) == [("p", "star", True, 2001, 2000, 2001)]


@pytest.mark.parametrize("periods", [None, [1]])
def test_upsert(store, frame, periods):
    schema = HOST_ACTIVITY_REDUCED.schema
    before = [(1, "a", [1], [1]), (1, "b", [2], [2]), (2, "a", [3], [3])]
    source = [(1, "b", [9, 2], [9, 2]), (1, "c", [5], None)]
    want = [(1, "a", [1], [1]), (1, "b", [9, 2], [9, 2]), (1, "c", [5], None), (2, "a", [3], [3])]
    store.replace(HOST_ACTIVITY_REDUCED, frame(schema, before), gather=True)
    untouched = store.read(HOST_ACTIVITY_REDUCED, 2).inputFiles()
    store.upsert(HOST_ACTIVITY_REDUCED, frame(schema, source), periods)
    assert rows_of(store.read(HOST_ACTIVITY_REDUCED)) == want
    kept = [f for f in store.read(HOST_ACTIVITY_REDUCED, 2).inputFiles() if "month=2" in f]
    assert kept == [f for f in untouched if "month=2" in f]
    merged = upsert_rows(frame(schema, before), frame(schema, source), ["host", "month"])
    assert rows_of(merged) == want


def test_bucketed_snapshot_is_not_shuffled(spark, tmp_path, frame):
    """Only the new facts move; each bucket is one file, found again by folder."""
    store = BucketedStore(spark, str(tmp_path), 3)
    day, before = date(2024, 1, 2), date(2024, 1, 1)
    rows = [(str(u), [before], before) for u in range(50)]
    store.replace(USERS_CUMULATED, frame(USERS_CUMULATED.schema, rows))
    today = frame("user_id string, date_active date", [(str(u), day) for u in range(40, 60)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    step = datelist.datelist_step(
        store.read(USERS_CUMULATED, before), today, ["user_id"], "dates_active"
    )
    plan = step._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan
    store.replace(USERS_CUMULATED, step)
    files = list((tmp_path / "users_cumulated" / "date=2024-01-02").glob("*.parquet"))
    assert len(files) == 3

    spark.sql(f"DROP TABLE {store.table_name(USERS_CUMULATED)}")
    again = BucketedStore(spark, str(tmp_path), 3)
    assert again.read(USERS_CUMULATED, day).count() == 60


def test_tables_without_periods_are_replaced_whole(any_store, frame):
    for hits in (1, 2):
        rows = [("os_type", "os", "(overall)", "(overall)", hits)]
        any_store.replace(DEVICE_HITS_DASHBOARD, frame(DEVICE_HITS_DASHBOARD.schema, rows))
    assert rows_of(any_store.read(DEVICE_HITS_DASHBOARD), "number_of_hits") == [(2,)]


def test_text_periods(any_store, frame):
    rows = [("1", "player", "{}"), ("1", "team", "{}")]
    any_store.replace(VERTICES, frame(VERTICES.schema, rows))
    any_store.replace(VERTICES, frame(VERTICES.schema, [("2", "team", "{}")]))
    assert rows_of(any_store.read(VERTICES), "identifier", "type") == [
        ("1", "player"),
        ("2", "team"),
    ]
    assert rows_of(any_store.read(VERTICES, "team"), "identifier") == [("2",)]


def test_create_as(spark, store, frame):
    store.create_as("hits_report", frame("level string, hits bigint", [("os", 3)]))
    assert rows_of(spark.table("hits_report")) == [("os", 3)]
    spark.sql("DROP TABLE hits_report")


def test_shared_folder_is_the_sessions(spark):
    folder = session.shared_folder(spark)
    assert folder == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_shuffles_widen_with_the_input():
    small, large = session.sized_settings(1), session.sized_settings(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert 50_000 < int(large["spark.sql.shuffle.partitions"]) < 200_000


def test_history_step_on_buckets_moves_nothing(spark, tmp_path, frame):
    """Snapshot and history are both bucketed by player, so their join needs no shuffle."""
    store = BucketedStore(spark, str(tmp_path), 3)
    names = [f"p{n}" for n in range(20)]
    stats = [(2000, 5, 12.0, 1.0, 1.0)]
    for season in (2000, 2001):
        rows = [
            (n, "h", "c", "x", "1990", "1", "1", stats, "bad", 0, season, season == 2000)
            for n in names
        ]
        store.replace(PLAYERS, frame(PLAYERS.schema, rows))
    first = scd2_build(store.read(PLAYERS, 2000), PLAYER_SCD, 2000)
    store.replace(PLAYERS_SCD, first)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    step = scd2_step(
        store.read(PLAYERS_SCD, 2000), store.read(PLAYERS, 2001), PLAYER_SCD, 2000
    )
    plan = step._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan
    assert step.count() == 40


REOPENED = """
import sys
from datetime import date
from tidemark.operators import datelist
from tidemark.session import get_session
from tidemark.sources.schemas import USERS_CUMULATED
from tidemark.sources.store import BucketedStore

folder, width, warehouse = sys.argv[1], sys.argv[2], sys.argv[3]
spark = get_session(
    "reopened",
    "local[2]",
    {"spark.sql.shuffle.partitions": width, "spark.sql.warehouse.dir": warehouse,
     "spark.sql.autoBroadcastJoinThreshold": "-1",
     "spark.sql.adaptive.coalescePartitions.enabled": "false"},
)
store = BucketedStore(spark, folder)
day, before = date(2024, 1, 2), date(2024, 1, 1)
today = spark.createDataFrame(
    [(str(u), day) for u in range(500, 1500)], "user_id string, date_active date"
)
step = datelist.datelist_step(
    store.read(USERS_CUMULATED, before), today, ["user_id"], "dates_active"
)
print("ROWS", step.count(), step.select("user_id").distinct().count(), store.buckets)
"""


@pytest.mark.parametrize("width", [4, 16])
def test_buckets_travel_with_the_data(spark, tmp_path, frame, width):
    """Another session, with fewer or more shuffle partitions, sees the same rows."""
    folder = str(tmp_path / "store")
    store = BucketedStore(spark, folder, 8)
    before = date(2024, 1, 1)
    rows = [(str(u), [before], before) for u in range(1000)]
    store.replace(USERS_CUMULATED, frame(USERS_CUMULATED.schema, rows))
    root = Path(__file__).resolve().parent.parent
    said = subprocess.run(
        [sys.executable, "-c", REOPENED, folder, str(width), str(tmp_path / "warehouse")],
        capture_output=True,
        text=True,
        cwd=tmp_path,
        env=os.environ | {"PYTHONPATH": str(root)},
        timeout=300,
    )
    assert "ROWS 1500 1500 8" in said.stdout, said.stderr[-2000:]


def test_bucket_count_is_the_stores(spark, tmp_path, frame):
    folder = str(tmp_path / "store")
    with pytest.raises(ValueError, match="is new"):
        BucketedStore(spark, folder)
    store = BucketedStore(spark, folder, 3)
    day = date(2024, 1, 1)
    store.replace(USERS_CUMULATED, frame(USERS_CUMULATED.schema, [("u", [day], day)]))
    assert BucketedStore(spark, folder).buckets == 3
    with pytest.raises(ValueError, match="3 buckets"):
        BucketedStore(spark, folder, 4)
    other = BucketedStore(spark, str(tmp_path / "other"), 3)
    assert other.table_name(USERS_CUMULATED) != store.table_name(USERS_CUMULATED)
    assert other.read(USERS_CUMULATED).count() == 0


def test_results_outlive_the_store(spark, tmp_path, frame):
    folder = tmp_path / "store"
    store = BucketedStore(spark, str(folder), 2)
    day = date(2024, 1, 1)
    store.replace(USERS_CUMULATED, frame(USERS_CUMULATED.schema, [("u", [day], day)]))
    name = store.table_name(USERS_CUMULATED)
    kept = store.result(store.read(USERS_CUMULATED), USERS_CUMULATED)
    assert not folder.exists() and not spark.catalog.tableExists(name)
    assert rows_of(kept) == [("u", [day], day)]


@pytest.mark.parametrize("gather", [False, True])
def test_backfill_into_buckets(spark, tmp_path, frame, gather):
    """Gathered, every period has one file per bucket; the rows are the same."""
    store = BucketedStore(spark, str(tmp_path), 2)
    days = [date(2024, 1, n) for n in (1, 2, 3)]
    rows = [(str(u), [d], d) for u in range(30) for d in days]
    store.replace(
        USERS_CUMULATED, frame(USERS_CUMULATED.schema, rows).repartition(4, "date"), gather
    )
    assert rows_of(store.read(USERS_CUMULATED)) == sorted(rows, key=repr)
    files = list((tmp_path / "users_cumulated").glob("date=*/*.parquet"))
    assert len(files) == 6


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = manager.diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_on_disk(spark, any_store, frame):
    rows = [(str(u), [date(2024, 1, 1)], date(2024, 1, 1)) for u in range(50)]
    dealt = frame(USERS_CUMULATED.schema, rows).repartition(3, "user_id")
    before, until = shuffle_files(spark), time.time() + 20
    any_store.replace(USERS_CUMULATED, dealt, gather=True)
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert any_store.read(USERS_CUMULATED).count() == 50
    assert dealt.count() == 50


def test_a_table_never_written_is_known_to_be_empty(any_store):
    empty = any_store.read(USERS_CUMULATED)
    assert empty.columns == USERS_CUMULATED.schema.names and empty.count() == 0
    plan = empty.join(empty.sparkSession.range(3), F.lit(True), "left")
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_gathered_upsert_has_one_file_per_bucket_and_period(spark, tmp_path, frame):
    store = BucketedStore(spark, str(tmp_path), 2)
    schema = HOST_ACTIVITY_REDUCED.schema
    first = [(m, f"h{n}", [n], [n]) for m in (1, 2) for n in range(20)]
    more = [(1, f"h{n}", [n, n], [n]) for n in range(10, 30)]
    for rows in (first, more):
        source = frame(schema, rows).repartition(4)
        store.upsert(HOST_ACTIVITY_REDUCED, source, sorted({r[0] for r in rows}), gather=True)
    want = {(r[0], r[1]): r for r in first + more}
    assert rows_of(store.read(HOST_ACTIVITY_REDUCED)) == sorted(want.values(), key=repr)
    assert len(list((tmp_path / HOST_ACTIVITY_REDUCED.name).glob("month=*/*.parquet"))) == 4


def test_a_table_handed_over_is_not_copied(spark, tmp_path, frame):
    """Its files stay, those of other tables go."""
    folder = tmp_path / "store"
    store = SnapshotStore(spark, str(folder))
    store.replace(VERTICES, frame(VERTICES.schema, [("1", "team", "{}"), ("2", "game", "{}")]))
    store.replace(PLAYERS_SCD, frame(PLAYERS_SCD.schema, [("p", "star", True, 2001, 2000, 2001)]))
    found = store.handed_over(store.read(VERTICES), VERTICES, PLAYERS_SCD)
    assert [p.name for p in folder.iterdir()] == [VERTICES.name]
    assert all(str(folder) in name for name in found.inputFiles())
    assert rows_of(found) == [("1", "team", "{}"), ("2", "game", "{}")]


def test_kinds_have_a_file_each_and_settings_are_put_back(spark, tmp_path, frame):
    """A period of few declared kinds: each task keeps a file open for each."""
    store = SnapshotStore(spark, str(tmp_path))
    rows = [(str(n), ("team", "game", "player")[n % 3], "{}") for n in range(30)]
    seen = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    store.replace(VERTICES, frame(VERTICES.schema, rows).coalesce(1))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == seen
    assert rows_of(store.read(VERTICES)) == sorted(((a, b, c) for a, b, c in rows), key=repr)
    assert len(list((tmp_path / "vertices").glob("type=*/*.parquet"))) == 3
