"""Shuffles and buckets that follow the size of the input."""

import re
from pathlib import Path

import pytest
from conftest import rows_of

from tidemark import session
from tidemark.sources import store
from tidemark.sources.schemas import PLAYER_SEASONS
from tidemark.sources.store import ShelfStore, shelved
from tidemark.sources.views import parquet_reader

NAMES = (*session.INPUT_SETTINGS, session.INITIAL_WIDTH, session.INPUT_READ)


@pytest.fixture
def settings(spark):
    """The session's own settings, put back afterwards."""
    old = {name: spark.conf.get(name, None) for name in NAMES}
    yield
    for name, value in old.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def written(spark, tmp_path):
    spark.range(2000).repartition(1).write.parquet(f"{tmp_path}/t.parquet")
    return f"{tmp_path}"


def test_shuffles_start_wider_for_a_larger_input(spark, tmp_path, settings, monkeypatch):
    folder = written(spark, tmp_path)
    monkeypatch.setattr(session, "WIDTH_BYTES", 100)
    rows = parquet_reader(spark, folder)("t").distinct()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert int(re.search(r"hashpartitioning\(id#\d+L, (\d+)\)", plan)[1]) > 50
    assert rows.count() == 2000


def test_a_small_input_leaves_the_sessions_width(spark, tmp_path, settings):
    rows = parquet_reader(spark, written(spark, tmp_path))("t").distinct()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(id#\d+L, 4\)", plan)


def test_stores_have_more_buckets_for_a_larger_input(spark, tmp_path, settings, monkeypatch):
    parquet_reader(spark, written(spark, tmp_path))("t")
    assert store.new_store(spark, 2).buckets == 2
    monkeypatch.setattr(session, "BUCKET_BYTES", 1000)
    assert store.new_store(spark, 2).buckets > 5


def test_rewriting_shelves_writes_no_checkpoint(spark, frame, tmp_path):
    """Rows come from the shelves they replace, in the job that writes; emptied shelves go."""
    kept, table = ShelfStore(spark, str(tmp_path), 4), shelved(PLAYER_SEASONS)
    told = [(f"p{n}", 2000, *[None] * (len(PLAYER_SEASONS.schema) - 2)) for n in range(20)]
    rows = kept.on_shelves(frame(PLAYER_SEASONS.schema, told), "player_name")
    written = set(Path(session.shared_folder(spark)).glob("**/rdd-*"))
    kept.rewrite(table, rows, range(4))
    gone = kept.touched(rows)[0]
    left = kept.read(table).where(f"shelf <> {gone}")
    expected = rows_of(left)
    kept.rewrite(table, left, range(4))
    assert rows_of(kept.read(table)) == expected
    assert not (tmp_path / table.name / f"shelf={gone}").exists()
    assert set(Path(session.shared_folder(spark)).glob("**/rdd-*")) == written


def test_widths_are_a_multiple_of_the_buckets(spark, settings):
    spark.conf.set(session.INITIAL_WIDTH, "100")
    spark.conf.set(session.INPUT_READ, str(33 * session.BUCKET_BYTES))
    assert session.buckets_for(spark, 2) == 50
    spark.conf.set(session.INPUT_READ, str(200 * session.BUCKET_BYTES))
    assert session.buckets_for(spark, 2) == 200
