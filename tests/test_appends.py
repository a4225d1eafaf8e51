"""Key audits by appends against one audit of all rows."""

from pathlib import Path

import pytest
from conftest import rows_of

from tidemark.operators.quality import key_audit
from tidemark.sources.appends import AppendAudit
from tidemark.sources.schemas import FACT_ROWS
from tidemark.sources.store import ShelfStore

KEY = ["game_id", "team_id", "player_id"]
ROWS = "game_id bigint, team_id int, player_id bigint, n_rows int"


def files(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*_keys_shelved/**/*.parquet")}


@pytest.fixture
def audit(spark, tmp_path):
    return AppendAudit(ShelfStore(spark, str(tmp_path / "keys"), 16), FACT_ROWS)


def test_appends_equal_a_full_audit(frame, audit):
    loads = {
        1: [(g, g % 3, p, 0) for g in range(30) for p in range(3)],
        2: [(5, 2, 1, 0), (100, 1, 1, 0), (100, 1, 1, 1), (None, 1, 1, 0)],
        3: [(None, 1, 1, 0), (None, None, None, 0), (7, 1, 0, 0)],
        4: [],
    }
    told = []
    for load, rows in loads.items():
        told += rows
        found = rows_of(audit.append(frame(ROWS, rows), load))
        every = rows_of(key_audit(frame(ROWS, told), KEY))
        mine = {r[:3] for r in rows}
        assert found == [r for r in every if r[:3] in mine]
        assert rows_of(audit.violations()) == every


def test_a_load_given_again_takes_the_place_of_the_first(frame, audit):
    first = frame(ROWS, [(g, 0, 0, 0) for g in range(20)])
    audit.append(first, 1)
    audit.append(first, 1)
    assert audit.violations().count() == 0
    audit.append(frame(ROWS, [(3, 0, 0, 0), (4, 0, 0, 0)]), 2)
    assert [r[0] for r in rows_of(audit.violations())] == [3, 4]
    # A load that has lost a row since, on a shelf it no longer has rows on.
    audit.append(frame(ROWS, [(4, 0, 0, 0)]), 2)
    assert [r[0] for r in rows_of(audit.violations())] == [4]
    audit.append(frame(ROWS, []), 1)
    assert audit.violations().count() == 0


def test_other_shelves_are_not_written(frame, audit):
    audit.append(frame(ROWS, [(g, 0, 0, 0) for g in range(200)]), 1)
    before = files(audit.store.folder)
    audit.append(frame(ROWS, [(7, 0, 0, 0)]), 2)
    after = files(audit.store.folder)
    changed = {p.parent.name for p in before if after.get(p) != before[p]}
    assert len(changed) == 1 and len({p.parent.name for p in before}) > 8
