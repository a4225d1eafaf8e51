from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.functions.scalars import clock_minutes, percent_change, ratio_or_whole
from tidemark.operators import quality
from tidemark.operators.facts import MEASURES, build_fact, fact_rows, merge_facts, shape_fact
from tidemark.sources.schemas import DECLARED, EDGES, PLAYERS_SCD


@pytest.fixture
def details(frame):
    measures = ", ".join(f"{m} int" for m in MEASURES)
    ddl = (
        "game_id int, team_id int, player_id int, team_abbreviation string, "
        f"player_name string, start_position string, comment string, min string, {measures}"
    )
    n = len(MEASURES)

    def row(game, team, player, comment, clock, value):
        return (game, team, player, f"T{team}", f"p{player}", "G", comment, clock, *[value] * n)

    return frame(
        ddl,
        [
            row(1, 10, 7, None, "12:30", 3),
            row(1, 10, 7, None, "12:30", 3),
            row(1, 10, 7, None, "11:00", 9),
            row(1, 20, 8, "DNP - Coach", None, None),
            row(1, 20, 9, "was DND", "5", 1),
            row(1, 20, 6, "NWT", "x:10", 1),
            row(2, 10, 7, "DNP DND", "0:06", 1),
            row(99, 10, 7, None, "1:00", 1),
        ],
    )


def test_fact(details, frame):
    games = frame(
        "game_id int, game_date_est date, season int, home_team_id int",
        [(1, None, 2000, 10), (2, None, 2001, 30)],
    )
    got = {
        (r.dim_season, r.dim_player_id): r for r in build_fact(details, games).collect()
    }
    assert len(got) == 5
    kept = got[2000, 7]
    # Of the copies, the first in column order.
    assert (kept.m_minutes, kept.m_pts, kept.dim_is_playing_at_home) == (11.0, 9, True)
    idle = got[2000, 8]
    assert (idle.dim_did_not_play, idle.dim_did_not_dress, idle.m_minutes) == (True, False, None)
    assert not idle.dim_is_playing_at_home
    assert (got[2000, 9].dim_did_not_dress, got[2000, 9].m_minutes) == (True, None)
    assert (got[2000, 6].dim_not_with_team, got[2000, 6].m_minutes) == (True, None)
    both = got[2001, 7]
    assert (both.dim_did_not_play, both.dim_did_not_dress, both.dim_not_with_team) == (
        True,
        True,
        False,
    )
    assert both.m_minutes == pytest.approx(0.1)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1, 0, 2), (1, 1, 2, 0)])
def test_batches_in_any_order_and_again_equal_one_pass(spark, details, frame, order):
    """Copies of a key lie in several batches, the one that is kept in the last or first."""
    games = frame(
        "game_id int, game_date_est date, season int, home_team_id int",
        [(1, date(2000, 1, 31), 2000, 10), (2, None, 2001, 30)],
    )
    rows = details.collect()
    batches = [
        fact_rows(spark.createDataFrame(rows[i::3], details.schema), games) for i in range(3)
    ]
    stored = spark.createDataFrame([], batches[0].schema)
    for i in order:
        merged = merge_facts(stored, batches[i])
        assert merged.columns == stored.columns
        stored = spark.createDataFrame(merged.collect(), merged.schema)
    assert rows_of(shape_fact(stored)) == rows_of(build_fact(details, games))
    assert {r.month for r in stored.collect()} == {200001, 0}


def test_clock_and_ratios(frame):
    clocks = frame("c string", [("1:30",), (None,), ("",), ("7",)])
    got = {r[0]: r[1] for r in clocks.select("c", clock_minutes(F.col("c"))).collect()}
    assert got == {"1:30": 1.5, None: None, "": None, "7": None}
    pairs = frame("a double, b double", [(0.0, 5.0), (4.0, 5.0), (4.0, 0.0)])
    change = pairs.select(percent_change(F.col("a"), F.col("b")))
    assert [r[0] for r in change.collect()] == [0.0, 25.0, -100.0]
    ratio = pairs.select(ratio_or_whole(F.col("a"), F.col("b")))
    assert [r[0] for r in ratio.collect()] == [0.0, 0.8, 4.0]


def test_key_and_name_audits(frame):
    rows = frame(
        "id int, name string",
        [(1, "a"), (1, "a"), (2, "b"), (2, "c"), (3, "d"), (4, None), (4, "e"), (None, "f")],
    )
    assert rows_of(quality.duplicate_keys(rows, ["id", "name"])) == [(1, "a", 2)]
    assert rows_of(quality.key_audit(rows, ["id"])) == [
        (1, 2, False),
        (2, 2, False),
        (4, 2, False),
        (None, 1, True),
    ]
    assert rows_of(quality.name_audit(rows, "id", "name")) == [(1, 1), (2, 2)]
    assert rows_of(quality.name_audit(rows, "id", "name", corrected=True)) == [(2, 2)]


def test_domain_and_profiles(frame):
    rows = frame("v string, n int", [("a", 3), ("x", 1), (None, 2), ("a", 3)])
    assert rows_of(quality.domain_audit(rows, "v", ["a", "b"])) == [("x", 1)]
    assert rows_of(quality.period_range(rows, "n")) == [(1, 3)]
    assert rows_of(quality.distinct_rows(rows)) == [("a", 3), ("x", 1), (None, 2)]
    assert rows_of(quality.distinct_values(rows, "v")) == [("a",), ("x",), (None,)]
    assert rows_of(quality.rows_with_prefix(rows, "v", "a")) == [("a", 3), ("a", 3)]


def test_table_audit(frame):
    rows = [
        ("p", "star", True, 2000, 1999, 2000),
        ("p", "good", True, 2000, 1999, 1999),
        ("q", "best", True, 2000, 1999, 2000),
        (None, None, True, 2000, 1999, 2000),
    ]
    audit = quality.table_audit(frame(PLAYERS_SCD.schema, rows), PLAYERS_SCD)
    assert rows_of(audit) == [
        ("players_scd", "key", 2),
        ("players_scd", "scoring_class", 1),
    ]


def test_parts_audit_is_that_of_all_rows(frame):
    rows = [
        ("player", "1", "game", "2", "plays_in"),
        ("player", "1", "game", "2", "plays_in"),
        ("player", None, "player", "2", "shares_team"),
        ("player", "1", "player", "2", "friends"),
    ]
    ddl = "subject_type string, subject_identifier string, object_type string, "
    ddl += "object_identifier string, edge_type string"
    parts = [frame(ddl, [r for r in rows if r[2] == kind]) for kind in ("game", "player")]
    audit = quality.parts_audit(parts, EDGES)
    assert rows_of(audit) == rows_of(quality.table_audit(frame(ddl, rows), EDGES))
    assert sum(r.n_violations for r in audit.collect()) == 3
    empty = quality.parts_audit([part.where("false") for part in parts], EDGES)
    assert [r.n_violations for r in empty.collect()] == [0] * (1 + len(EDGES.domains))


def test_declared_tables_have_columns_for_keys_and_domains():
    for table in DECLARED:
        names = set(table.schema.names)
        assert set(table.key) <= names
        assert set(table.domains) <= names
        assert table.period is None or table.period in names
