import json
import random
import re
from collections import defaultdict

import pytest
from conftest import rows_of

from tidemark.operators import graph
from tidemark.sources.schemas import EDGES

DETAILS = (
    "game_id int, team_id int, team_abbreviation string, player_id int, player_name string, "
    "start_position string, pts int"
)


def row(game, team, player, pts, name=None, abbreviation=None):
    return (
        game,
        team,
        abbreviation if abbreviation is not None else f"T{team}",
        player,
        name if name is not None else f"p{player:03}",
        "G",
        pts,
    )


def many_rows():
    """One game holds a third of all rows."""
    rng = random.Random(4)
    rows = [row(1, rng.randint(1, 2), p, rng.choice([None, 3, 8])) for p in range(60)]
    for game in range(2, 32):
        for player in rng.sample(range(60), 4):
            rows.append(row(game, rng.randint(1, 2), player, rng.randint(0, 9)))
    return rows + rows[:10]


def brute_pairs(rows):
    kept = {}
    for r in sorted(rows, key=lambda r: (r[6] is not None, r[6] or 0, r[1], r[2])):
        kept.setdefault((r[0], r[3]), r)
    sums = defaultdict(lambda: [0, None, None])
    for a in kept.values():
        for b in kept.values():
            if a[0] == b[0] and a[4] is not None and b[4] is not None and a[4] > b[4]:
                same = a[2] is not None and a[2] == b[2]
                entry = sums[str(a[3]), str(b[3]), "shares_team" if same else "plays_against"]
                entry[0] += 1
                for i, pts in ((1, a[6]), (2, b[6])):
                    if pts is not None:
                        entry[i] = (entry[i] or 0) + pts
    return sorted(((*k, *v) for k, v in sums.items()), key=repr)


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_pairs(frame, block_rows):
    rows = many_rows()
    edges = graph.player_edges(frame(DETAILS, rows), block_rows)
    got = []
    for e in edges.collect():
        p = json.loads(e.properties)
        assert list(p) == ["num_games", "subject_points", "object_points"]
        got.append((e.subject_identifier, e.object_identifier, e.edge_type, *p.values()))
    assert sorted(got, key=repr) == brute_pairs(rows)


def test_equal_and_missing_names_make_no_pair(frame):
    details = frame(
        DETAILS,
        [row(1, 1, 1, 2, "same"), row(1, 1, 2, 2, "same"), (1, 1, None, 3, None, "G", 2)],
    )
    assert graph.player_edges(details).count() == 0


def test_unknown_team_plays_against(frame):
    details = frame(DETAILS, [row(1, 1, 1, 2), (1, 1, None, 2, "q", "G", 2)])
    (edge,) = graph.player_edges(details).collect()
    assert (edge.subject_identifier, edge.edge_type) == ("2", "plays_against")


def test_vertices(frame):
    games = frame(
        "game_id int, pts_home int, pts_away int, home_team_wins int, home_team_id int, "
        "visitor_team_id int",
        [(1, 90, None, 1, 10, 20), (2, 80, 85, 0, 10, 20)],
    )
    got = {r.identifier: json.loads(r.properties) for r in graph.game_vertices(games).collect()}
    # Null properties are kept.
    assert got["1"] == {"pts_home": 90, "pts_away": None, "winning_team": 10}
    assert got["2"]["winning_team"] == 20

    details = frame(DETAILS, [row(1, 2, 7, 5), row(2, 1, 7, None), row(3, 2, 7, 6)])
    (player,) = graph.player_vertices(details).collect()
    assert json.loads(player.properties) == {
        "player_name": "p007",
        "number_of_games": 3,
        "total_points": 11,
        "teams": [1, 2],
    }

    teams = frame(
        "team_id int, abbreviation string, nickname string, city string, arena string, "
        "yearfounded int",
        [(1, "A", "n", "c", "r", 1950)] * 2 + [(2, "B", "n", "c", None, 1960)],
    )
    vertices = graph.team_vertices(teams)
    assert rows_of(vertices, "identifier", "type") == [("1", "team"), ("2", "team")]
    every = vertices.unionByName(graph.player_vertices(details))
    assert rows_of(graph.vertex_counts(every)) == [("player", 1), ("team", 2)]


def test_queries(frame):
    details = frame(
        DETAILS,
        [
            row(1, 1, 1, 10),
            row(1, 1, 2, 4),
            row(2, 1, 1, 30),
            row(2, 2, 2, None),
            row(3, 1, 3, None),
        ],
    )
    careers = graph.player_careers(details)
    best = graph.best_game(careers, graph.player_games(details)).collect()
    # A player without points comes first, as nulls lead in descending order.
    assert [tuple(r) for r in best] == [("p003", None), ("p001", 30), ("p002", 4)]
    pairs = graph.meetings(graph.player_games(details, "player_name"))
    stats = graph.pair_stats(careers, pairs)
    assert rows_of(stats) == [("p002", "1", 2.0, "4", "1"), ("p002", "1", 2.0, None, "1")]


LOADS = "player_id int, game_id int, start_position string, pts int, team_id int, " \
    "team_abbreviation string, player_name string"


def pairs_of(rows):
    return rows_of(rows, "subject_id", "object_id", "edge_type", *graph.SUMS)


@pytest.mark.parametrize("seed", range(3))
def test_loads_in_any_order_and_again_equal_all_at_once(spark, frame, seed):
    """Rows come in parts that cut through games; copies with other values among them."""
    made = random.Random(seed)
    rows = many_rows()
    rows += [(*r[:6], made.choice([None, 1, 5, 9])) for r in made.sample(rows, 30)]
    made.shuffle(rows)
    parts = [rows[i::4] for i in range(4)] + [rows[1::4], rows[:20]]
    stored, changes = frame(LOADS, []), None
    for part in parts:
        batch = graph.player_games(frame(DETAILS, part), "player_name")
        before, after = graph.changed_games(stored, batch)
        new = graph.pair_changes(before, after)
        new = spark.createDataFrame(new.collect(), new.schema)
        changes = new if changes is None else changes.unionByName(new)
        kept = stored.join(after, ["player_id", "game_id"], "left_anti").unionByName(after)
        stored = spark.createDataFrame(kept.select(*stored.columns).collect(), LOADS)
    assert new.count() == 0
    whole = graph.player_games(frame(DETAILS, rows), "player_name")
    assert rows_of(stored) == rows_of(whole.select(*stored.columns))
    assert pairs_of(graph.summed_pairs(changes)) == pairs_of(graph.meetings(whole))
    got = [
        (str(r.subject_id), str(r.object_id), r.edge_type, r.num_games, r.subject_points,
         r.object_points)
        for r in graph.summed_pairs(changes).collect()
    ]
    assert sorted(got, key=repr) == brute_pairs(rows)


def test_a_load_pairs_its_own_games_only(frame):
    """A stored game that a load does not name is not paired again."""
    stored = frame(LOADS, [(p, 1, "G", 2, 1, "T1", f"p{p}") for p in range(5)])
    batch = frame(LOADS, [(p, 2, "G", 3, 1, "T1", f"p{p}") for p in range(3)])
    before, after = graph.changed_games(stored, batch)
    assert before.count() == 0 and after.count() == 3
    assert graph.pair_changes(before, after).count() == 3


def test_a_pair_that_no_longer_met_goes(frame):
    """A better row moves a player to the other team: the relation changes."""
    one = frame(LOADS, [(1, 1, "G", 5, 1, "T1", "a"), (2, 1, "G", 5, 1, "T1", "b")])
    batch = frame(LOADS, [(2, 1, "F", 7, 2, "T2", "b")])
    none = frame(LOADS, [])
    first = graph.pair_changes(none, graph.changed_games(none, one)[1])
    second = graph.pair_changes(*graph.changed_games(one, batch))
    (pair,) = graph.summed_pairs(first.unionByName(second)).collect()
    assert (pair.edge_type, pair.num_games, pair.subject_points) == ("plays_against", 1, 7)


def test_pairs_are_shuffled_once_for_both_sides_and_edges_not_again(spark, frame):
    shown = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in shown}
    for name, value in shown.items():
        spark.conf.set(name, value)
    try:
        edges = graph.player_edges(frame(DETAILS, many_rows()))
        plan = edges.groupBy(*EDGES.key).count()._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    dealt = [line for line in plan.splitlines() if "- Exchange hashpartitioning" in line]
    # By player and game, by game for rows and for counts, by blocks, and by pair.
    assert len(dealt) == 5, plan
    assert sum("_low" in line for line in dealt) == 1
    assert "ReusedExchange" in plan


def test_changes_of_a_first_load_are_grouped_once(frame, spark):
    """Nothing was stored: pairs gained are summed and dealt once, and nothing is taken back."""
    after = frame(LOADS, [(p, 1, "G", 2, 1, "T1", f"p{p}") for p in range(5)])
    changes = graph.pair_changes(after.where("false"), after)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(subject_id", plan)) == 1
    assert plan.count("functions=[sum(") == 1 and "Union" not in plan
    assert changes.count() == 10
