from conftest import rows_of

from tidemark.operators import cubes

POINTS = "player_id int, season int, team_id int, pts int"


def test_dashboard(frame):
    others = [(2, "/b"), (3, "/c"), (9, "/d"), (None, "/e")]
    events = frame("device_id int, url string", [(1, "/a")] * 3 + others)
    devices = frame(
        "device_id int, os_type string, device_type string, browser_type string",
        [(1, "os1", "d1", "b1"), (2, "os1", None, "b2"), (3, None, "d1", "b1")],
    )
    got = rows_of(cubes.device_dashboard(events, devices))
    full = "os_type__device_type__browser"
    over = "(overall)"
    assert got == sorted(
        [
            (full, "os1", "d1", "b1", 3),
            (full, "os1", "unknown", "b2", 1),
            (full, "unknown", "d1", "b1", 1),
            ("os_type", "os1", over, over, 4),
            ("os_type", "unknown", over, over, 1),
            ("device_type", over, "d1", over, 4),
            ("device_type", over, "unknown", over, 1),
            ("browser_type", over, over, "b1", 4),
            ("browser_type", over, over, "b2", 1),
        ],
        key=repr,
    )


def test_leaderboard(frame):
    rows = frame(
        POINTS,
        [
            (1, 2000, 10, 5),
            (1, 2001, 10, 7),
            (2, 2000, 20, 9),
            (3, 2000, 20, None),
            (2, 2000, 30, 1),
        ],
    )
    got = cubes.leaderboard(rows, "player_id", "season", "pts").collect()
    # The overall row carries the total of everything and leads.
    assert [tuple(r) for r in got] == [("(overall)", 22), ("1", 12), ("2", 10)]
    seasons = cubes.leaderboard(rows, "player_id", "season", "pts", corrected=True)
    assert rows_of(seasons) == [("1", 7), ("2", 10)]
    teams = cubes.leaderboard(rows, "player_id", "team_id", "pts", corrected=True)
    assert rows_of(teams) == [("1", 12), ("2", 9)]


def test_unknown_player_is_not_the_overall_row(frame):
    rows = frame(POINTS, [(None, 2000, 10, 5), (1, 2000, 10, 1)])
    got = cubes.leaderboard(rows, "player_id", "season", "pts")
    assert rows_of(got) == [("(overall)", 6), ("1", 1), (None, 5)]


def test_wins(frame):
    games = frame(
        "game_id int, home_team_id int, visitor_team_id int, home_team_wins int",
        [(1, 10, 20, 1), (2, 10, 20, 0), (3, 20, 10, 1), (4, 10, 20, 1)],
    )
    details = frame("game_id int", [(1,), (1,), (1,), (2,), (3,)])
    assert rows_of(cubes.wins_leaderboard(games, details)) == [
        ("(overall)", 5),
        ("10", 3),
        ("20", 2),
    ]
    assert rows_of(cubes.wins_leaderboard(games, corrected=True)) == [
        ("(overall)", 4),
        ("10", 2),
        ("20", 2),
    ]


def test_finest_sets_add_up_to_the_whole(frame):
    rows = frame(POINTS, [(i % 5, i % 3, i % 2, i) for i in range(60)])
    sums = cubes.grouping_set_sums(
        rows, ("player_id", "season"), (("player_id", "season"), ()), "pts"
    )
    parts = {0: 0, 1: 0}
    for r in sums.collect():
        parts[r["_rolled_player_id"]] += r.total
    assert parts == {0: sum(range(60)), 1: sum(range(60))}
