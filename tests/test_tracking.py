import pytest
from conftest import rows_of

from tidemark.operators.tracking import (
    track_state_step,
    track_state_through,
    tracked_seasons,
)
from tidemark.sources.schemas import PLAYER_TRACKING

TODAY = "player_name string, season int, start_season int, is_active boolean"


def state(frame, prev, today, corrected=False):
    before = frame(PLAYER_TRACKING.schema, [("p", 1999, 1990, 1995, s) for s in prev])
    now = frame(TODAY, [("p", 2000, *t) for t in today])
    (row,) = track_state_step(before, now, corrected).collect()
    assert (row.player_name, row.season) == ("p", 2000)
    return row.state, row.start_season, row.last_season


def test_branches(frame):
    assert state(frame, [], [(2000, True)]) == ("New", 2000, 2000)
    assert state(frame, ["New"], [(1990, False)]) == ("Retired", 1990, 1995)
    assert state(frame, ["Retired"], [(1990, True)]) == ("Returned from Retirement", 1990, 2000)
    assert state(frame, ["Retired"], [(1990, False)]) == ("Stayed Retired", 1990, 1995)
    assert state(frame, ["New"], [(1990, True)]) == ("Continued Playing", 1990, 2000)
    # A player without a row today keeps a key and the next season.
    assert state(frame, ["Retired"], []) == ("Continued Playing", 1990, 1995)
    # First seen idle, long after the start.
    assert state(frame, [], [(1990, False)]) == ("Continued Playing", 1990, None)


def test_stayed_retired_leads_nowhere_unless_corrected(frame):
    assert state(frame, ["Stayed Retired"], [(1990, False)])[0] == "Continued Playing"
    assert state(frame, ["Stayed Retired"], [(1990, False)], True)[0] == "Stayed Retired"
    assert state(frame, ["Stayed Retired"], [(1990, True)], True)[0] == "Returned from Retirement"


@pytest.mark.parametrize("corrected", [False, True])
def test_steps_equal_one_pass(spark, frame, corrected):
    played = {"a": "110001", "b": "010100", "c": "000001", "d": "111111", "e": "100001"}
    rows = [
        (name, 2000 + i, 2000 + flags.index("1"), flag == "1")
        for name, flags in played.items()
        for i, flag in enumerate(flags)
        if i >= flags.index("1")
    ]
    seasons = frame(TODAY, rows)
    table = spark.createDataFrame([], PLAYER_TRACKING.schema)
    every = None
    for year in range(2000, 2006):
        step = track_state_step(table, seasons.where(f"season = {year}"), corrected)
        table = spark.createDataFrame(step.collect(), PLAYER_TRACKING.schema)
        every = table if every is None else every.unionByName(table)
    assert rows_of(every) == rows_of(track_state_through(seasons, corrected))


def test_only_starts_reached_by_a_season_count(frame):
    players = frame(
        "player_name string, is_active boolean, current_season int, "
        "season_stats array<struct<season:int>>",
        [
            ("p", True, 2000, [(1998,), (2000,)]),
            ("early", True, 1997, [(1997,)]),
            ("empty", False, 2000, []),
        ],
    )
    scd = frame(
        "player_name string, start_season int",
        [("p", 1999), ("p", 1998), ("early", 1998), ("empty", 1990)],
    )
    assert rows_of(tracked_seasons(players, scd)) == [("p", 2000, 1998, True)]
