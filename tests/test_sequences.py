"""Ordered patterns against brute force, with cells and slices made small."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators import ordered, sequences

START = date(2020, 1, 1)
URLS = ["/signup", "/login"]


@pytest.fixture(params=[2, 5, 1 << 20])
def width(request, monkeypatch):
    monkeypatch.setattr(ordered, "ID_WIDTH", request.param)
    return request.param


def played_rows(seed, share):
    """Rows of four players; one player holds about ``share`` of them."""
    rng = random.Random(seed)
    rows = []
    for game in range(240):
        player = 1 if rng.random() < share else rng.randint(2, 4)
        day = START + timedelta(days=rng.randint(0, 12))
        rows.append((player, day, game, rng.random() < 0.7))
    return rows


def best_streaks(rows):
    best = {}
    for player in {r[0] for r in rows}:
        run = []
        for _, day, _, hit in sorted(r for r in rows if r[0] == player):
            run = [*run, day] if hit else []
            if len(run) > best.get(player, (0,))[0]:
                best[player] = (len(run), run[0], run[-1])
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_streaks(frame, width, seed):
    rows = played_rows(seed, 0.5)
    df = frame("player int, day date, game bigint, hit boolean", rows)
    got = sequences.longest_streak(df, "player", "day", "game", "hit", top=None)
    want = [(p, s, e, n) for p, (n, s, e) in best_streaks(rows).items()]
    assert rows_of(got) == sorted(want, key=repr)
    first = sequences.longest_streak(df, "player", "day", "game", "hit").collect()
    assert [tuple(r) for r in first] == [min(want, key=lambda w: (-w[3], w[0], w[1]))]


def test_streak_of_only_hits_or_misses(frame, width):
    rows = [(1, START + timedelta(days=i // 4), i, True) for i in range(20)]
    rows += [(2, START, 100 + i, False) for i in range(5)]
    rows += [(3, START, 199, None), (3, START, 200, True)]
    df = frame("player int, day date, game bigint, hit boolean", rows)
    got = sequences.longest_streak(df, "player", "day", "game", "hit", top=None)
    assert rows_of(got) == [
        (1, START, START + timedelta(days=4), 20),
        (3, START, START, 1),
    ]


def game_rows(seed, n):
    rng = random.Random(seed)
    return [
        (
            g,
            START + timedelta(days=rng.randint(0, 20)),
            1 if rng.random() < 0.6 else rng.randint(2, 4),
            rng.randint(5, 7),
            rng.randint(0, 1),
        )
        for g in range(n)
    ]


GAMES = (
    "game_id bigint, game_date_est date, home_team_id int, visitor_team_id int, home_team_wins int"
)


def best_windows(games, n, only_wins):
    played = {}
    for game, day, home, visitor, home_wins in sorted(games, key=lambda g: (g[1], g[0])):
        played.setdefault(home, []).append(home_wins)
        played.setdefault(visitor, []).append(1 - home_wins)
    best = {}
    for team, won in played.items():
        if only_wins:
            won = [w for w in won if w]
        counts = [sum(won[max(0, i - n + 1) : i + 1]) for i in range(len(won))]
        if counts:
            best[team] = max(counts)
    return best


@pytest.mark.parametrize("n", [1, 7, 90])
def test_rolling_wins(frame, n):
    games = game_rows(5, 300)
    got = sequences.rolling_wins(frame(GAMES, games), n, top=None)
    assert rows_of(got) == sorted(best_windows(games, n, True).items())


@pytest.mark.parametrize("n", [1, 7, 90])
@pytest.mark.parametrize("size", [1, 16, 1 << 17])
def test_rolling_wins_of_games(frame, width, monkeypatch, n, size):
    monkeypatch.setattr(sequences, "SLICE_ROWS", size)
    games = game_rows(6, 300)
    df = frame(GAMES, games)
    want = best_windows(games, n, False)
    got = sequences.rolling_wins_of_games(df, n, top=None)
    assert rows_of(got) == sorted(want.items())
    top = sequences.rolling_wins_of_games(df, n).collect()
    assert [tuple(r) for r in top] == [min(want.items(), key=lambda w: (-w[1], w[0]))]


def test_rolling_wins_of_undated_games(frame):
    """Games without a date count, before all others."""
    games = [(g, date(2024, 1, 1 + g) if g < 20 else None, 1, 2, 1) for g in range(40)]
    df = frame(
        "game_id int, game_date_est date, home_team_id int, visitor_team_id int, "
        "home_team_wins int",
        games,
    )
    got = sequences.rolling_wins_of_games(df, 90, top=None)
    assert rows_of(got) == [(1, 40), (2, 0)]


def test_totals_before(frame):
    rng = random.Random(3)
    cells = [(k, d, c, rng.randint(0, 9)) for k in (1, 2) for d in range(4) for c in range(3)]
    df = frame("k int, d int, c int, n bigint", cells)
    got = ordered.totals_before(df, ["k"], ["d", "c"], "n")
    want = [
        (k, d, c, n, sum(m for j, e, b, m in cells if j == k and (e, b) < (d, c)))
        for k, d, c, n in cells
    ]
    assert rows_of(got) == sorted(want, key=repr)


def event_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        user = 1 if rng.random() < 0.4 else rng.choice([2, 3, 4, None])
        moment = datetime(2024, 1, rng.randint(1, 3), 23, 59, rng.randint(56, 59)) + timedelta(
            microseconds=rng.choice([0, 1, 250000])
        )
        rows.append((user, rng.choice([*URLS, "/view"]), moment))
    return rows


def brute_funnel(rows, corrected):
    chosen = [r for r in rows if r[0] is not None and r[1] in URLS]
    users = {}
    for user, url, moment in chosen:
        same = [r for r in chosen if r[0] == user and r[2].date() == moment.date()]
        if corrected:
            hits = 1
            reached = any(r[1] == URLS[1] and r[2] > moment for r in same)
        else:
            later = [r for r in same if r[2] >= moment]
            hits, reached = len(later), any(r[1] == URLS[1] for r in later)
        old = users.get((user, url), (0, 0))
        users[user, url] = (old[0] + hits, max(old[1], int(reached)))
    result = []
    for url in URLS:
        found = [v for (_, u), v in users.items() if u == url]
        if found:
            share = sum(v[1] for v in found) / len(found)
            result.append((url, len(found), sum(v[0] for v in found), share))
    return sorted(result, key=repr)


@pytest.mark.parametrize("corrected", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_funnel(frame, seed, corrected):
    rows = event_rows(seed)
    df = frame("user_id int, url string, event_time timestamp_ntz", rows)
    got = sequences.funnel(df, URLS, URLS[1], corrected).withColumn(
        "total_hits", F.col("total_hits").cast("long")
    )
    assert rows_of(got) == brute_funnel(rows, corrected)


def test_funnel_of_users_who_never_reach_the_target(frame):
    df = frame(
        "user_id int, url string, event_time timestamp_ntz",
        [
            (1, "/signup", datetime(2024, 1, 1)),
            (2, "/login", datetime(2024, 1, 1)),
            (3, "/login", None),
        ],
    )
    got = sequences.funnel(df, URLS, URLS[1]).select("url", "user_count", "pct_converted")
    assert rows_of(got) == [("/login", 1, 1.0), ("/signup", 1, 0.0)]


@pytest.mark.parametrize("seed", range(3))
def test_streak_steps_equal_one_pass(spark, frame, seed):
    """Days come in stretches, some players absent from some; runs cross their ends."""
    rng = random.Random(seed)
    rows = [
        (rng.randrange(6), date(2024, 1, 1 + g // 20), g, rng.random() < 0.8, g // 20)
        for g in range(400)
    ]
    rows += [(9, date(2024, 1, 1 + n), 1000 + n, True, n) for n in range(20)]
    rows += [(10, date(2024, 1, 5), 2000, None, 4), (11, date(2024, 1, 5), 2001, False, 4)]
    schema = "player int, day date, game int, hit boolean, part int"
    cuts = sorted(rng.sample(range(1, 20), 4))
    state = None
    for low, high in zip([0, *cuts], [*cuts, 20]):
        today = frame(schema, [r for r in rows if low <= r[4] < high])
        part = sequences.run_summaries(today, "player", "day", "game", "hit")
        state = part if state is None else sequences.extend_runs(state, part, "player")
        plain = sequences.stored_runs(state, "player")
        assert len(plain.columns) == 11
        kept = spark.createDataFrame(plain.collect(), plain.schema)
        state = sequences.runs_of_stored(kept, "player")
        known = frame(schema, [r for r in rows if r[4] < high])
        want = sequences.longest_streak(known, "player", "day", "game", "hit", top=None)
        assert rows_of(sequences.streaks_of(state, "player", None)) == rows_of(want)
