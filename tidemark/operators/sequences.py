"""Ordered patterns: rolling windows, streaks, funnels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of
from tidemark.operators.cubes import winner
from tidemark.operators.ordered import id_cell, totals_before

# Rows per slice of a team's games; each slice also sees the rows just before it.
SLICE_ROWS = 1 << 17


def _most_wins() -> list[Column]:
    return [F.desc("most_wins"), F.asc("team_id")]


def rolling_wins(games: DataFrame, n: int = 90, top: int | None = 1) -> DataFrame:
    """Most wins in a row window of ``n`` per team, as defined over won games only.

    Every row of such a window is a win, so the maximum is the number of wins up
    to ``n``: a count, with no window at all.
    """
    wins = games.groupBy(winner().alias("team_id")).agg(
        F.least(F.count(F.lit(1)), F.lit(n)).alias("most_wins")
    )
    return _top(wins, _most_wins(), top)


def rolling_wins_of_games(games: DataFrame, n: int = 90, top: int | None = 1) -> DataFrame:
    """Most wins within any ``n`` consecutive games per team, won or lost.

    Games are ranked by date and id through cells, then cut into slices that
    overlap by ``n - 1`` rows, so a team with many games takes many tasks.
    """
    return _top(_best_rolling(_ranked_outcomes(games), n), _most_wins(), top)


def _ranked_outcomes(games: DataFrame) -> DataFrame:
    """Each team's games, won or lost, numbered from 0 by date and id."""
    home_won = F.coalesce(F.col("home_team_wins") == 1, F.lit(False))
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team_id"), home_won.alias("won")),
        F.struct(F.col("visitor_team_id").alias("team_id"), (~home_won).alias("won")),
    )
    played = games.select(
        "game_id", F.col("game_date_est").alias("_day"), F.inline(sides)
    ).withColumn("_cell", id_cell("game_id"))

    cell = ["team_id", "_day", "_cell"]
    counts = played.groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = totals_before(counts, ["team_id"], ["_day", "_cell"], "_rows")
    in_cell = F.row_number().over(Window.partitionBy(*cell).orderBy("game_id"))
    p, o = played.withColumn("_rank", in_cell).alias("p"), offsets.alias("o")
    # Games without a date come before all others.
    same = all_of([F.col(f"p.{c}").eqNullSafe(F.col(f"o.{c}")) for c in cell])
    return p.join(o, same).select(
        "p.team_id", "p.won", (F.col("o._before") + F.col("p._rank") - 1).alias("_rank")
    )


def _best_rolling(ranked: DataFrame, n: int) -> DataFrame:
    """Most wins of each team within ``n`` consecutive ranks."""
    size = max(SLICE_ROWS, n)
    own = F.floor(F.col("_rank") / size)
    near_end = F.col("_rank") % size > size - n
    sliced = ranked.select(
        "*",
        own.alias("_own"),
        F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))).alias("_slice"),
    )
    w = Window.partitionBy("team_id", "_slice").orderBy("_rank").rowsBetween(-(n - 1), 0)
    rolling = sliced.withColumn("_wins", F.sum(F.col("won").cast("int")).over(w))
    return (
        rolling.where(F.col("_slice") == F.col("_own"))
        .groupBy("team_id")
        .agg(F.max("_wins").alias("most_wins"))
    )


def window_step(state: DataFrame, games: DataFrame, n: int = 90) -> DataFrame:
    """Teams' rolling windows after more games, all later than those before.

    The state is a row a team: ``ring``, the last ``n - 1`` outcomes, oldest first, and
    ``most_wins`` of any ``n`` consecutive games so far. A window that ends in the new
    games begins in the ring at the earliest, so no earlier game is read again and the
    state does not grow. Games of one step may be any number; a team without any keeps
    its row. Games without a date belong to the first step.
    """
    told = state.select("team_id", "ring", "most_wins").alias("s")
    old = told.select("team_id", F.posexplode("ring").alias("_rank", "won"))
    new = _ranked_outcomes(games).alias("g")
    mine = F.col("g.team_id").eqNullSafe(F.col("s.team_id"))
    held = F.coalesce(F.size("s.ring"), F.lit(0))
    after = new.join(told, mine, "left").select(
        "g.team_id", (F.col("g._rank") + held).alias("_rank"), "g.won"
    )
    every = old.select("team_id", F.col("_rank").cast("long"), "won").unionByName(after)
    best = _best_rolling(every, n).alias("b")
    ends = every.groupBy("team_id").agg(F.max("_rank").alias("_end")).alias("e")
    row = every.alias("r")
    newest = row.join(ends, F.col("r.team_id").eqNullSafe(F.col("e.team_id"))).where(
        F.col("r._rank") > F.col("e._end") - (n - 1)
    )
    # A group has n - 1 outcomes at most.
    rings = newest.groupBy("r.team_id").agg(
        F.sort_array(F.collect_list(F.struct("r._rank", "r.won"))).alias("_ring")
    ).alias("t")
    joined = told.join(best, F.col("s.team_id").eqNullSafe(F.col("b.team_id")), "full_outer")
    team = F.coalesce("b.team_id", "s.team_id").alias("team_id")
    most = F.greatest("s.most_wins", "b.most_wins").alias("most_wins")
    teams = joined.select(team, most).alias("m")
    none = F.array().cast("array<boolean>")
    return teams.join(rings, F.col("m.team_id").eqNullSafe(F.col("t.team_id")), "left").select(
        "m.team_id",
        F.coalesce(F.transform("t._ring", lambda r: r["won"]), none).alias("ring"),
        "m.most_wins",
    )


def top_windows(state: DataFrame, top: int | None = 1) -> DataFrame:
    """What ``rolling_wins_of_games`` gives for all games of the steps."""
    return _top(state.select("team_id", "most_wins"), _most_wins(), top)


def longest_streak(
    rows: DataFrame, key: str, day: str, order_id: str, hit: str, top: int | None = 1
) -> DataFrame:
    """Longest run of consecutive hits per key, in order of day and id.

    Rows are unique by key and id; an unknown hit is a miss. Of equal runs the
    earliest is kept.
    """
    return streaks_of(run_summaries(rows, key, day, order_id, hit), key, top)


def run_summaries(rows: DataFrame, key: str, day: str, order_id: str, hit: str) -> DataFrame:
    """Summary of each key's runs of hits: misses, head, tail and best.

    Runs are summarised per cell of a day, then per day, then per key; each level
    reads one row per group of the level below, so the rows are shuffled once and no
    task sees all rows of a key. A summary has one size, whatever it sums up.
    """
    cell = [key, "_day", "_cell"]
    so_far = (
        Window.partitionBy(*cell).orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    )
    runs = (
        rows.select(
            key,
            F.col(day).alias("_day"),
            id_cell(order_id).alias("_cell"),
            F.col(order_id).alias("_id"),
            F.when(F.col(hit), 0).otherwise(1).alias("_missed"),
        )
        .withColumn("run", F.sum("_missed").over(so_far))
        .groupBy(*cell, "run")
        .agg(F.sum(1 - F.col("_missed")).alias("length"))
    )
    # Within a cell all dates are equal, so lengths alone are aggregated.
    cells = runs.groupBy(*cell).agg(
        F.max("run").alias("misses"),
        F.max(F.when(F.col("run") == 0, F.col("length"))).alias("_head"),
        F.max_by("length", "run").alias("_tail"),
        F.max("length").alias("_best"),
    )
    one_day = [F.col("_day").alias("start"), F.col("_day").alias("end")]
    summaries = cells.select(
        *cell,
        "misses",
        F.struct(F.coalesce("_head", F.lit(0)).alias("length"), *one_day).alias("head"),
        F.struct(F.col("_tail").alias("length"), *one_day).alias("tail"),
        F.struct((-F.col("_best")).alias("shortfall"), *one_day).alias("best"),
    )
    for group, order in (([key, "_day"], "_cell"), ([key], "_day")):
        summaries = _merged_runs(summaries, group, order)
    return summaries


def extend_runs(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Summaries over two stretches of time, the second wholly after the first.

    A run that ends the one and begins the other is one run.
    """
    parts = before.select("*", F.lit(0).alias("_part")).unionByName(
        after.select("*", F.lit(1).alias("_part"))
    )
    return _merged_runs(parts, [key], "_part")


#: A summary's runs, and their fields as columns of a stored table.
RUN_FIELDS = {
    "head": ("length", "start", "end"),
    "tail": ("length", "start", "end"),
    "best": ("shortfall", "start", "end"),
}


def stored_runs(summaries: DataFrame, key: str) -> DataFrame:
    """Summaries as plain columns."""
    return summaries.select(
        key,
        "misses",
        *[
            F.col(f"{run}.{field}").alias(f"{run}_{field}")
            for run, fields in RUN_FIELDS.items()
            for field in fields
        ],
    )


def runs_of_stored(stored: DataFrame, key: str) -> DataFrame:
    """Summaries from plain columns."""
    return stored.select(
        key,
        "misses",
        *[
            F.struct(*[F.col(f"{run}_{field}").alias(field) for field in fields]).alias(run)
            for run, fields in RUN_FIELDS.items()
        ],
    )


def streaks_of(summaries: DataFrame, key: str, top: int | None = 1) -> DataFrame:
    """The longest run of each key's summary, or of all keys."""
    streaks = summaries.select(
        key,
        F.col("best.start").alias("streak_start_date"),
        F.col("best.end").alias("streak_end_date"),
        (-F.col("best.shortfall")).alias("streak_length"),
    ).where(F.col("streak_length") > 0)
    return _top(
        streaks, [F.desc("streak_length"), F.asc(key), F.asc("streak_start_date")], top
    )


def _merged_runs(parts: DataFrame, group: list[str], order: str) -> DataFrame:
    """One run summary per group from the summaries of its consecutive parts.

    A summary holds the number of misses, the run before the first and the run
    after the last miss, and the longest run. A run is named by the misses before
    it, so the last run of one part and the first of the next share a name.
    """
    earlier = (
        Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("misses").over(earlier), F.lit(0))
    first = F.struct(F.col("_before").alias("run"), F.col("head").alias("part"), "best")
    last = F.struct(
        (F.col("_before") + F.col("misses")).alias("run"),
        F.col("tail").alias("part"),
        F.lit(None).alias("best"),
    )
    ends = F.when(F.col("misses") > 0, F.array(first, last)).otherwise(F.array(first))

    def if_hit(column: str) -> Column:
        return F.when(F.col("part.length") > 0, F.col(column))

    runs = (
        parts.withColumn("_before", before)
        .select(*group, F.inline(ends))
        .groupBy(*group, "run")
        .agg(
            F.sum("part.length").alias("length"),
            F.min(if_hit("part.start")).alias("start"),
            F.max(if_hit("part.end")).alias("end"),
            F.min("best").alias("_best"),
        )
    )
    piece = F.struct("length", "start", "end")
    merged = F.when(
        F.col("length") > 0, F.struct((-F.col("length")).alias("shortfall"), "start", "end")
    )
    nothing = F.struct(
        F.lit(0).cast("long").alias("length"),
        F.lit(None).cast("date").alias("start"),
        F.lit(None).cast("date").alias("end"),
    )
    return runs.groupBy(*group).agg(
        F.max("run").alias("misses"),
        F.coalesce(F.max(F.when(F.col("run") == 0, piece)), nothing).alias("head"),
        F.max_by(piece, F.col("run")).alias("tail"),
        F.min(F.least("_best", merged)).alias("best"),
    )


def funnel(
    events: DataFrame, urls: Sequence[str], target: str, corrected: bool = False
) -> DataFrame:
    """Per url: users, hits, and the share of users who reach the target.

    As defined a url's hits are the pairs of its events with events of the same
    user and day at the same time or later, and an event of the target reaches
    itself. Pairs are counted, not made: an event's later events are a running
    total, taken per second and then over the seconds of the day, after events at
    one instant are counted together. Corrected, hits are events and the target
    must come strictly later.
    """
    steps = range(len(urls))
    goal = list(urls).index(target)
    known = F.col("user_id").isNotNull() & F.col("event_time").isNotNull()
    chosen = events.where(F.col("url").isin(*urls) & known).select(
        "user_id", F.to_date("event_time").alias("_day"), "event_time", "url"
    )
    is_step = [F.col("url") == url for url in urls]
    if corrected:
        days = chosen.groupBy("user_id", "_day").agg(
            *[F.count_if(is_step[i]).alias(f"hits{i}") for i in steps],
            *[F.min(F.when(is_step[i], F.col("event_time"))).alias(f"first{i}") for i in steps],
            F.max(F.when(is_step[goal], F.col("event_time"))).alias("reached"),
        )
    else:
        days = _later_pairs(chosen, is_step, goal)

    def reaches(i: int) -> Column:
        first, reached = F.col(f"first{i}"), F.col("reached")
        later = reached > first if corrected else reached >= first
        return F.max(F.coalesce(later, F.lit(False)).cast("int"))

    users = days.groupBy("user_id").agg(
        *[F.sum(f"hits{i}").alias(f"hits{i}") for i in steps],
        *[reaches(i).alias(f"converted{i}") for i in steps],
    )
    by_url = F.array(
        *[
            F.struct(
                F.lit(urls[i]).alias("url"),
                F.col(f"hits{i}").alias("hits"),
                F.col(f"converted{i}").alias("converted"),
            )
            for i in steps
        ]
    )
    return (
        users.select(F.inline(by_url))
        .where(F.col("hits") > 0)
        .groupBy("url")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.sum("hits").alias("total_hits"),
            (F.sum("converted").cast("double") / F.count(F.lit(1))).alias("pct_converted"),
        )
    )


def _later_pairs(chosen: DataFrame, is_step: list, goal: int) -> DataFrame:
    """Pair counts, first time of each step and last time of the goal, by user and day.

    Counts of pairs grow with the square of a user's events, beyond a long for
    the busiest users, hence the decimals.
    """
    steps = range(len(is_step))
    wide = "decimal(38,0)"

    instants = (
        chosen.withColumn("_second", _second_of_day("event_time"))
        .groupBy("user_id", "_day", "_second", "event_time")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count_if(is_step[i]).alias(f"_n{i}") for i in steps],
        )
    )
    second = ["user_id", "_day", "_second"]
    to_end = Window.partitionBy(*second).orderBy(F.desc("event_time"))
    with_later = instants.withColumn("_later", F.sum("_n").over(to_end))

    def at(i: int) -> Column:
        return F.when(F.col(f"_n{i}") > 0, F.col("event_time"))

    seconds = with_later.groupBy(*second).agg(
        F.sum("_n").alias("_n"),
        *[F.sum(f"_n{i}").alias(f"_n{i}") for i in steps],
        *[
            F.sum(F.col(f"_n{i}").cast(wide) * F.col("_later").cast("decimal(19,0)")).alias(
                f"_pairs{i}"
            )
            for i in steps
        ],
        *[F.min(at(i)).alias(f"first{i}") for i in steps],
        F.max(at(goal)).alias("reached"),
    )
    after = (
        Window.partitionBy("user_id", "_day")
        .orderBy(F.desc("_second"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = seconds.withColumn("_after", F.coalesce(F.sum("_n").over(after), F.lit(0)))
    return ordered.groupBy("user_id", "_day").agg(
        *[
            F.sum(
                F.col(f"_pairs{i}")
                + F.col(f"_n{i}").cast(wide) * F.col("_after").cast("decimal(19,0)")
            )
            .cast(wide)
            .alias(f"hits{i}")
            for i in steps
        ],
        *[F.min(f"first{i}").alias(f"first{i}") for i in steps],
        F.max("reached").alias("reached"),
    )


def _second_of_day(moment: str) -> Column:
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def _top(rows: DataFrame, order: list, top: int | None) -> DataFrame:
    return rows if top is None else rows.orderBy(*order).limit(top)
