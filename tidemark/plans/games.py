"""Queries on game rows: fact table, audits, leaderboards, windows, streaks."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cubes, facts, quality, sequences
from tidemark.plans.flat import flat_dates
from tidemark.plans.graph import BUCKETS, LOADED_DAYS
from tidemark.plans.snapshots import FIRST, LAST, SHELVES
from tidemark.session import parts_for
from tidemark.sources import views
from tidemark.sources.appends import AppendAudit
from tidemark.sources.schemas import FACT_GAME_DETAILS, FACT_ROWS, STREAKS, TEAM_WINDOWS
from tidemark.sources.store import BucketedStore, ShelfStore, new_folder, new_store
from tidemark.sources.views import Reader

STREAK_POINTS = 10
POSITIONS = ("A", "N")
NAME_PREFIX = "red"


def fact_game_details(table: Reader) -> DataFrame:
    return flat_dates(facts.build_fact(views.game_details(table), views.games(table)))


def _months_apart(games: DataFrame, parts: int) -> list[DataFrame]:
    """Games in so many parts at most, of whole months and about as many games each."""
    if parts == 1:
        return [games]
    month, seen, months = facts.game_month(), 0, defaultdict(list)
    counts = games.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.orderBy("month").collect()
    total = sum(r.n for r in counts)
    for r in counts:
        months[seen * parts // total].append(r.month)
        seen += r.n
    return [games.where(month.isin(some)) for some in months.values()]


def fact_game_details_stored(table: Reader) -> DataFrame:
    """The fact kept by increments and stored: all games but those of a few days, then
    these days one at a time, out of order and one of them twice.

    All games are stored some months at a time, so that the shuffles of one part only are
    on disk. Rows are dealt by game as buckets are, before their copies are dropped, and
    stay so until they are written.
    """
    games = views.games(table)
    views.game_details(table)  # all tables are looked up: their size says how many parts
    store = new_store(games.sparkSession, BUCKETS)
    late = F.coalesce(F.col("game_date_est").isin(*LOADED_DAYS), F.lit(False))
    for chosen in _months_apart(games.where(~late), parts_for(store.spark)):
        held = store.dealt(FACT_ROWS, views.game_details(table, of=chosen))
        store.replace(FACT_ROWS, facts.fact_rows(held, chosen))
    first, second, third = LOADED_DAYS
    for day in (third, first, second, first):
        chosen = games.where(F.col("game_date_est") == F.lit(day))
        batch = facts.fact_rows(views.game_details(table, of=chosen), chosen)
        stored = store.read(FACT_ROWS, day.year * 100 + day.month)
        store.replace(FACT_ROWS, facts.merge_facts(stored, store.dealt(FACT_ROWS, batch)))
    store.replace(FACT_GAME_DETAILS, facts.shape_fact(store.read(FACT_ROWS)))
    found = flat_dates(store.read(FACT_GAME_DETAILS))
    return store.handed_over(found, FACT_GAME_DETAILS, FACT_ROWS)


def duplicate_keys(table: Reader) -> DataFrame:
    return quality.duplicate_keys(views.game_details(table, names=False), facts.GRAIN)


def duplicate_keys_appended(table: Reader) -> DataFrame:
    """As duplicate_keys, by appends: all games but those of a few days, then these days
    one at a time and one of them twice."""
    details = views.game_details(table, names=False).select(*facts.GRAIN)
    day = F.col("game_date_est")
    dated = details.join(views.games(table).select("game_id", day), "game_id").checkpoint()
    spark = dated.sparkSession
    audit = AppendAudit(ShelfStore(spark, new_folder(spark), SHELVES), FACT_ROWS)
    late = F.coalesce(day.isin(*LOADED_DAYS), F.lit(False))
    audit.append(dated.where(~late), 0)
    first, second, third = LOADED_DAYS
    for load, one in ((3, third), (1, first), (2, second), (1, first)):
        audit.append(dated.where(day == F.lit(one)), load)
    broken = audit.violations().where(F.col("n_rows") > 1).drop("has_null")
    return audit.store.result(broken, *audit.tables)


def actor_name_audit(table: Reader) -> DataFrame:
    return quality.name_audit(views.actor_films(table), "actorid", "actor")


def actor_name_audit_corrected(table: Reader) -> DataFrame:
    return quality.name_audit(views.actor_films(table), "actorid", "actor", corrected=True)


def actor_film_pairs(table: Reader) -> DataFrame:
    return quality.key_counts(views.actor_films(table), ["actorid", "filmid"])


def _points_by_season(table: Reader, corrected: bool) -> DataFrame:
    points = cubes.season_points(views.game_details(table, names=False), views.games(table))
    return cubes.leaderboard(points, "player_id", "season", "pts", corrected)


def points_by_player_season(table: Reader) -> DataFrame:
    return _points_by_season(table, corrected=False)


def points_by_player_season_corrected(table: Reader) -> DataFrame:
    return _points_by_season(table, corrected=True)


def points_by_player_team(table: Reader) -> DataFrame:
    return cubes.leaderboard(views.game_details(table, names=False), "player_id", "team_id", "pts")


def points_by_player_team_corrected(table: Reader) -> DataFrame:
    return cubes.leaderboard(
        views.game_details(table, names=False), "player_id", "team_id", "pts", corrected=True
    )


def team_wins(table: Reader) -> DataFrame:
    return cubes.wins_leaderboard(views.games(table), views.game_details(table, names=False))


def team_wins_corrected(table: Reader) -> DataFrame:
    return cubes.wins_leaderboard(views.games(table), corrected=True)


def rolling_wins(table: Reader) -> DataFrame:
    return sequences.rolling_wins(views.games(table))


def rolling_wins_corrected(table: Reader) -> DataFrame:
    return sequences.rolling_wins_of_games(views.games(table))


def rolling_wins_yearly(table: Reader) -> DataFrame:
    """As rolling_wins_corrected, by one stored step per season; no game is read again."""
    games = views.games(table).checkpoint()
    store = BucketedStore(games.sparkSession, new_folder(games.sparkSession), BUCKETS)
    for season in range(FIRST, LAST + 1):
        today = games.where(F.col("season") == season)
        state = sequences.window_step(store.read(TEAM_WINDOWS, season - 1), today)
        store.replace(TEAM_WINDOWS, state.withColumn("season", F.lit(season)))
    best = sequences.top_windows(store.read(TEAM_WINDOWS, LAST))
    return store.result(best, TEAM_WINDOWS)


def _hits(details: DataFrame, games: DataFrame) -> DataFrame:
    """Of several rows of a player and game the one with most points counts."""
    played = details.groupBy("player_id", "game_id").agg(F.max("pts").alias("pts"))
    dated = played.join(games.select("game_id", "game_date_est", "season"), "game_id")
    return dated.withColumn("hit", F.coalesce(F.col("pts") > STREAK_POINTS, F.lit(False)))


STREAK = ("player_id", "game_date_est", "game_id", "hit")


def longest_streak(table: Reader) -> DataFrame:
    hits = _hits(views.game_details(table, names=False), views.games(table))
    return flat_dates(sequences.longest_streak(hits, *STREAK))


def longest_streak_yearly(table: Reader) -> DataFrame:
    """As longest_streak, by one stored step per season; no earlier game is read again."""
    hits = _hits(views.game_details(table, names=False), views.games(table)).checkpoint()
    store = new_store(hits.sparkSession, BUCKETS)
    for season in range(FIRST, LAST + 1):
        today = sequences.run_summaries(hits.where(F.col("season") == season), *STREAK)
        before = sequences.runs_of_stored(store.read(STREAKS, season - 1), "player_id")
        state = sequences.extend_runs(before, today, "player_id")
        stored = sequences.stored_runs(state, "player_id")
        store.replace(STREAKS, stored.withColumn("season", F.lit(season)))
    last = sequences.runs_of_stored(store.read(STREAKS, LAST), "player_id")
    return store.result(flat_dates(sequences.streaks_of(last, "player_id")), STREAKS)


def period_range(table: Reader) -> DataFrame:
    return quality.period_range(views.actor_films(table), "year")


def distinct_rows(table: Reader) -> DataFrame:
    return quality.distinct_rows(views.game_details(table))


def players_with_prefix(table: Reader) -> DataFrame:
    return quality.rows_with_prefix(views.game_details(table), "player_name", NAME_PREFIX)


def key_audit(table: Reader) -> DataFrame:
    return quality.key_audit(views.teams(table), ["team_id"])


def enum_audit(table: Reader) -> DataFrame:
    return quality.domain_audit(
        views.game_details(table, names=False), "start_position", POSITIONS
    ).select("game_id", "team_id", "player_id", "start_position")


QUERIES = {
    f.__name__: f
    for f in (
        fact_game_details,
        fact_game_details_stored,
        duplicate_keys,
        duplicate_keys_appended,
        actor_name_audit,
        actor_name_audit_corrected,
        actor_film_pairs,
        points_by_player_season,
        points_by_player_season_corrected,
        points_by_player_team,
        points_by_player_team_corrected,
        team_wins,
        team_wins_corrected,
        rolling_wins,
        rolling_wins_corrected,
        rolling_wins_yearly,
        longest_streak,
        longest_streak_yearly,
        period_range,
        distinct_rows,
        players_with_prefix,
        key_audit,
        enum_audit,
    )
}
