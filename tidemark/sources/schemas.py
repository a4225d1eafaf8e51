"""Declared tables: schema, primary key and enumerated columns of each."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tidemark.functions import classify

FILM = T.StructType(
    [
        T.StructField("film", T.StringType()),
        T.StructField("votes", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("filmid", T.StringType()),
    ]
)

SEASON_STATS = T.StructType(
    [
        T.StructField("season", T.IntegerType()),
        T.StructField("gp", T.IntegerType()),
        T.StructField("pts", T.DoubleType()),
        T.StructField("reb", T.DoubleType()),
        T.StructField("ast", T.DoubleType()),
    ]
)


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "dates": T.ArrayType(T.DateType()),
    "booleans": T.ArrayType(T.BooleanType()),
    "ints": T.ArrayType(T.IntegerType()),
    "films": T.ArrayType(FILM),
    "seasons": T.ArrayType(SEASON_STATS),
}


def _schema(text: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no session."""
    columns = (pair.split() for pair in text.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns])


@dataclass(frozen=True)
class Table:
    """One declared table. ``period`` names the column it is partitioned by.

    ``joined_on`` is what steps join it by, the rest of its key unless given.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    period: str | None = None
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    joined_on: tuple[str, ...] = ()

    @property
    def bucket_key(self) -> tuple[str, ...]:
        return self.joined_on or tuple(k for k in self.key if k != self.period)


ACTORS = Table(
    "actors",
    _schema(
        "actor string, actorid string, current_year int, is_active boolean, "
        "films films, quality_class string",
    ),
    ("actorid", "current_year"),
    "current_year",
    {"quality_class": classify.QUALITY_CLASSES},
)

# Snapshots of actors whose films stand in closed segments, but for the open ones.
ACTOR_HEADS = Table(
    "actor_heads",
    _schema(
        "actor string, actorid string, current_year int, is_active boolean, "
        "films films, quality_class string, elements bigint"
    ),
    ("actorid", "actor", "current_year"),
    "current_year",
    {"quality_class": classify.QUALITY_CLASSES},
)

ACTOR_SEGMENTS = Table(
    "actor_segments",
    _schema("actorid string, actor string, segment int, films films, closed_in int"),
    ("actorid", "actor", "segment"),
    "closed_in",
    joined_on=("actorid", "actor"),
)

ACTOR_HISTORY_SCD = Table(
    "actor_history_scd",
    _schema(
        "actor string, actorid string, current_year int, is_active boolean, "
        "quality_class string, start_year int, end_year int"
    ),
    ("actorid", "start_year"),
    "current_year",
    {"quality_class": classify.QUALITY_CLASSES},
    ("actorid",),
)

PLAYER_SEASONS = Table(
    "player_seasons",
    _schema(
        "player_name string, season int, height string, college string, country string, "
        "draft_year string, draft_number string, draft_round string, gp int, pts double, "
        "reb double, ast double"
    ),
    ("player_name", "season"),
    "season",
)

PLAYERS = Table(
    "players",
    _schema(
        "player_name string, height string, college string, country string, "
        "draft_year string, draft_number string, draft_round string, season_stats seasons, "
        "scoring_class string, years_since_last_season int, current_season int, "
        "is_active boolean",
    ),
    ("player_name", "current_season"),
    "current_season",
    {"scoring_class": classify.SCORING_CLASSES},
)

PLAYERS_SCD = Table(
    "players_scd",
    _schema(
        "player_name string, scoring_class string, is_active boolean, "
        "current_season int, start_season int, end_season int"
    ),
    ("player_name", "start_season"),
    "current_season",
    {"scoring_class": classify.SCORING_CLASSES},
    ("player_name",),
)

# Spans of consecutive seasons with equal values, which late seasons are spliced into.
PLAYER_COVERS = Table(
    "player_covers",
    _schema(
        "player_name string, scoring_class string, is_active boolean, "
        "start_season int, end_season int"
    ),
    ("player_name", "start_season"),
    domains={"scoring_class": classify.SCORING_CLASSES},
)

PLAYER_TRACKING = Table(
    "player_tracking",
    _schema(
        "player_name string, season int, start_season int, last_season int, state string"
    ),
    ("player_name", "season"),
    "season",
    {"state": classify.PLAYER_STATES},
)

USERS_CUMULATED = Table(
    "users_cumulated",
    _schema("user_id string, dates_active dates, date date"),
    ("user_id", "date"),
    "date",
)

USER_DEVICES_CUMULATED = Table(
    "user_devices_cumulated",
    _schema(
        "user_id string, browser_type string, date date, device_activity_datelist dates"
    ),
    ("date", "user_id", "browser_type"),
    "date",
)

HOSTS_CUMULATED = Table(
    "hosts_cumulated",
    _schema("user_id string, host string, date date, host_activity_datelist dates"),
    ("date", "user_id", "host"),
    "date",
)

HOST_ACTIVITY_REDUCED = Table(
    "host_activity_reduced",
    _schema("month int, host string, hit_array ints, unique_visitors ints"),
    ("host", "month"),
    "month",
)

# Distinct users and hosts of a day, shaped once for all steps that read it.
HOST_DAYS = Table(
    "host_days",
    _schema("user_id string, host string, date date"),
    ("user_id", "host", "date"),
    "date",
)

# Keeps host_activity_reduced with a slot for each calendar day.
HOST_ACTIVITY_CALENDAR = Table(
    "host_activity_calendar",
    _schema("month int, host string, days int, hits ints, visitors ints"),
    ("host", "month"),
    "month",
)

USERS_GROWTH_ACCOUNTING = Table(
    "users_growth_accounting",
    _schema(
        "user_id string, first_active_date date, last_active_date date, "
        "daily_active_state string, weekly_active_state string, "
        "dates_active dates, date date"
    ),
    ("user_id", "date"),
    "date",
)

# First active day of each user, and what each cohort of such a day does day by day.
USER_COHORTS = Table(
    "user_cohorts",
    _schema("user_id string, first_active_date date"),
    ("user_id",),
    "first_active_date",
)

COHORT_DAYS = Table(
    "cohort_days",
    _schema("first_active_date date, active_users bigint, total_users bigint, date date"),
    ("first_active_date", "date"),
    "date",
)

FACT_GAME_DETAILS = Table(
    "fact_game_details",
    _schema(
        "dim_game_date date, dim_season int, dim_is_playing_at_home boolean, "
        "dim_team_id int, dim_player_id int, dim_player_name string, "
        "dim_start_position string, dim_did_not_play boolean, dim_did_not_dress boolean, "
        "dim_not_with_team boolean, m_minutes double, m_fgm int, m_fga int, m_fg3m int, "
        "m_fg3a int, m_ftm int, m_fta int, m_dreb int, m_oreb int, m_reb int, m_ast int, "
        "m_stl int, m_blk int, m_turnovers int, m_pf int, m_pts int, m_plus_minus int"
    ),
    ("dim_game_date", "dim_player_id", "dim_team_id"),
)

# Rows of the fact with their grain, which batches are merged into.
FACT_ROWS = Table(
    "fact_rows",
    _schema(
        "game_id bigint, team_id int, player_id bigint, team_abbreviation string, "
        "player_name string, start_position string, comment string, min string, pts int, "
        "fgm int, fga int, fg3m int, fg3a int, ftm int, fta int, oreb int, dreb int, reb int, "
        "ast int, stl int, blk int, turnovers int, pf int, plus_minus int, game_date_est date, "
        "season int, home_team_id int, month int"
    ),
    ("game_id", "team_id", "player_id"),
    "month",
    joined_on=("game_id",),
)

# Players of games, and what each load changed in their pairs: edges are made of both.
PLAYER_GAMES = Table(
    "player_games",
    _schema(
        "player_id bigint, game_id bigint, start_position string, pts int, team_id int, "
        "team_abbreviation string, player_name string, month int"
    ),
    ("player_id", "game_id"),
    "month",
    joined_on=("game_id",),
)

PAIR_CHANGES = Table(
    "pair_changes",
    _schema(
        "subject_id bigint, object_id bigint, edge_type string, num_games bigint, "
        "subject_points bigint, object_points bigint, subject_known bigint, "
        "object_known bigint, load int"
    ),
    ("subject_id", "object_id", "edge_type", "load"),
    "load",
    {"edge_type": classify.EDGE_TYPES},
)

# What is known of each player's runs of games as of a season, in one size.
STREAKS = Table(
    "streaks",
    _schema(
        "player_id bigint, misses bigint, head_length bigint, head_start date, head_end date, "
        "tail_length bigint, tail_start date, tail_end date, best_shortfall bigint, "
        "best_start date, best_end date, season int"
    ),
    ("player_id", "season"),
    "season",
)

# Last outcomes of each team as of a season, and the most wins of a window so far.
TEAM_WINDOWS = Table(
    "team_windows",
    _schema("team_id int, ring booleans, most_wins bigint, season int"),
    ("team_id", "season"),
    "season",
)

# Shelves that each load of an audited table has rows of keys on.
LOAD_SHELVES = Table(
    "load_shelves", _schema("shelf int, load int"), ("load", "shelf"), "load"
)

VERTICES = Table(
    "vertices",
    _schema("identifier string, type string, properties string"),
    ("identifier", "type"),
    "type",
    {"type": classify.VERTEX_TYPES},
)

EDGES = Table(
    "edges",
    _schema(
        "subject_identifier string, subject_type string, object_identifier string, "
        "object_type string, edge_type string, properties string"
    ),
    ("subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type"),
    "edge_type",
    {
        "subject_type": classify.VERTEX_TYPES,
        "object_type": classify.VERTEX_TYPES,
        "edge_type": classify.EDGE_TYPES,
    },
)

DEVICE_HITS_DASHBOARD = Table(
    "device_hits_dashboard",
    _schema(
        "aggregation_level string, os_type string, device_type string, "
        "browser_type string, number_of_hits bigint"
    ),
    (),
)

DECLARED = (
    ACTORS,
    ACTOR_HISTORY_SCD,
    PLAYERS,
    PLAYERS_SCD,
    PLAYER_TRACKING,
    USERS_CUMULATED,
    USER_DEVICES_CUMULATED,
    HOSTS_CUMULATED,
    HOST_ACTIVITY_REDUCED,
    HOST_ACTIVITY_CALENDAR,
    USERS_GROWTH_ACCOUNTING,
    FACT_GAME_DETAILS,
    VERTICES,
    EDGES,
    DEVICE_HITS_DASHBOARD,
)
