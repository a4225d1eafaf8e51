"""Statements for snapshots, type-2 history and player states.

Each snapshot row is an aggregate of all facts up to its period; intervals are
islands of equal values; states follow from the years since the last season.
"""

from __future__ import annotations

from tidemark.oracle.inputs import with_inputs

Steps = list[tuple[str, str]]

STEP, BUILD, LAST, SPINE_END = 1998, 2000, 2001, 2002
ATTRIBUTES = ["height", "college", "country", "draft_year", "draft_number", "draft_round"]


#: A class is given to scores above its bound.
SCORING = {"star": 20, "good": 15, "average": 10}
RATING = {"star": 8, "good": 7, "average": 6}


def _class(score: str, bounds: dict[str, int]) -> str:
    cases = " ".join(f"WHEN {score} > {low} THEN '{name}'" for name, low in bounds.items())
    return f"CASE {cases} ELSE 'bad' END"


def _spine(facts: str, key: str, period: str, last: int) -> tuple[str, str]:
    return (
        "spine",
        f"SELECT {key}, CAST(unnest(range(min({period}), {last + 1})) AS INTEGER) AS as_of "
        f"FROM {facts} GROUP BY {key}",
    )


SEASON = (
    "concat_ws(':', f.season, f.gp, CAST(floor(f.pts * 1000) AS BIGINT), "
    "CAST(floor(f.reb * 4) AS BIGINT), CAST(floor(f.ast * 4) AS BIGINT))"
)


def _players(last: int) -> Steps:
    as_known = ", ".join(f"arg_max(f.{a}, f.season) AS {a}" for a in ATTRIBUTES)
    return [
        _spine("player_seasons", "player_name", "season", last),
        (
            "players",
            f"""
            SELECT s.player_name, s.as_of AS current_season, {as_known},
                   string_agg({SEASON}, ',' ORDER BY f.season) AS season_stats,
                   {_class('arg_max(f.pts, f.season)', SCORING)} AS scoring_class,
                   s.as_of - max(f.season) AS years_since_last_season,
                   max(f.season) = s.as_of AS is_active,
                   min(f.season) AS first_season,
                   arg_min(f.pts, f.season) AS first_pts, arg_max(f.pts, f.season) AS last_pts
            FROM spine s
            JOIN player_seasons f ON f.player_name = s.player_name AND f.season <= s.as_of
            GROUP BY s.player_name, s.as_of
            """,
        ),
    ]


STATE = "season_stats, scoring_class, years_since_last_season, current_season, is_active"

FILM = "concat_ws(':', film, votes, CAST(floor(rating * 4) AS BIGINT), filmid)"


def _actors(last: int) -> Steps:
    return [
        _spine("actor_films", "actorid", "year", last),
        (
            "years",
            f"SELECT actorid, year, max(actor) AS actor, avg(rating) AS score, "
            f"string_agg({FILM}, ',' ORDER BY filmid) AS films "
            "FROM actor_films GROUP BY actorid, year",
        ),
        (
            "actors",
            f"""
            SELECT s.actorid, s.as_of AS current_year, arg_max(y.actor, y.year) AS actor,
                   string_agg(y.films, ',' ORDER BY y.year) AS films,
                   {_class('arg_max(y.score, y.year)', RATING)} AS quality_class,
                   max(y.year) = s.as_of AS is_active
            FROM spine s JOIN years y ON y.actorid = s.actorid AND y.year <= s.as_of
            GROUP BY s.actorid, s.as_of
            """,
        ),
    ]


def _islands(table: str, key: str, tracked: str, period: str, last: int) -> tuple[str, str]:
    """Runs of consecutive periods with equal values: period minus rank is constant."""
    return (
        "islands",
        f"""
        SELECT {key}, {tracked}, min({period}) AS first_period, max({period}) AS last_period
        FROM (SELECT *, {period} - row_number() OVER (PARTITION BY {key}, {tracked}
                                                      ORDER BY {period}) AS island
              FROM {table} WHERE {period} <= {last})
        GROUP BY {key}, {tracked}, island
        """,
    )


def _player_history(last: int) -> str:
    return with_inputs(
        ["player_seasons"],
        [
            *_players(last),
            _islands("players", "player_name", "scoring_class, is_active", "current_season", last),
        ],
        f"SELECT player_name, scoring_class, is_active, CAST({last} AS INTEGER) AS "
        "current_season, first_period AS start_season, last_period AS end_season FROM islands",
    )


def _actor_history(last: int, end: str) -> str:
    return with_inputs(
        ["actor_films"],
        [
            *_actors(last),
            _islands("actors", "actorid, actor", "is_active, quality_class", "current_year", last),
        ],
        f"SELECT actorid, actor, is_active, quality_class, CAST({last} AS INTEGER) AS "
        f"current_year, first_period AS start_year, {end} AS end_year FROM islands",
    )


# Rows open in both years keep the end they had.
KEPT_END = f"if(first_period <= {BUILD}, least(last_period, {BUILD}), last_period)"


def _tracking(corrected: bool, last: int | None = None) -> str:
    """States from years since the last season, now and the season before.

    As defined only 'Retired' is remembered, so a long idle time runs through
    Retired, Stayed Retired and Continued Playing again and again.
    """
    if corrected:
        idle = "CASE WHEN idle = 1 THEN 'Retired' ELSE 'Stayed Retired' END"
        came_back = "idle_before > 0"
    else:
        idle = "['Continued Playing', 'Retired', 'Stayed Retired'][1 + idle % 3]"
        came_back = "idle_before % 3 = 1"
    only = "" if last is None else f"WHERE season = {last}"
    return with_inputs(
        ["player_seasons"],
        [
            *_players(LAST),
            (
                "idle_years",
                """
                SELECT player_name, current_season AS season, first_season,
                       years_since_last_season AS idle,
                       lag(years_since_last_season) OVER (PARTITION BY player_name
                                                          ORDER BY current_season)
                           AS idle_before
                FROM players
                """,
            ),
        ],
        f"""
        SELECT player_name, season, first_season AS start_season, season - idle AS last_season,
               CASE WHEN idle_before IS NULL THEN 'New'
                    WHEN idle > 0 THEN {idle}
                    WHEN {came_back} THEN 'Returned from Retirement'
                    ELSE 'Continued Playing' END AS state
        FROM idle_years {only}
        """,
    )


MAX_ATTRIBUTES = (
    "overall",
    "SELECT player_name, "
    + ", ".join(f"max({a}) AS {a}" for a in ATTRIBUTES)
    + " FROM player_seasons GROUP BY player_name",
)
STATS = "f.season, f.gp, f.pts, f.reb, f.ast"

ORACLES = {
    "cumulative_players_step": with_inputs(
        ["player_seasons"],
        _players(STEP),
        f"SELECT player_name, {', '.join(ATTRIBUTES)}, {STATE} FROM players "
        f"WHERE current_season = {STEP}",
    ),
    "cumulative_actors_step": with_inputs(
        ["actor_films"], _actors(STEP), f"SELECT * FROM actors WHERE current_year = {STEP}"
    ),
    "cumulative_players_backfill": with_inputs(
        ["player_seasons"],
        [*_players(SPINE_END), MAX_ATTRIBUTES],
        f"SELECT player_name, {', '.join('o.' + a for a in ATTRIBUTES)}, {STATE} "
        "FROM players JOIN overall o USING (player_name)",
    ),
    "cumulative_actors_backfill": with_inputs(
        ["actor_films"], _actors(LAST), "SELECT * FROM actors"
    ),
    "scd2_build_players": _player_history(BUILD),
    "scd2_build_actors": _actor_history(BUILD, "last_period"),
    "scd2_step_players": _player_history(BUILD + 1),
    "scd2_step_actors": _actor_history(BUILD + 1, KEPT_END),
    "scd2_players_any_order": _player_history(LAST),
    "unnest_seasons": with_inputs(
        ["player_seasons"],
        [_spine("player_seasons", "player_name", "season", SPINE_END)],
        f"SELECT player_name, as_of AS current_season, {STATS} FROM player_seasons f "
        f"JOIN spine USING (player_name) WHERE f.season = {BUILD} AND as_of >= {BUILD}",
    ),
    "unnest_latest_seasons": with_inputs(
        ["player_seasons"],
        [],
        f"SELECT player_name, {STATS} FROM player_seasons f WHERE season <= {LAST}",
    ),
    "season_bounds": with_inputs(
        ["player_seasons"],
        [],
        "SELECT min(season) AS min_season, max(season) AS max_season FROM player_seasons "
        f"WHERE season <= {SPINE_END}",
    ),
    "first_latest_change": with_inputs(
        ["player_seasons"],
        _players(LAST),
        "SELECT player_name, first_pts AS first_value, last_pts AS latest_value, "
        "CASE first_pts WHEN 0 THEN 0 ELSE (last_pts - first_pts) * 100 / first_pts END "
        f"AS percentage FROM players WHERE current_season = {LAST}",
    ),
    "player_tracking": _tracking(corrected=False),
    "player_tracking_corrected": _tracking(corrected=True),
    "player_tracking_step": _tracking(corrected=False, last=LAST),
}

# The stored yearly steps hold the same states.
ORACLES["player_tracking_repaired"] = ORACLES["player_tracking"]
ORACLES["scd2_players_repaired"] = ORACLES["scd2_players_any_order"]
ORACLES["player_tracking_yearly"] = ORACLES["player_tracking"]

# The stored table holds the same rows.
ORACLES["actors_yearly"] = ORACLES["cumulative_actors_backfill"]
ORACLES["scd2_step_actors_stored"] = ORACLES["scd2_step_actors"]
ORACLES["actors_yearly_segments"] = ORACLES["cumulative_actors_backfill"]
