"""Statements for the game row queries."""

from __future__ import annotations

from tidemark.oracle.inputs import with_inputs

MEASURES = [
    "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "dreb", "oreb", "reb", "ast", "stl", "blk",
    "turnovers", "pf", "pts", "plus_minus",
]
# All columns outside the key, so that the kept row is determined.
TIES = [
    "team_abbreviation", "player_name", "start_position", "comment", "min", "pts", "fgm", "fga",
    "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk", "turnovers", "pf",
    "plus_minus",
]
KEY = "game_id, team_id, player_id"


def _flag(word: str) -> str:
    return f"coalesce(contains(comment, '{word}'), false)"


def _clock(part: int, seconds: int) -> str:
    return f"CAST(string_split(min, ':')[{part}] AS DOUBLE) / {seconds}"


def _points(other: str, source: str, inputs: list[str], corrected: bool) -> str:
    """Best total per player; as defined totals over everything compete as well."""
    best = "max(total)" if corrected else "greatest(max(total), sum(total))"
    steps = [
        (
            "pairs",
            f"SELECT player_id, {other} AS other, sum(pts) AS total FROM {source} "
            f"GROUP BY player_id, {other}",
        )
    ]
    players = (
        f"SELECT CAST(player_id AS VARCHAR) AS player, CAST({best} AS BIGINT) AS max_points "
        "FROM pairs GROUP BY player_id HAVING sum(total) IS NOT NULL"
    )
    overall = (
        "SELECT '(overall)', CAST(greatest(max(total), sum(total)) AS BIGINT) FROM "
        "(SELECT sum(total) AS total FROM pairs GROUP BY other)"
    )
    result = players if corrected else f"{players} UNION ALL {overall}"
    return with_inputs(inputs, steps, result)


SEASON_ROWS = "game_rows JOIN (SELECT game_id, season FROM games) USING (game_id)"
WINNER = "if(home_team_wins = 1, home_team_id, visitor_team_id)"


def _wins(inputs: list[str], source: str) -> str:
    return with_inputs(
        inputs,
        [("won", f"SELECT {WINNER} AS team FROM {source}")],
        "SELECT CAST(team AS VARCHAR) AS team, count(*) AS total_wins FROM won GROUP BY team "
        "UNION ALL SELECT '(overall)', count(*) FROM won",
    )


def _names(test: str) -> str:
    return with_inputs(
        ["actor_films"],
        [],
        "SELECT actorid, count(DISTINCT actor) AS n_names FROM actor_films "
        f"GROUP BY actorid HAVING {test}",
    )


def _best_window(steps: list[tuple[str, str]]) -> str:
    return with_inputs(
        ["games"],
        steps,
        "SELECT team_id, CAST(max(wins) AS BIGINT) AS most_wins FROM windows "
        "GROUP BY team_id ORDER BY most_wins DESC, team_id LIMIT 1",
    )


ORACLES = {
    "fact_game_details": with_inputs(
        ["game_details", "games"],
        [
            (
                "kept",
                f"SELECT DISTINCT ON ({KEY}) * FROM game_details ORDER BY {KEY}, "
                + ", ".join(f"{c} NULLS FIRST" for c in TIES),
            )
        ],
        f"""
        SELECT CAST(game_date_est AS VARCHAR) AS dim_game_date, season AS dim_season,
               team_id = home_team_id AS dim_is_playing_at_home, team_id AS dim_team_id,
               player_id AS dim_player_id, player_name AS dim_player_name,
               start_position AS dim_start_position, {_flag('DNP')} AS dim_did_not_play,
               {_flag('DND')} AS dim_did_not_dress, {_flag('NWT')} AS dim_not_with_team,
               {_clock(1, 1)} + {_clock(2, 60)} AS m_minutes,
               {', '.join(f'{m} AS m_{m}' for m in MEASURES)}
        FROM kept JOIN games USING (game_id)
        """,
    ),
    "duplicate_keys": with_inputs(
        ["game_rows"],
        [],
        f"SELECT {KEY}, count(*) AS n_rows FROM game_rows GROUP BY {KEY} HAVING count(*) > 1",
    ),
    "actor_name_audit": _names("count(actor) > 1"),
    "actor_name_audit_corrected": _names("min(actor) <> max(actor)"),
    "actor_film_pairs": with_inputs(
        ["actor_films"],
        [],
        "SELECT actorid, filmid, count(*) AS n_rows FROM actor_films GROUP BY ALL",
    ),
    "points_by_player_season": _points("season", SEASON_ROWS, ["game_rows", "games"], False),
    "points_by_player_season_corrected": _points(
        "season", SEASON_ROWS, ["game_rows", "games"], True
    ),
    "points_by_player_team": _points("team_id", "game_rows", ["game_rows"], False),
    "points_by_player_team_corrected": _points("team_id", "game_rows", ["game_rows"], True),
    "team_wins": _wins(["game_rows", "games"], "game_rows JOIN games USING (game_id)"),
    "team_wins_corrected": _wins(["games"], "games"),
    "rolling_wins": _best_window(
        [
            (
                "windows",
                f"SELECT {WINNER} AS team_id, least(90, row_number() OVER (PARTITION BY "
                f"{WINNER} ORDER BY game_date_est, game_id)) AS wins FROM games",
            )
        ]
    ),
    "rolling_wins_corrected": _best_window(
        [
            (
                "sides",
                "SELECT game_date_est, game_id, unnest([home_team_id, visitor_team_id]) "
                "AS team_id, unnest([home_team_wins, 1 - home_team_wins]) AS won FROM games",
            ),
            (
                "totals",
                "SELECT *, sum(won) OVER (PARTITION BY team_id ORDER BY game_date_est, "
                "game_id) AS so_far FROM sides",
            ),
            (
                "windows",
                "SELECT team_id, so_far - lag(so_far, 90, 0) OVER (PARTITION BY team_id "
                "ORDER BY game_date_est, game_id) AS wins FROM totals",
            ),
        ]
    ),
    "longest_streak": with_inputs(
        ["game_rows", "games"],
        [
            (
                "played",
                "SELECT player_id, game_date_est AS day, game_id, "
                "coalesce(max(pts), 0) > 10 AS hit FROM game_rows JOIN games USING (game_id) "
                "GROUP BY player_id, game_date_est, game_id",
            ),
            (
                "named",
                "SELECT *, count(*) FILTER (WHERE NOT hit) OVER (PARTITION BY player_id "
                "ORDER BY day, game_id) AS misses FROM played",
            ),
        ],
        """
        SELECT player_id, CAST(min(day) AS VARCHAR) AS streak_start_date,
               CAST(max(day) AS VARCHAR) AS streak_end_date, count(*) AS streak_length
        FROM named WHERE hit GROUP BY player_id, misses
        ORDER BY streak_length DESC, player_id, streak_start_date LIMIT 1
        """,
    ),
    "period_range": with_inputs(
        ["actor_films"],
        [],
        "SELECT min(year) AS min_year, max(year) AS max_year FROM actor_films",
    ),
    "distinct_rows": with_inputs(
        ["game_details"], [], "SELECT DISTINCT * FROM game_details"
    ),
    "players_with_prefix": with_inputs(
        ["game_details"], [], "SELECT * FROM game_details WHERE starts_with(player_name, 'red')"
    ),
    "key_audit": with_inputs(
        ["teams"],
        [],
        "SELECT team_id, count(*) AS n_rows, team_id IS NULL AS has_null FROM teams "
        "GROUP BY team_id HAVING count(*) > 1 OR team_id IS NULL",
    ),
    "enum_audit": with_inputs(
        ["game_rows"],
        [],
        f"SELECT {KEY}, start_position FROM game_rows "
        "WHERE NOT list_contains(['A', 'N'], start_position)",
    ),
}

# The stored fact holds the same rows.
ORACLES["fact_game_details_stored"] = ORACLES["fact_game_details"]
ORACLES["duplicate_keys_appended"] = ORACLES["duplicate_keys"]
ORACLES["rolling_wins_yearly"] = ORACLES["rolling_wins_corrected"]
ORACLES["longest_streak_yearly"] = ORACLES["longest_streak"]
