"""Statements for the property graph queries, on plain columns in place of JSON."""

from __future__ import annotations

from tidemark.oracle.inputs import with_inputs

ORDER = "start_position, pts NULLS FIRST, team_id, team_abbreviation"


def _kept(source: str, more: str = "") -> tuple[str, str]:
    """One row per player and game."""
    return (
        "kept",
        f"SELECT DISTINCT ON (player_id, game_id) * FROM {source} "
        f"ORDER BY player_id, game_id, {ORDER}{more}",
    )


PLAYERS = (
    "careers",
    "SELECT player_id, max(player_name) AS player_name, count(*) AS number_of_games, "
    "CAST(sum(pts) AS BIGINT) AS total_points, "
    "to_json(list_sort(list(DISTINCT team_id))) AS teams FROM game_details GROUP BY player_id",
)
MEETINGS = (
    "meetings",
    """
    SELECT l.player_id AS subject, r.player_id AS object,
           if(l.team_abbreviation = r.team_abbreviation, 'shares_team', 'plays_against')
               AS edge_type,
           count(*) AS num_games, CAST(sum(l.pts) AS BIGINT) AS subject_points,
           CAST(sum(r.pts) AS BIGINT) AS object_points
    FROM kept l JOIN kept r USING (game_id)
    WHERE l.player_name > r.player_name
    GROUP BY ALL
    """,
)


def _text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c.split('.')[-1]}" for c in columns)


ORACLES = {
    "game_vertices": with_inputs(
        ["games"],
        [],
        f"SELECT CAST(game_id AS VARCHAR) AS identifier, 'game' AS type, "
        f"{_text('pts_home', 'pts_away')}, CAST(if(home_team_wins = 1, home_team_id, "
        "visitor_team_id) AS VARCHAR) AS winning_team FROM games",
    ),
    "player_vertices": with_inputs(
        ["game_details"],
        [PLAYERS],
        "SELECT CAST(player_id AS VARCHAR) AS identifier, 'player' AS type, player_name, "
        f"{_text('number_of_games', 'total_points', 'teams')} FROM careers",
    ),
    "team_vertices": with_inputs(
        ["teams"],
        [],
        "SELECT DISTINCT CAST(team_id AS VARCHAR) AS identifier, 'team' AS type, "
        "abbreviation, nickname, city, arena, CAST(yearfounded AS VARCHAR) AS year_founded "
        "FROM teams",
    ),
    "vertex_counts": with_inputs(
        ["games", "game_details", "teams"],
        [],
        "SELECT 'game' AS type, count(*) AS n_vertices FROM games UNION ALL "
        "SELECT 'player', count(DISTINCT player_id) FROM game_details UNION ALL "
        "SELECT 'team', count(DISTINCT team_id) FROM teams",
    ),
    "plays_in_edges": with_inputs(
        ["game_rows"],
        [_kept("game_rows")],
        "SELECT CAST(player_id AS VARCHAR) AS subject_identifier, 'player' AS subject_type, "
        "CAST(game_id AS VARCHAR) AS object_identifier, 'game' AS object_type, "
        f"'plays_in' AS edge_type, start_position, {_text('pts', 'team_id')}, "
        "team_abbreviation FROM kept",
    ),
    "player_pair_edges": with_inputs(
        ["game_details"],
        [_kept("game_details", ", player_name"), MEETINGS],
        "SELECT CAST(subject AS VARCHAR) AS subject_identifier, 'player' AS subject_type, "
        "CAST(object AS VARCHAR) AS object_identifier, 'player' AS object_type, edge_type, "
        f"{_text('num_games', 'subject_points', 'object_points')} FROM meetings",
    ),
    "best_game": with_inputs(
        ["game_details"],
        [_kept("game_details", ", player_name")],
        "SELECT player_name, max(pts) AS max_points FROM kept GROUP BY player_name",
    ),
    "pair_stats": with_inputs(
        ["game_details"],
        [PLAYERS, _kept("game_details", ", player_name"), MEETINGS],
        "SELECT player_name, CAST(object AS VARCHAR) AS object_identifier, "
        "CAST(total_points AS DOUBLE) / greatest(number_of_games, 1) AS avg_points, "
        f"{_text('m.subject_points', 'num_games')} "
        "FROM careers JOIN meetings m ON m.subject = player_id",
    ),
}


def _together(*names: str) -> str:
    return " UNION ALL BY NAME ".join(f"SELECT * FROM ({ORACLES[name]})" for name in names)


# The stored tables hold the rows of all kinds.
ORACLES["edges_stored"] = _together("plays_in_edges", "player_pair_edges")
ORACLES["vertices_stored"] = _together("game_vertices", "player_vertices", "team_vertices")
