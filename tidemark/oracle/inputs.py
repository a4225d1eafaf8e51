"""DuckDB text of the shaped inputs, one common table expression each."""

from __future__ import annotations

INPUTS: dict[str, tuple[tuple[str, ...], str]] = {
    "actor_films": (
        (),
        """
        SELECT c_name AS actor,
               'A' || CAST(c_custkey AS VARCHAR) AS actorid,
               'Film#' || CAST(o_orderkey AS VARCHAR) AS film,
               CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(floor(o_totalprice) AS INTEGER) AS votes,
               CAST(floor(o_totalprice / 12500) AS DOUBLE) / 4 AS rating,
               'F' || CAST(o_orderkey AS VARCHAR) AS filmid
        FROM orders JOIN customer ON o_custkey = c_custkey
        """,
    ),
    "player_seasons": (
        (),
        """
        SELECT c_name AS player_name,
               'H' || CAST(max(c_custkey) % 30 AS VARCHAR) AS height,
               max(c_mktsegment) AS college,
               CAST(max(c_nationkey) AS VARCHAR) AS country,
               CAST(1990 + max(c_custkey) % 5 AS VARCHAR) AS draft_year,
               CAST(max(c_custkey) % 60 AS VARCHAR) AS draft_number,
               CAST(1 + max(c_custkey) % 2 AS VARCHAR) AS draft_round,
               CAST(year(o_orderdate) AS INTEGER) AS season,
               CAST(count(*) AS INTEGER) AS gp,
               sum(CAST(floor(o_totalprice / 5000) AS DOUBLE) / 4) / count(*) AS pts,
               min(CAST(floor(o_totalprice / 5000) AS DOUBLE) / 4) AS reb,
               max(CAST(floor(o_totalprice / 5000) AS DOUBLE) / 4) AS ast
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY c_name, year(o_orderdate)
        """,
    ),
    "games": (
        (),
        """
        SELECT o_orderkey AS game_id,
               CAST(o_orderdate AS DATE) AS game_date_est,
               CAST(year(o_orderdate) AS INTEGER) AS season,
               CAST(o_custkey % 25 AS INTEGER) AS home_team_id,
               CAST((o_custkey % 25 + 1 + o_orderkey % 24) % 25 AS INTEGER) AS visitor_team_id,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins,
               CAST(floor(o_totalprice) AS INTEGER) % 60 + 70 AS pts_home,
               CAST(floor(o_totalprice) AS INTEGER) % 50 + 70 AS pts_away
        FROM orders
        """,
    ),
    "game_rows_once": (
        ("games",),
        """
        SELECT game_id,
               CASE WHEN l_linenumber % 2 = 0 THEN home_team_id ELSE visitor_team_id END
                   AS team_id,
               'T' || CAST(CASE WHEN l_linenumber % 2 = 0 THEN home_team_id
                                ELSE visitor_team_id END AS VARCHAR) AS team_abbreviation,
               l_partkey AS player_id,
               l_returnflag AS start_position,
               CASE l_linenumber WHEN 5 THEN 'DNP - Coach' WHEN 6 THEN 'DND - Injury'
                                 WHEN 7 THEN 'NWT - Personal' END AS comment,
               CASE WHEN l_linenumber < 5
                    THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ':'
                         || lpad(CAST(l_linenumber * 7 AS VARCHAR), 2, '0') END AS min,
               CASE WHEN l_linenumber < 5 THEN CAST(l_quantity AS INTEGER) END AS pts,
               CAST(l_quantity AS INTEGER) % 11 AS fgm,
               CAST(l_quantity AS INTEGER) % 11 + l_linenumber AS fga,
               CAST(l_quantity AS INTEGER) % 5 AS fg3m,
               CAST(l_quantity AS INTEGER) % 5 + l_linenumber % 3 AS fg3a,
               CAST(l_quantity AS INTEGER) % 7 AS ftm,
               CAST(l_quantity AS INTEGER) % 7 + l_linenumber % 2 AS fta,
               CAST(l_quantity AS INTEGER) % 4 AS oreb,
               CAST(l_quantity AS INTEGER) % 9 AS dreb,
               CAST(l_quantity AS INTEGER) % 4 + CAST(l_quantity AS INTEGER) % 9 AS reb,
               CAST(l_quantity AS INTEGER) % 8 AS ast,
               CAST(l_quantity AS INTEGER) % 3 AS stl,
               CAST(l_quantity AS INTEGER) % 2 AS blk,
               l_linenumber % 4 AS turnovers,
               l_linenumber % 6 AS pf,
               CAST(l_quantity AS INTEGER) % 41 - 20 AS plus_minus
        FROM lineitem
        JOIN games ON l_orderkey = game_id
        """,
    ),
    "game_rows": (
        ("game_rows_once",),
        """
        SELECT * FROM game_rows_once
        UNION ALL
        SELECT * FROM game_rows_once WHERE game_id % 100 = 0
        """,
    ),
    "game_details": (
        ("game_rows",),
        """
        SELECT g.*, p_name || '#' || CAST(p_partkey AS VARCHAR) AS player_name
        FROM game_rows g JOIN part ON player_id = p_partkey
        """,
    ),
    "teams": (
        (),
        """
        SELECT n_nationkey AS team_id, 'T' || CAST(n_nationkey AS VARCHAR) AS abbreviation,
               n_name AS nickname, r_name AS city, n_name || ' Arena' AS arena,
               1946 + n_nationkey AS yearfounded
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL
        SELECT n_nationkey, 'T' || CAST(n_nationkey AS VARCHAR), n_name, r_name,
               n_name || ' Arena', 1946 + n_nationkey
        FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE n_nationkey < 5
        """,
    ),
    "events_web": (
        (),
        """
        SELECT CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS device_id,
               CASE WHEN event_id % 97 <> 0
                    THEN 'host' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5
                                        AS VARCHAR) END AS host,
               CASE WHEN event_type = 'purchase' THEN '/api/v1/login'
                    ELSE '/' || event_type END AS url,
               ts AS event_time
        FROM events
        """,
    ),
    "devices": (
        (),
        """
        SELECT p_partkey AS device_id,
               CASE WHEN p_partkey % 10 <> 0 THEN p_type END AS os_type,
               p_brand AS device_type,
               CASE WHEN p_partkey % 13 <> 0 THEN split_part(p_name, ' ', 1) END AS browser_type
        FROM part
        """,
    ),
}


def with_inputs(names: list[str], steps: list[tuple[str, str]], result: str) -> str:
    """One statement: the inputs needed, then named steps, then the result."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in INPUTS[name][0]:
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    parts = [(name, INPUTS[name][1]) for name in ordered] + steps
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in parts)
    return f"WITH {ctes}\n{result}"
