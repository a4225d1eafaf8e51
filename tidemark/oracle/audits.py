"""Statement of the declared-table audits, over the statements of the tables' queries."""

from __future__ import annotations

from tidemark.oracle import activity, games, graph, snapshots
from tidemark.sources import schemas


def _union(columns: str, *statements: str) -> str:
    return " UNION ALL ".join(f"SELECT {columns} FROM ({s}) AS t{i}" for i, s in enumerate(statements))


def _pairs(names: tuple[str, ...]) -> list[str]:
    return [graph.ORACLES[name] for name in names]


TABLES = [
    (schemas.PLAYERS, snapshots.ORACLES["cumulative_players_backfill"]),
    (schemas.PLAYERS_SCD, snapshots.ORACLES["scd2_build_players"]),
    (schemas.PLAYER_TRACKING, snapshots.ORACLES["player_tracking"]),
    (schemas.ACTORS, snapshots.ORACLES["cumulative_actors_backfill"]),
    (schemas.ACTOR_HISTORY_SCD, snapshots.ORACLES["scd2_build_actors"]),
    (schemas.USERS_CUMULATED, activity.ORACLES["users_cumulated_daily"]),
    (schemas.USER_DEVICES_CUMULATED, activity.ORACLES["user_devices_cumulated"]),
    (schemas.HOSTS_CUMULATED, activity.ORACLES["hosts_cumulated"]),
    (schemas.HOST_ACTIVITY_REDUCED, activity.ORACLES["host_activity_daily"]),
    (schemas.USERS_GROWTH_ACCOUNTING, activity.ORACLES["growth_accounting"]),
    (schemas.FACT_GAME_DETAILS, games.ORACLES["fact_game_details"]),
    (
        schemas.VERTICES,
        _union("identifier, type", *_pairs(("game_vertices", "player_vertices", "team_vertices"))),
    ),
    (
        schemas.EDGES,
        _union(
            ", ".join(schemas.EDGES.key), *_pairs(("plays_in_edges", "player_pair_edges"))
        ),
    ),
]


def _audit(table: schemas.Table, statement: str) -> list[str]:
    keys = ", ".join(table.key)
    null = " OR ".join(f"{k} IS NULL" for k in table.key)
    found = [
        f"SELECT '{table.name}' AS table_name, 'key' AS \"check\", count(*) AS n_violations "
        f"FROM (SELECT {keys} FROM ({statement}) GROUP BY {keys} HAVING count(*) > 1 OR {null})"
    ]
    for column, allowed in table.domains.items():
        listed = ", ".join(f"'{value}'" for value in allowed)
        found.append(
            f"SELECT '{table.name}', '{column}', count(*) FILTER ({column} NOT IN ({listed})) "
            f"FROM ({statement})"
        )
    return found


ORACLES = {
    "table_audits": " UNION ALL ".join(
        part for table, statement in TABLES for part in _audit(table, statement)
    )
}
