"""DuckDB statements that give the same rows as the query catalogue.

They are written as closed forms over the shaped inputs, not as the operators
work, so that agreement of the two is evidence for both.
"""

from __future__ import annotations

from tidemark.oracle import activity, audits, games, graph, snapshots

ORACLES: dict[str, str] = {
    **snapshots.ORACLES,
    **activity.ORACLES,
    **games.ORACLES,
    **graph.ORACLES,
    **audits.ORACLES,
}
