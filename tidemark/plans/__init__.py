"""Query catalogue: operators applied to the shaped inputs.

A query takes a reader ``table(name) -> DataFrame`` and returns flat columns:
dates as text, arrays joined into text, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.plans import activity, audits, games, graph, snapshots
from tidemark.sources.views import Reader

QUERIES: dict[str, Callable[[Reader], DataFrame]] = {
    **snapshots.QUERIES,
    **activity.QUERIES,
    **games.QUERIES,
    **graph.QUERIES,
    **audits.QUERIES,
}
