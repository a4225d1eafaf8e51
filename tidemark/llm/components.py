"""Connected components of a graph given by its edges.

Every round each vertex moves to the neighbour, or itself, of least random rank,
and the graph is contracted: the vertices left shrink by a constant factor a round
in expectation, whatever the shape, so rounds grow with the logarithm of the
vertices. A hub's neighbours are summed up before they meet, and each round is
written to the shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored as written

#: Edges to a task; the graph shrinks every round, and its tasks with it.
TASK_EDGES = 1 << 19


def components(
    edges: DataFrame, stored: Callable[[DataFrame, str], DataFrame] = written
) -> DataFrame:
    """Vertices of ``edges`` (a, b) with the root of their component.

    Loops and repeated edges may be given. Vertices without an edge to another
    vertex are their own and are not returned. ``stored`` writes a round's rows and
    reads them back.
    """
    graph = stored(_simple(edges.select("a", "b")), "edges")
    roots = None
    turn = 0
    while size := graph.count():
        tasks = -(-size // TASK_EDGES)
        near, own = (
            F.struct(F.xxhash64(F.lit(turn), F.col(x)).alias("rank"), F.col(x).alias("vertex"))
            for x in ("b", "a")
        )
        moves = (
            graph.union(graph.select("b", "a"))
            .groupBy("a")
            .agg(F.min(near).alias("near"))
            .select("a", F.least(F.col("near"), own)["vertex"].alias("to"))
        )
        moves = stored(moves.coalesce(tasks), "moves")
        step_a = moves.select("a", F.col("to").alias("to_a"))
        step_b = moves.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        moved = graph.join(step_a, "a").join(step_b, "b").select(
            F.col("to_a").alias("a"), F.col("to_b").alias("b")
        )
        graph = stored(_simple(moved).coalesce(tasks), "edges")
        if roots is None:
            roots = moves.select(F.col("a").alias("vertex"), F.col("to").alias("root"))
        else:
            following = moves.select(F.col("a").alias("root"), "to")
            roots = roots.join(following, "root", "left").select(
                "vertex", F.coalesce("to", "root").alias("root")
            )
        turn += 1
    if roots is None:
        return graph.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return stored(roots, "roots")


def _simple(edges: DataFrame) -> DataFrame:
    """Each edge once, between two vertices."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
