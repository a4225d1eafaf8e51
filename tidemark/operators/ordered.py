"""Running totals over long ordered groups, without one task per group.

A window over a whole key would put that key into one task. Here rows fall into
cells by coarse-to-fine levels of their order; windows run inside a cell and over
the much shorter lists of cells, and a cell's total over everything before it
completes the running total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of

# Unique whole-number ids leave at most this many rows in a cell.
ID_WIDTH = 1 << 20


def id_cell(column: str) -> Column:
    """Range of ids a row falls into."""
    return F.floor(F.col(column) / ID_WIDTH)


def totals_before(
    cells: DataFrame, keys: Sequence[str], levels: Sequence[str], total: str
) -> DataFrame:
    """Cells with ``_before``, the key's sum of ``total`` over all earlier cells.

    ``cells`` has one row per keys and levels; a null level is a cell of its own,
    before all others. Each level's totals come off the last level's windows, so
    cells are shuffled once per level.
    """
    *outer, last = levels
    group = Window.partitionBy(*keys, *outer)
    earlier = group.orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
    inner = cells.withColumn("_before", F.coalesce(F.sum(total).over(earlier), F.lit(0)))
    if not outer:
        return inner
    whole = inner.withColumn("_whole", F.sum(total).over(group))
    place = F.row_number().over(group.orderBy(last))
    first = whole.withColumn("_is_first", place == 1)
    coarse = first.where("_is_first").select(*keys, *outer, F.col("_whole").alias(total))
    offsets = totals_before(coarse, keys, outer, total).select(
        *keys, *outer, F.col("_before").alias("_earlier")
    )
    i, o = inner.alias("i"), offsets.alias("o")
    same = all_of([F.col(f"i.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*keys, *outer)])
    before = (F.col("i._before") + F.col("o._earlier")).alias("_before")
    return i.join(o, same).select(*[F.col(f"i.{c}") for c in cells.columns], before)
