"""Cumulative histories in rows of a bounded size.

The history of a key is cut into numbered segments of so many elements each. Full
segments are closed: written once, in the period that filled them, and never again.
What is left, always less than a segment, stands open in the key's head, the
snapshot row of every period, beside the number of elements there are. So no row
grows with a key's history, and a period writes its own elements, once more the open
ones of the keys it touches, and one bounded head a key.

A key has one set of carried attributes: rows of other ones are keys of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.classify import threshold_class
from tidemark.functions.scalars import all_of
from tidemark.operators.cumulative import History

#: Elements of a segment.
BOUND = 1000


def _names(h: History) -> list[str]:
    return [h.key, *h.carry]


def _same(left: str, right: str, names: list[str]) -> Column:
    return all_of([F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names])


def segment_step(
    heads: DataFrame, facts: DataFrame, h: History, period: int, bound: int = BOUND
) -> tuple[DataFrame, DataFrame]:
    """Heads of a period, and the segments that it closes.

    ``heads`` are those of the period before and ``facts`` the period's, any number
    for a key. Heads have the snapshot's columns, but of the history its open part
    alone, and ``elements``, the number of all. Segments have the key's columns,
    ``segment`` (from 0), the history's elements and ``closed_in``.
    """
    names = _names(h)
    element = F.struct(*h.element).alias("_e")
    own = Window.partitionBy(*names).orderBy(h.sort, "_e")
    rows = facts.select(*names, h.sort, element, h.score).withColumn(
        "_n", F.row_number().over(own)
    )
    y = heads.select(*names, h.history, "elements").alias("y")
    known = rows.alias("t").join(y, _same("t", "y", names), "left")
    start = F.coalesce("y.elements", F.lit(0))
    new = known.select(
        *[F.col(f"t.{c}").alias(c) for c in names],
        (start + F.col("t._n") - 1).alias("place"),
        F.col("t._e").alias("_e"),
    )
    touched = facts.select(*names).distinct().alias("t")
    opened = touched.join(y, _same("t", "y", names)).select(
        *[F.col(f"y.{c}").alias(c) for c in names],
        (F.col("y.elements") - F.size(f"y.{h.history}")).alias("_from"),
        F.posexplode(f"y.{h.history}").alias("_i", "_e"),
    )
    old = opened.select(*names, (F.col("_from") + F.col("_i")).alias("place"), "_e")
    # A group has a segment's elements at most.
    cut = (
        new.unionByName(old)
        .groupBy(*names, F.floor(F.col("place") / bound).cast("int").alias("segment"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "_e"))).alias("_rows"))
        .select(*names, "segment", F.transform("_rows", lambda r: r["_e"]).alias(h.history))
    )
    closed = cut.where(F.size(h.history) == bound).withColumn("closed_in", F.lit(period))
    left = cut.where(F.size(h.history) < bound).select(*names, F.col(h.history).alias("_open"))

    scores = facts.groupBy(h.key).agg(F.avg(h.score).alias("_score"))
    counts = facts.groupBy(*names).agg(F.count(F.lit(1)).alias("_new"))
    today = counts.join(scores, counts[h.key].eqNullSafe(scores[h.key])).drop(scores[h.key])
    today = today.alias("c").join(left.alias("l"), _same("c", "l", names), "left")
    today = today.select(*[F.col(f"c.{c}") for c in names], "_new", "_score", "_open").alias("t")
    o = heads.alias("o")
    present = F.col("t._new").isNotNull()
    none = F.array().cast(heads.schema[h.history].dataType)
    columns = {c: F.coalesce(F.col(f"t.{c}"), F.col(f"o.{c}")) for c in names}
    columns[h.history] = F.when(present, F.coalesce("t._open", none)).otherwise(
        F.col(f"o.{h.history}")
    )
    columns[h.class_column] = F.when(
        present, threshold_class(F.col("t._score"), h.thresholds)
    ).otherwise(F.col(f"o.{h.class_column}"))
    if h.idle:
        columns[h.idle] = F.when(present, 0).otherwise(F.col(f"o.{h.idle}") + 1)
    columns[h.as_of] = F.lit(period)
    columns[h.active] = present
    columns["elements"] = F.coalesce("o.elements", F.lit(0)) + F.coalesce("t._new", F.lit(0))
    joined = today.join(o, _same("t", "o", names), "full_outer")
    return joined.select(*[columns[c].alias(c) for c in [*h.columns, "elements"]]), closed


def history_elements(heads: DataFrame, segments: DataFrame, h: History) -> DataFrame:
    """One row per element of the heads' histories, with its place, from 0.

    ``heads`` are of one period; no array of all elements is made.
    """
    names = _names(h)
    past = heads.select(*names, h.as_of).alias("h").join(
        segments.alias("s"),
        _same("h", "s", names) & (F.col("s.closed_in") <= F.col(f"h.{h.as_of}")),
    )
    size = F.size(f"s.{h.history}")
    closed = past.select(
        *[F.col(f"h.{c}").alias(c) for c in names],
        (F.col("s.segment") * size).alias("_from"),
        F.posexplode(f"s.{h.history}").alias("_i", "_e"),
    )
    opened = heads.select(
        *names,
        (F.col("elements") - F.size(h.history)).alias("_from"),
        F.posexplode(h.history).alias("_i", "_e"),
    )
    both = closed.unionByName(opened)
    return both.select(*names, (F.col("_from") + F.col("_i")).cast("long").alias("place"), "_e.*")


def whole_histories(heads: DataFrame, segments: DataFrame, h: History) -> DataFrame:
    """Snapshot rows with the whole history in one array, for keys known to be short."""
    names = _names(h)
    keys = [*names, h.as_of]
    past = heads.select(*keys).alias("h").join(
        segments.alias("s"),
        _same("h", "s", names) & (F.col("s.closed_in") <= F.col(f"h.{h.as_of}")),
    )
    told = (
        past.groupBy(*[F.col(f"h.{c}").alias(c) for c in keys])
        .agg(F.sort_array(F.collect_list(F.struct("s.segment", f"s.{h.history}"))).alias("_past"))
        .alias("p")
    )
    o = heads.alias("o")
    flat = F.flatten(F.transform("p._past", lambda s: s[h.history]))
    whole = F.when(F.col("p._past").isNull(), F.col(f"o.{h.history}")).otherwise(
        F.concat(flat, F.col(f"o.{h.history}"))
    )
    columns = [
        whole.alias(c) if c == h.history else F.col(f"o.{c}").alias(c) for c in h.columns
    ]
    return o.join(told, _same("o", "p", keys), "left").select(*columns)
