"""Type-2 history that takes its periods in any order, late, again or corrected.

A version spans periods that nobody has told of yet, so what lies inside it can't be
known from it alone. Kept in its place are covers: spans of consecutive known periods
with equal values. Splicing a late period in touches only the cover around it and its
two neighbours, and the history of versions follows from covers at any time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of
from tidemark.operators.scd import Scd, versions_of

#: Optional column of late rows: true takes the period out of the history.
WITHDRAWN = "withdrawn"


def cover_columns(s: Scd) -> list[str]:
    return [s.key, *s.carry, *s.tracked, s.start, s.end]


def _joined(spans: DataFrame, s: Scd) -> DataFrame:
    """Disjoint spans, those that touch and agree made one; nulls agree with nulls."""
    values = [*s.carry, *s.tracked]
    w = Window.partitionBy(s.key).orderBy(s.start)
    before = spans.select(
        "*",
        F.lag(s.end).over(w).alias("_prev_end"),
        *[F.lag(c).over(w).alias(f"_prev_{c}") for c in values],
    )
    agrees = all_of(
        [
            F.col(s.start) == F.col("_prev_end") + 1,
            *[F.col(c).eqNullSafe(F.col(f"_prev_{c}")) for c in values],
        ]
    )
    opens = F.when(agrees, 0).otherwise(1)
    numbered = before.withColumn("_opens", opens).withColumn("_span", F.sum("_opens").over(w))
    return (
        numbered.groupBy(s.key, *values, "_span")
        .agg(F.min(s.start).alias(s.start), F.max(s.end).alias(s.end))
        .select(*cover_columns(s))
    )


def _one_a_period(rows: DataFrame, s: Scd) -> DataFrame:
    """Rows of one key and period made one, the greatest by its values."""
    values = [*s.carry, *s.tracked, *([WITHDRAWN] if WITHDRAWN in rows.columns else [])]
    told = rows.where(F.col(s.period).isNotNull())
    best = told.groupBy(s.key, s.period).agg(F.max(F.struct(*values)).alias("_best"))
    return best.select(s.key, F.col(s.period), "_best.*")


def covers(snapshots: DataFrame, s: Scd) -> DataFrame:
    """Covers of all snapshots, in one shuffle by key."""
    one = _one_a_period(snapshots, s)
    start, end = F.col(s.period).alias(s.start), F.col(s.period).alias(s.end)
    return _joined(one.select(s.key, *s.carry, *s.tracked, start, end), s)


def splice(spans: DataFrame, late: DataFrame, s: Scd) -> DataFrame:
    """Covers with late rows in: of periods unknown so far, or in place of known ones.

    ``late`` has the snapshot's columns and may have ``withdrawn``, which takes its
    period out. Of several rows of one key and period the greatest by its values
    counts; a row without a period has no place and none is made for it. A key's
    periods stand in one row while its covers are cut, so that row is bounded by the
    number of periods. Every cover handed in is sorted once: hand in those of the keys
    concerned, or of the shelves they stand on.
    """
    one = _one_a_period(late, s)
    cuts = one.groupBy(s.key).agg(F.sort_array(F.collect_set(s.period)).alias("_cuts")).alias("c")
    known = spans.select(*cover_columns(s)).alias("k")
    met = known.join(cuts, F.col(f"k.{s.key}").eqNullSafe(F.col(f"c.{s.key}")), "left")
    first, last = F.col(f"k.{s.start}"), F.col(f"k.{s.end}")
    inside = F.filter(
        F.coalesce("c._cuts", F.array().cast(one.select(F.array(s.period)).schema[0].dataType)),
        lambda p: (p >= first) & (p <= last),
    )
    pieces = F.arrays_zip(
        F.concat(F.array(first), F.transform(inside, lambda p: p + 1)).alias(s.start),
        F.concat(F.transform(inside, lambda p: p - 1), F.array(last)).alias(s.end),
    )
    left = F.filter(pieces, lambda p: p[s.start] <= p[s.end])
    values = [s.key, *s.carry, *s.tracked]
    cut = met.select(*[F.col(f"k.{c}") for c in values], F.inline(left))
    stays = ~F.coalesce(F.col(WITHDRAWN), F.lit(False)) if WITHDRAWN in one.columns else F.lit(True)
    start, end = F.col(s.period).alias(s.start), F.col(s.period).alias(s.end)
    put = one.where(stays).select(*values, start, end)
    return _joined(cut.unionByName(put), s)


def history_of(spans: DataFrame, s: Scd, as_of: int, null_safe: bool = False) -> DataFrame:
    """What ``scd2_build`` makes of the snapshots that were spliced, in whatever order."""
    known = spans.where(F.col(s.start) <= as_of).select(
        s.key,
        *s.carry,
        *s.tracked,
        s.start,
        F.least(F.col(s.end), F.lit(as_of)).alias(s.end),
    )
    return versions_of(known, s, as_of, null_safe)
