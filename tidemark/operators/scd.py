"""Type-2 history: validity intervals, closed at both ends, of tracked attributes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of, any_of


@dataclass(frozen=True)
class Scd:
    """Column names shared by a snapshot table and its history table."""

    key: str
    period: str
    tracked: tuple[str, ...]
    carry: tuple[str, ...]
    start: str
    end: str

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.carry, *self.tracked, self.period, self.start, self.end]


PLAYER_SCD = Scd(
    "player_name",
    "current_season",
    ("scoring_class", "is_active"),
    (),
    "start_season",
    "end_season",
)
ACTOR_SCD = Scd(
    "actorid",
    "current_year",
    ("is_active", "quality_class"),
    ("actor",),
    "start_year",
    "end_year",
)


def _differs(a: Column, b: Column, null_safe: bool) -> Column:
    return ~a.eqNullSafe(b) if null_safe else a != b


def scd2_build(snapshots: DataFrame, s: Scd, as_of: int, null_safe: bool = False) -> DataFrame:
    """History of all snapshots up to ``as_of``.

    Both windows and the grouping share one exchange by key. A key has one row
    per period, so a window spans at most the number of periods. A null alone is
    no change unless ``null_safe``.
    """
    known = snapshots.where(F.col(s.period) <= as_of).select(
        s.key, *s.carry, *s.tracked, F.col(s.period).alias(s.start), F.col(s.period).alias(s.end)
    )
    return versions_of(known, s, as_of, null_safe)


def versions_of(spans: DataFrame, s: Scd, as_of: int, null_safe: bool) -> DataFrame:
    """History of disjoint spans of equal values, each of one period or more."""
    w = Window.partitionBy(s.key).orderBy(s.start)
    before = spans.select("*", *[F.lag(c).over(w).alias(f"_prev_{c}") for c in s.tracked])
    changed = any_of([_differs(F.col(c), F.col(f"_prev_{c}"), null_safe) for c in s.tracked])
    flagged = before.withColumn("_changed", F.when(changed, 1).otherwise(0))
    streaks = flagged.withColumn("_streak", F.sum("_changed").over(w))
    return (
        streaks.groupBy(s.key, *s.carry, *s.tracked, "_streak")
        .agg(F.min(s.start).alias(s.start), F.max(s.end).alias(s.end))
        .withColumn(s.period, F.lit(as_of))
        .select(*s.columns)
    )


def scd2_step(
    history: DataFrame,
    snapshot: DataFrame,
    s: Scd,
    as_of: int,
    extend_unchanged: bool = True,
    keep_missing: bool = False,
    null_safe: bool = False,
    closed_of_all_versions: bool = False,
) -> DataFrame:
    """History as of the snapshot's period, from the history as of ``as_of``.

    One join of the open intervals with the snapshot classifies each key, and an
    inlined array emits its rows: extended if unchanged, closed and opened if
    changed, opened if new. Keys absent from the snapshot are dropped unless
    ``keep_missing``. With nulls on either side a key is neither unchanged nor
    changed by that attribute unless ``null_safe``. ``closed_of_all_versions``
    keeps closed rows of every stored version, not only that of ``as_of``.
    """
    this_version = F.col(s.period) == as_of
    ended_before = F.col(s.end) < as_of
    closed = history.where(ended_before if closed_of_all_versions else this_version & ended_before)
    still_open = history.where(this_version & (F.col(s.end) == as_of))

    t, y = snapshot.alias("t"), still_open.alias("y")
    pairs = [(F.col(f"t.{c}"), F.col(f"y.{c}")) for c in s.tracked]
    changed = any_of([_differs(a, b, null_safe) for a, b in pairs])
    unchanged = all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
    is_new, is_missing = F.col(f"y.{s.key}").isNull(), F.col(f"t.{s.key}").isNull()
    period = F.col(f"t.{s.period}")

    def interval(carry: str, tracked: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{carry}.{c}").alias(c) for c in (s.key, *s.carry)],
            *[F.col(f"{tracked}.{c}").alias(c) for c in s.tracked],
            start.alias(s.start),
            end.alias(s.end),
        )

    y_start, y_end = F.col(f"y.{s.start}"), F.col(f"y.{s.end}")
    opened = interval("t", "t", period, period)
    ended = interval("t", "y", y_start, y_end)
    same = interval("y", "y", y_start, period if extend_unchanged else y_end)
    lapsed = interval("y", "y", y_start, y_end)

    emitted = (
        F.when(is_missing, F.array(lapsed))
        .when(is_new, F.array(opened))
        .when(unchanged, F.array(same))
        .when(changed, F.array(ended, opened))
    )
    how = "full_outer" if keep_missing else "left"
    moved = t.join(y, F.col(f"t.{s.key}") == F.col(f"y.{s.key}"), how).select(F.inline(emitted))

    names = [s.key, *s.carry, *s.tracked, s.start, s.end]
    return (
        closed.select(*names)
        .unionByName(moved.select(*names))
        .withColumn(s.period, F.lit(as_of + 1))
        .select(*s.columns)
    )
