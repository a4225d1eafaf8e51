"""Cumulative snapshots: one row per key and period, holding its full history.

A snapshot row carries the key's attributes, an array with one element per past
fact, the class of the latest active period, the number of idle periods and
whether the key is active now. Two ways lead to the same snapshot: one step from
the period before, or one pass over all facts.

Groups are per (key, period) row, which the tables declare unique, so a key owns
at most one row per period and never a share of the whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.classify import (
    RATING_THRESHOLDS,
    SCORING_THRESHOLDS,
    threshold_class,
)
from tidemark.functions.scalars import percent_change


@dataclass(frozen=True)
class History:
    """Column names of one snapshot table and of the facts it is built from."""

    key: str
    period: str
    as_of: str
    carry: tuple[str, ...]
    element: tuple[str, ...]
    sort: str
    history: str
    score: str
    thresholds: tuple[tuple[str, float], ...]
    class_column: str
    idle: str | None
    active: str

    @property
    def columns(self) -> list[str]:
        idle = [self.idle] if self.idle else []
        return [
            self.key,
            *self.carry,
            self.history,
            self.class_column,
            *idle,
            self.as_of,
            self.active,
        ]


PLAYER_HISTORY = History(
    key="player_name",
    period="season",
    as_of="current_season",
    carry=("height", "college", "country", "draft_year", "draft_number", "draft_round"),
    element=("season", "gp", "pts", "reb", "ast"),
    sort="season",
    history="season_stats",
    score="pts",
    thresholds=SCORING_THRESHOLDS,
    class_column="scoring_class",
    idle="years_since_last_season",
    active="is_active",
)

ACTOR_HISTORY = History(
    key="actorid",
    period="year",
    as_of="current_year",
    carry=("actor",),
    element=("film", "votes", "rating", "filmid"),
    sort="filmid",
    history="films",
    score="rating",
    thresholds=RATING_THRESHOLDS,
    class_column="quality_class",
    idle=None,
    active="is_active",
)


def single_elements(facts: DataFrame, h: History) -> DataFrame:
    """Facts that already have one row per key and period."""
    return facts.select(
        h.key,
        *h.carry,
        h.period,
        F.array(F.struct(*h.element)).alias("_new"),
        F.col(h.score).cast("double").alias("_score"),
    )


def folded_elements(facts: DataFrame, h: History, elements: bool = True) -> DataFrame:
    """Facts with many rows per key and period, folded into one array.

    The score is averaged per key, while attributes split a key's rows: an id
    with two names gives two rows that share one average. One aggregation does
    both, and its partitioning by key also serves the join that follows. Without
    ``elements`` only scores and attributes are folded, whose size does not grow
    with the facts.
    """
    if not elements:
        folded = facts.groupBy(h.key, h.period).agg(
            F.avg(h.score).alias("_score"),
            F.collect_set(F.struct(*h.carry)).alias("_carried"),
        )
        return folded.withColumn("_carry", F.explode("_carried")).select(
            h.key, "_carry.*", h.period, F.lit(None).alias("_new"), "_score"
        )
    row = F.struct(F.col(h.sort).alias("_sort"), *h.carry, F.struct(*h.element).alias("_e"))
    folded = facts.groupBy(h.key, h.period).agg(
        F.avg(h.score).alias("_score"),
        F.sort_array(F.collect_list(row)).alias("_rows"),
    )
    carried = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in h.carry]))
    split = folded.withColumn("_carry", F.explode(F.array_distinct(carried)))

    def is_mine(r: Column) -> Column:
        same = F.struct(*[r[c].alias(c) for c in h.carry])
        return same.eqNullSafe(F.col("_carry"))

    return split.select(
        h.key,
        *[F.col("_carry")[c].alias(c) for c in h.carry],
        h.period,
        F.transform(F.filter("_rows", is_mine), lambda r: r["_e"]).alias("_new"),
        "_score",
    )


def cumulate_step(prev: DataFrame, facts: DataFrame, h: History, fold: bool = False) -> DataFrame:
    """Next snapshot from the previous one and the next period's facts."""
    today = folded_elements(facts, h) if fold else single_elements(facts, h)
    t, y = today.alias("t"), prev.alias("y")
    present = F.col(f"t.{h.period}").isNotNull()
    old = F.col(f"y.{h.history}")

    columns = {
        c: F.coalesce(F.col(f"t.{c}"), F.col(f"y.{c}")) for c in (h.key, *h.carry)
    }
    columns[h.history] = (
        F.when(old.isNull(), F.col("t._new"))
        .when(present, F.concat(old, F.col("t._new")))
        .otherwise(old)
    )
    columns[h.class_column] = F.when(
        present, threshold_class(F.col("t._score"), h.thresholds)
    ).otherwise(F.col(f"y.{h.class_column}"))
    if h.idle:
        columns[h.idle] = F.when(present, 0).otherwise(F.col(f"y.{h.idle}") + 1)
    columns[h.as_of] = F.coalesce(F.col(f"t.{h.period}"), F.col(f"y.{h.as_of}") + 1)
    columns[h.active] = present

    joined = t.join(y, F.col(f"t.{h.key}") == F.col(f"y.{h.key}"), "full_outer")
    return joined.select(*[columns[c].alias(c) for c in h.columns])


def cumulate_backfill(
    facts: DataFrame,
    h: History,
    end: int,
    start: int | None = None,
    fold: bool = False,
    attributes: str = "max",
    elements: bool = True,
    only_end: bool = False,
) -> DataFrame:
    """Every snapshot up to ``end`` in one pass and, unfolded, one shuffle.

    Each key's periods are collected once; the spine from its first period to
    ``end`` is generated beside them, and each snapshot is the prefix of the
    collected rows. ``attributes`` is ``max`` (over all facts) or ``latest`` (the
    last known value as of each period, as the step carries it), or ``none`` to
    leave them out. Without ``elements`` the history column is left out and its rows
    are not collected. With ``only_end`` the snapshot of ``end`` alone is made.
    """
    rows = folded_elements(facts, h, elements) if fold else single_elements(facts, h)
    in_span = F.col(h.period) <= end
    if start is not None:
        in_span = in_span & (F.col(h.period) >= start)
    new = ["_new"] if elements else []
    carry = () if attributes == "none" else h.carry
    row = F.struct(F.col(h.period).alias("_p"), "_score", *new, *carry)
    keys = rows.groupBy(h.key).agg(
        F.min(h.period).alias("_first"),
        F.sort_array(F.collect_list(F.when(in_span, row))).alias("_rows"),
        *[F.max(c).alias(c) for c in carry if attributes == "max"],
    )
    first = F.col("_first") if start is None else F.greatest("_first", F.lit(start))
    known_keys = keys.where(F.col("_first") <= end)
    if only_end:
        past = known_keys.withColumns({h.as_of: F.lit(end), "_past": F.col("_rows")})
    else:
        spine = known_keys.withColumn(h.as_of, F.explode(F.sequence(first, F.lit(end))))
        past = spine.withColumn(
            "_past", F.filter("_rows", lambda r: r["_p"] <= F.col(h.as_of))
        )
    past = past.withColumn("_last", F.try_element_at("_past", F.lit(-1)))

    def latest(c: str) -> Column:
        known = F.filter("_past", lambda r: r[c].isNotNull())
        return F.try_element_at(known, F.lit(-1))[c]

    columns = {h.key: F.col(h.key), h.as_of: F.col(h.as_of)}
    for c in carry:
        columns[c] = latest(c) if attributes == "latest" else F.col(c)
    if elements:
        columns[h.history] = F.flatten(F.transform("_past", lambda r: r["_new"]))
    columns[h.class_column] = threshold_class(F.col("_last._score"), h.thresholds)
    if h.idle:
        columns[h.idle] = F.col(h.as_of) - F.col("_last._p")
    columns[h.active] = F.col("_last._p") == F.col(h.as_of)
    kept = [c for c in h.columns if c in columns]
    return past.select(*[columns[c].alias(c) for c in kept])


def unnest_history(
    snapshots: DataFrame,
    keys: list[str],
    history: str,
    where: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per history element, all or those that ``where`` keeps, with its fields."""
    elements = F.filter(history, where) if where else F.col(history)
    return snapshots.select(*keys, F.inline(elements))


def history_bounds(snapshots: DataFrame, history: str, field: str) -> DataFrame:
    """Smallest and largest value of an element field, without unnesting."""
    values = F.transform(history, lambda e: e[field])
    return snapshots.agg(
        F.min(F.array_min(values)).alias(f"min_{field}"),
        F.max(F.array_max(values)).alias(f"max_{field}"),
    )


def first_latest_change(
    snapshots: DataFrame, key: str, history: str, field: str
) -> DataFrame:
    """Field of the first and latest history element and the change in percent."""
    first = F.try_element_at(history, F.lit(1))[field]
    latest = F.try_element_at(history, F.lit(-1))[field]
    return snapshots.select(
        key,
        first.alias("first_value"),
        latest.alias("latest_value"),
        percent_change(first, latest).alias("percentage"),
    )
