"""Grain, key and domain audits, profiles, and row deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import any_of
from tidemark.sources.schemas import Table


def one_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """First row of each key by ``order``, then by all other columns.

    The order is total up to identical rows, so the choice does not depend on
    how rows arrive. Spark limits each group before the shuffle as well, so a key
    with very many copies sends one row per task.
    """
    ties = [c for c in rows.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return key_counts(rows, keys).where(F.col("n_rows") > 1)


def key_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def name_audit(rows: DataFrame, key: str, name: str, corrected: bool = False) -> DataFrame:
    """Distinct names per id, for ids with more than one named row.

    Corrected, only ids with more than one distinct name are listed. Rows are
    reduced per id and name first, so an id with very many rows is spread out.
    """
    pairs = rows.groupBy(key, name).agg(F.count(name).alias("_named"))
    audit = pairs.groupBy(key).agg(
        F.count(name).alias("n_names"), F.sum("_named").alias("_named")
    )
    test = F.col("n_names") > 1 if corrected else F.col("_named") > 1
    return audit.where(test).select(key, "n_names")


def key_audit(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: repeated, or with a null part."""
    has_null = any_of([F.col(k).isNull() for k in keys])
    return (
        key_counts(rows, keys)
        .withColumn("has_null", has_null)
        .where((F.col("n_rows") > 1) | F.col("has_null"))
    )


def domain_audit(rows: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is outside the declared set; null belongs to every set."""
    return rows.where(~F.col(column).isin(*allowed))


def table_audit(rows: DataFrame, table: Table) -> DataFrame:
    """Violations of a declared table: keys that break its key, rows outside a domain.

    One grouping by the key counts both; null belongs to every domain.
    """
    outside = [
        F.count_if(~F.col(column).isin(*allowed)).alias(f"_outside_{column}")
        for column, allowed in table.domains.items()
    ]
    keys = rows.groupBy(*table.key).agg(F.count(F.lit(1)).alias("_rows"), *outside)
    has_null = any_of([F.col(k).isNull() for k in table.key])
    totals = keys.agg(
        F.count_if((F.col("_rows") > 1) | has_null).alias("_key"),
        *[F.coalesce(F.sum(f"_outside_{c}"), F.lit(0)).alias(f"_outside_{c}") for c in table.domains],
    )
    checks = [("key", "_key"), *[(c, f"_outside_{c}") for c in table.domains]]
    told = [
        F.struct(
            F.lit(table.name).alias("table_name"),
            F.lit(check).alias("check"),
            F.col(count).alias("n_violations"),
        )
        for check, count in checks
    ]
    return totals.select(F.inline(F.array(*told)))


def parts_audit(parts: Sequence[DataFrame], table: Table) -> DataFrame:
    """Violations of a declared table given in parts that have no key in common.

    Each part is grouped alone, so one that its own grouping or window has already
    dealt by the columns of the key is not shuffled again.
    """
    found = reduce(DataFrame.unionByName, [table_audit(rows, table) for rows in parts])
    return found.groupBy("table_name", "check").agg(F.sum("n_violations").alias("n_violations"))


def period_range(rows: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column."""
    return rows.agg(
        F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}")
    )


def distinct_rows(rows: DataFrame) -> DataFrame:
    return rows.distinct()


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).distinct()


def rows_with_prefix(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose text starts with the prefix; the test reaches the scan."""
    return rows.where(F.col(column).startswith(prefix))
