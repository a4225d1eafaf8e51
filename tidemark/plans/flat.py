"""Flat text forms of dates and arrays for query results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text(*columns: str) -> list[Column]:
    return [F.col(c).cast("string").alias(c) for c in columns]


def joined(column: str) -> Column:
    """Array elements as text, separated by commas."""
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


def flat_dates(rows: DataFrame) -> DataFrame:
    """All date columns as text and all date arrays as joined text."""
    columns = []
    for name, kind in rows.dtypes:
        if kind == "date":
            columns += text(name)
        elif kind.startswith("array"):
            columns.append(joined(name))
        else:
            columns.append(F.col(name))
    return rows.select(*columns)
