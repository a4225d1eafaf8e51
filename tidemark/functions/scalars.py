"""Small scalar expressions: guarded arithmetic, text and JSON properties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_change(first: Column, latest: Column) -> Column:
    """Change from first to latest in percent; 0 where the first value is 0."""
    first, latest = first.cast("double"), latest.cast("double")
    return F.when(first == 0, F.lit(0.0)).otherwise((latest - first) * 100 / first)


def ratio_or_whole(numerator: Column, denominator: Column) -> Column:
    """Quotient with a zero denominator replaced by one."""
    denominator = denominator.cast("double")
    return numerator.cast("double") / F.when(denominator == 0, F.lit(1.0)).otherwise(denominator)


def clock_minutes(clock: Column) -> Column:
    """Minutes from ``mm:ss``; null where either part is missing."""

    def part(n: int) -> Column:
        return F.split_part(clock, F.lit(":"), F.lit(n)).try_cast("double")

    return part(1) + part(2) / 60


def mentions(text: Column, word: str) -> Column:
    """Whether the text holds the word; null text does not."""
    return F.coalesce(F.contains(text, F.lit(word)), F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def all_of(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def json_object(*fields: Column) -> Column:
    """JSON object of the named fields; null fields are kept."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def json_field(properties: Column | str, name: str, kind: str = "string") -> Column:
    """Field of a JSON object, as text or cast to ``kind``."""
    value = F.get_json_object(properties, f"$.{name}")
    return value if kind == "string" else value.try_cast(kind)


def json_fields(properties: str, *names: str) -> Column:
    """Several fields of a JSON object as text columns, parsed once per row."""
    return F.json_tuple(properties, *names).alias(*names)


def same_day(moment: Column, day: Column) -> Column:
    """``moment`` falls on ``day``, written as a range that reaches the scan."""
    return (moment >= day) & (moment < F.date_add(day, 1))
