"""Removal of lines repeated across documents, by windows of three lines.

Consecutive lines are hashed in overlapping windows; a window's first occurrence,
by doc_id and place, stays, and the lines that any later occurrence covers are
removed, overlapping ones merged. All of it is DataFrame functions.

Lines are what line feeds part, wordless ones included; a window without any word
is no window. Hashes have 128 bits.

Cases: a null text stays null and has no lines, nor has an empty one; a document
of fewer lines than a window keeps all; null ids come before all others; documents
of one id are ordered by a hash of the text; rows equal in id and text are one
document stated twice and get the same result; tables may be empty; other columns
are left behind by ``repeated_lines`` and kept by ``without_repeats``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed, matched, prepare

LINES = 3
#: Fixed value: a character of a word.
WORD = r"[^\x20\x09-\x0D]"
SECOND = "second hash"


def _lines(text: str) -> Column:
    """Lines of a text; none of a null or empty one."""
    return F.when(F.length(text) > 0, F.split(text, "\n", -1)).otherwise(F.array())


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """Every window with a word: its document, the number of its first line, hashes."""
    rows = keyed(docs).select("doc_id", "text_key", _lines("text").alias("lines"))
    rows = rows.where(F.size("lines") >= width)

    def window(i: Column) -> Column:
        held = F.slice("lines", i + 1, width)
        return F.struct(
            i.alias("place"),
            F.xxhash64(held).alias("h1"),
            F.xxhash64(F.lit(SECOND), held).alias("h2"),
            F.exists(held, lambda line: line.rlike(WORD)).alias("told"),
        )

    places = F.sequence(F.lit(0), F.size("lines") - width)
    found = rows.select("doc_id", "text_key", F.inline(F.transform(places, window)))
    return found.where("told").drop("told")


def covered_lines(docs: DataFrame, width: int = LINES) -> DataFrame:
    """Documents that lose lines: doc_id, text_key and the sorted numbers ``gone``."""
    prepare(docs.sparkSession)
    windows = _windows(docs, width)
    place = F.struct("doc_id", "text_key", "place")
    firsts = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .drop("last")
    )
    later = windows.join(firsts, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    reach = F.transform(F.collect_set("place"), lambda x: F.sequence(x, x + (width - 1)))
    return later.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.array_distinct(F.flatten(reach))).alias("gone")
    )


def _kept(text: str) -> Column:
    """The text without the lines numbered in ``gone``; unchanged if there are none.

    Lines are told by place from an array that is split once, so the work follows the
    lines, however many go.
    """
    lines = _lines(text)
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    held = F.array(F.struct(lines.alias("lines"), places.alias("places")))
    kept = F.get(
        F.transform(held, lambda s: F.transform(s["places"], lambda i: F.get(s["lines"], i))),
        F.lit(0),
    )
    return F.when(F.size("gone") == 0, F.col(text)).otherwise(F.array_join(kept, "\n"))


def _marked(docs: DataFrame, width: int) -> tuple[DataFrame, dict[str, str]]:
    """Documents, columns named by place, with the lines they lose in ``gone``."""
    rows, names = matched(docs, covered_lines(docs, width), "left")
    none = F.array().cast("array<int>")
    return rows.withColumn("gone", F.coalesce("gone", none)), names


def repeated_lines(docs: DataFrame, width: int = LINES) -> DataFrame:
    """Each document's lines and losses.

    Returns doc_id, text (what is kept), n_lines, n_removed and removed (numbers of
    the removed lines, from 0).
    """
    rows, names = _marked(docs.select("doc_id", "text"), width)
    return rows.select(
        F.col(names["doc_id"]).alias("doc_id"),
        _kept(names["text"]).alias("text"),
        F.size(_lines(names["text"])).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        F.col("gone").alias("removed"),
    )


def without_repeats(docs: DataFrame, width: int = LINES) -> DataFrame:
    """The documents, all columns, with the kept lines as text.

    ``n_chars``, where there is one, follows the text.
    """
    rows, names = _marked(docs, width)
    changed = {names["text"]: _kept(names["text"])}
    if "n_chars" in names:
        length = F.length(_kept(names["text"])).cast(docs.schema["n_chars"].dataType)
        n_chars = F.when(F.size("gone") > 0, length).otherwise(F.col(names["n_chars"]))
        changed[names["n_chars"]] = n_chars
    return rows.withColumns(changed).select(*names.values()).toDF(*docs.columns)
