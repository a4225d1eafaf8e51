"""What filters remove together and alone, in every order, from sorted posting lists.

Each filter's failing documents are kept as sorted lists, for one part of the
documents and one range of ids at a time. What a filter removes after others is the
difference of its list and their union; unions are k-way merges and differences
merges of two, both galloping: where one list alone has ids, the end of that run is
found by doubling steps and the run is copied whole, and where lists mingle a range
of ids is merged at once. Sizes are summed over ranges, so ranges may be cut
anywhere; all orders of the filters follow from the sums, one for each filter and
each set of filters before it.

Failing is decided in DataFrame functions: A under 100 words; B fewer than 80 % of
words distinct; C over 10 % of the code points in A-Z; D any of ``#$%&*|``; E the
same text as a document of smaller id, wherever that one is.

Cases: a null or empty text has no words and fails A (and E, if it is not the
first such); a null id is smaller than none and none is smaller than it; a null
language is the part of the empty string; rows equal in id and text each count and
are no copies of each other; labels may repeat an id, any row with 1 counts, and
documents without labels are neither good nor toxic; empty tables give no rows;
other columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepare

FILTERS = "ABCDE"
#: What parts words, and the characters that D looks for.
WHITE = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
#: Documents in a range of ids, at most.
RANGE_ROWS = 1 << 16
#: Ids that are merged at once where lists mingle, and the shortest run copied whole.
STEP, RUN = 1024, 32

LISTS = [*FILTERS, "good", "toxic"]
POSTINGS = "part string, first_id {0}, last_id {0}, documents long, " + ", ".join(
    f"{name} array<int>" for name in LISTS
)
SIZES = (
    "part string, before int, filter int, documents long, failing long, removed long, "
    "kept long, good_lost long, toxic_lost long"
)


def failing(docs: DataFrame) -> DataFrame:
    """Each document's failed filters: doc_id, part and ``fails``, a bit a filter, A first."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    # Grouped by the hash as text and joined by it in bytes: the join gets a shuffle of
    # its own, in which a text stated very often can be split.
    copies = (
        rows.groupBy(F.md5("text").alias("content"))
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where(F.col("first") < F.col("last"))
        .select(F.unhex("content").alias("content"), "first")
    )
    words = F.array_remove(F.split("text", WHITE, -1), "")
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]", ""))
    measured = rows.select(
        "doc_id",
        "part",
        F.unhex(F.md5("text")).alias("content"),
        F.length("text").alias("points"),
        capitals.alias("capitals"),
        F.col("text").rlike(MARKS).alias("marked"),
        words.alias("words"),
    ).select(
        "doc_id",
        "part",
        "content",
        _bits(
            F.size("words") < 100,
            100 * F.size(F.array_distinct("words")) < 80 * F.size("words"),
            100 * F.col("capitals").cast("long") > 10 * F.col("points").cast("long"),
            F.col("marked"),
        ).alias("own"),
    )
    copied = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * 16
    return measured.join(copies, "content", "left").select(
        "doc_id", "part", (F.col("own") + copied).alias("fails")
    )


def _bits(*conditions: F.Column) -> F.Column:
    bits = [c.cast("int") * (1 << i) for i, c in enumerate(conditions)]
    return sum(bits[1:], bits[0])


def posting_lists(
    docs: DataFrame, labels: DataFrame, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Sorted lists of the documents of each part and range of ids that fail or are labelled.

    Returns part, first_id, last_id, documents (their number) and, for each filter,
    good and toxic, the list of their places in the range. Documents lie in ranges
    as they lie in partitions, sorted by part and id: a busy part or id spreads.
    """
    prepare(docs.sparkSession)
    known = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    rows = failing(docs).join(known, "doc_id", "left")
    rows = rows.select(
        "part", "doc_id", "fails", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    ).sortWithinPartitions("part", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _ranges(batches, range_rows):
            fails = rows.column("fails").to_numpy()
            marks = [fails & (1 << i) for i in range(len(FILTERS))]
            marks += [rows.column(c).to_numpy() for c in ("good", "toxic")]
            lists = {
                name: pa.array([np.flatnonzero(mark).astype(np.int32)])
                for name, mark in zip(LISTS, marks)
            }
            ids = rows.column("doc_id")
            yield pa.record_batch(
                {
                    "part": rows.column("part").slice(0, 1).combine_chunks(),
                    "first_id": ids.slice(0, 1).combine_chunks(),
                    "last_id": ids.slice(len(ids) - 1).combine_chunks(),
                    "documents": pa.array([len(ids)]),
                    **lists,
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, POSTINGS.format(kind))


def _ranges(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows of one part after another, in ranges of a bounded size."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        parts = batch.column("part")
        start = 0
        while start < len(parts):
            if held and held[0].column("part")[0] != parts[start]:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            # Sorted by part: all rows after the last of this part are of others.
            same = pa.compute.equal(parts.slice(start), parts[start])
            run = min(same.true_count, limit - size)
            held.append(batch.slice(start, run))
            size, start = size + run, start + run
            if size == limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def gallop(ids: np.ndarray, start: int, bound: int) -> int:
    """First place at or after ``start`` whose id is ``bound`` or more."""
    reach, low = 1, start
    while low + reach <= len(ids) and ids[low + reach - 1] < bound:
        low, reach = low + reach, reach * 2
    return low + int(np.searchsorted(ids[low : low + reach], bound))


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Ids of any of the sorted lists, sorted, by a galloping k-way merge."""
    lists = [ids for ids in lists if len(ids)]
    at = [0] * len(lists)
    found: list[np.ndarray] = []
    while lists:
        heads = [int(ids[i]) for ids, i in zip(lists, at)]
        lead = heads.index(min(heads))
        if len(lists) == 1:
            found.append(lists[0][at[0] :])
            break
        following = min(heads[:lead] + heads[lead + 1 :])
        end = gallop(lists[lead], at[lead], following)
        if end - at[lead] >= RUN:
            found.append(lists[lead][at[lead] : end])
            at[lead] = end
        else:
            bound = int(lists[lead][min(at[lead] + STEP, len(lists[lead])) - 1]) + 1
            ends = [gallop(ids, i, bound) for ids, i in zip(lists, at)]
            pieces = [ids[i:j] for ids, i, j in zip(lists, at, ends)]
            found.append(np.unique(np.concatenate(pieces)))
            at = ends
        left = [n for n, ids in enumerate(lists) if at[n] < len(ids)]
        lists, at = [lists[n] for n in left], [at[n] for n in left]
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def difference(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Ids of the first sorted list that the second lacks, by a galloping merge."""
    i = j = 0
    found: list[np.ndarray] = [ids[:0]]
    while i < len(ids):
        j = gallop(others, j, int(ids[i]))
        if j == len(others):
            found.append(ids[i:])
            break
        end = gallop(ids, i, int(others[j]))
        if end - i >= RUN:
            found.append(ids[i:end])
            i = end
            continue
        stop = min(i + STEP, len(ids))
        last = gallop(others, j, int(ids[stop - 1]) + 1)
        piece, held = ids[i:stop], others[j:last]
        if len(held):
            place = np.minimum(np.searchsorted(held, piece), len(held) - 1)
            piece = piece[held[place] != piece]
        found.append(piece)
        i, j = stop, last
    return np.concatenate(found)


def _shared(ids: np.ndarray, others: np.ndarray) -> int:
    """How many ids both sorted lists have."""
    return len(ids) - len(difference(ids, others))


def interactions(postings: DataFrame) -> DataFrame:
    """Sizes for each part, filter and set of filters applied before it.

    ``before`` has a bit for each filter of the set. Returns part, before, filter
    (its number), documents, failing, removed (failing, not removed before), kept
    (after the filter), good_lost and toxic_lost (removed and so labelled).
    """
    sets = range(1 << len(FILTERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                lists = [
                    batch.column(name)[row].values.to_numpy(zero_copy_only=False)
                    for name in LISTS
                ]
                own, good, toxic = lists[:-2], lists[-2], lists[-1]
                documents = batch.column("documents")[row].as_py()
                joint = [
                    union([ids for i, ids in enumerate(own) if chosen >> i & 1])
                    for chosen in sets
                ]
                made = []
                for i, ids in enumerate(own):
                    for before in sets:
                        if before >> i & 1:
                            continue
                        lost = difference(ids, joint[before])
                        kept = documents - len(joint[before | 1 << i])
                        labelled = _shared(lost, good), _shared(lost, toxic)
                        made.append((before, i, documents, len(ids), len(lost), kept, *labelled))
                columns = [pa.array(c, pa.int64()) for c in zip(*made)]
                names = ["documents", "failing", "removed", "kept", "good_lost", "toxic_lost"]
                yield pa.record_batch(
                    {
                        "part": pa.array([batch.column("part")[row].as_py()] * len(made)),
                        "before": columns[0].cast(pa.int32()),
                        "filter": columns[1].cast(pa.int32()),
                        **dict(zip(names, columns[2:])),
                    }
                )

    sizes = postings.mapInArrow(run, SIZES)
    return sizes.groupBy("part", "before", "filter").agg(
        *[
            F.sum(c).alias(c)
            for c in ("documents", "failing", "removed", "kept", "good_lost", "toxic_lost")
        ]
    )


def audit(docs: DataFrame, labels: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each part's filters in every order.

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic. Returns
    part, filter_order, step (from 1), kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley (removed by the filter, summed over all orders).
    """
    spark = docs.sparkSession
    sizes = interactions(posting_lists(docs, labels, range_rows))
    count = len(FILTERS)
    # In so many orders exactly a set of some size stands before a filter.
    orders = F.element_at(
        F.array(*[F.lit(factorial(n) * factorial(count - 1 - n)) for n in range(count)]),
        F.bit_count("before") + 1,
    )
    alone = F.bit_count("before") == count - 1
    # A filter has 16 sets that can stand before it.
    own = Window.partitionBy("part", "filter")
    rows = sizes.withColumns(
        {
            "unique_fails": F.sum(F.when(alone, F.col("removed")).otherwise(0)).over(own),
            "shapley": F.sum(F.col("removed") * orders).over(own).cast("long"),
        }
    )
    steps = spark.createDataFrame(
        [
            (order, step + 1, _set_of(order[:step]), FILTERS.index(order[step]))
            for order in map("".join, permutations(FILTERS))
            for step in range(count)
        ],
        "filter_order string, step int, before int, filter int",
    )
    return rows.join(steps, ["before", "filter"]).select(
        "part",
        "filter_order",
        "step",
        "kept",
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )


def _set_of(names: str) -> int:
    return sum(1 << FILTERS.index(name) for name in names)
