"""Benchmark decontamination by suffix arrays over the training words.

Every task turns its documents into shards, builds each shard's suffix array over
words and binary-searches every suffix of the benchmark in it. A suffix's matches
are one range of the array; they give the document words inside occurrences, the
longest verbatim match and where it lies. Shards never cross tasks, so documents
are not shuffled. The benchmark is searched in blocks of a bounded size, each sent
to the tasks whole; the blocks' findings are merged by document.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window
is ``width`` consecutive words of an item; an item of fewer words is one window.

Cases: a null or empty text has no words, so nothing in it is hit and an item
without words has no window; null and repeated ids are judged row by row; items of
one id are one item, null being an id of its own, last among those found; tables may be empty; other
columns are left behind by ``contamination`` and kept by ``clean_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    LOWER,
    U64,
    Rolling,
    byte_set,
    covered,
    keyed,
    matched,
    owner_of,
    per_text,
    prepare,
    runs_of,
    slices,
    utf8,
)

WIDTH = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: Bytes of benchmark text in a block; what is sent to every task is about thrice that.
BLOCK_BYTES = 32 << 20

#: The bytes that part words.
PARTING = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: A suffix array key holds three words of 21 bits; 0 ends a document.
SYMBOL_BITS = 21
PER_KEY = 3

FOUND = (
    "doc_id long, text_key long, n_words long, items array<string>, "
    "spans array<struct<start: int, stop: int>>, longest int, longest_item string, longest_at int"
)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each text's first word."""
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, first = runs_of(~PARTING[data], offsets)
    return Rolling(data).hash(starts, ends), first


def _symbols(words: np.ndarray) -> np.ndarray:
    return words % U64((1 << SYMBOL_BITS) - 1) + U64(1)


def _key(symbols: np.ndarray) -> np.ndarray:
    """Three symbols from each position on, as one number."""
    padded = np.concatenate([symbols, np.zeros(PER_KEY - 1, U64)])
    n = len(symbols)
    return (
        (padded[:n] << U64(2 * SYMBOL_BITS)) | (padded[1 : n + 1] << U64(SYMBOL_BITS)) | padded[2:]
    )


class Queries:
    """The suffixes of benchmark items that begin a window."""

    def __init__(self, names: list[str | None], column: pa.Array, width: int) -> None:
        words, first = _words(column)
        sizes = np.diff(first)
        owner = owner_of(first)
        place = np.arange(len(words)) - first[:-1][owner]
        short = sizes[owner] < width
        begins = np.flatnonzero(np.where(short, place == 0, sizes[owner] - place >= width))
        self.names = names
        self.words = words
        self.at = begins
        self.item = owner[begins]
        self.offset = place[begins]
        self.length = np.minimum(width, sizes[self.item])
        self.last = first[1:][self.item]


class SuffixArray:
    """Suffixes of a shard's documents, ordered by their first ``depth`` words.

    Words are ordered by a 21-bit hash; a match is confirmed by the 64-bit one.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, depth: int) -> None:
        counts = np.diff(first)
        # Each document is followed by a 0, so that no suffix reaches into the next.
        self.place = np.arange(len(words)) + owner_of(first)
        symbols = np.zeros(len(words) + len(counts) + PER_KEY * (depth // PER_KEY + 2), U64)
        symbols[self.place] = _symbols(words)
        self.full = np.zeros(len(symbols), U64)
        self.full[self.place] = words
        self.word = np.zeros(len(symbols), np.int64)
        self.word[self.place] = np.arange(len(words))
        self.key = _key(symbols)
        keys = self.key[self.place]
        order = np.argsort(keys, kind="stable")
        self.order = self.place[order]
        self.heads = keys[order]
        tied = np.zeros(len(order), bool)
        tied[1:] = self.heads[1:] == self.heads[:-1]
        group = np.cumsum(~tied)
        reach = PER_KEY
        while reach < depth and tied.any():
            held = tied.copy()
            held[:-1] |= tied[1:]
            at = np.flatnonzero(held)
            deeper = self.key[np.minimum(self.order[at] + reach, len(self.key) - 1)]
            inner = np.lexsort((deeper, group[at]))
            self.order[at] = self.order[at][inner]
            same = np.zeros(len(order), bool)
            deeper, groups = deeper[inner], group[at]
            same[at[1:]] = (deeper[1:] == deeper[:-1]) & (groups[1:] == groups[:-1])
            tied = same
            group = np.cumsum(~tied)
            reach += PER_KEY

    def ranges(self, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
        """The array's range of suffixes that begin with each query's window."""
        symbols = np.concatenate([_symbols(queries.words), np.zeros(PER_KEY, U64)])

        def asked(at: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Least and greatest key whose first words are the query's next ones."""
            low, high = np.zeros(len(at), U64), np.zeros(len(at), U64)
            for i in range(PER_KEY):
                shift = U64((PER_KEY - 1 - i) * SYMBOL_BITS)
                given = left > i
                value = symbols[np.minimum(at + i, len(symbols) - 1)]
                low |= np.where(given, value, U64(0)) << shift
                high |= np.where(given, value, U64((1 << SYMBOL_BITS) - 1)) << shift
            return low, high

        low, high = asked(queries.at, queries.length)
        begin = np.searchsorted(self.heads, low, "left")
        end = np.searchsorted(self.heads, high, "right")
        reach = PER_KEY
        while True:
            live = np.flatnonzero((begin < end) & (queries.length > reach))
            if not len(live):
                return begin, end
            low, high = asked(queries.at[live] + reach, queries.length[live] - reach)
            a = self._search(begin[live], end[live], low, reach, False)
            b = self._search(a, end[live], high, reach, True)
            begin[live], end[live] = a, b
            reach += PER_KEY

    def _search(
        self, low: np.ndarray, high: np.ndarray, key: np.ndarray, reach: int, after: bool
    ) -> np.ndarray:
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = np.minimum(middle, len(self.order) - 1)
            found = self.key[np.minimum(self.order[at] + reach, len(self.key) - 1)]
            less = (found <= key) if after else (found < key)
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low

    def matches(self, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
        """Query and document word of every occurrence of a window."""
        begin, end = self.ranges(queries)
        sizes = np.maximum(end - begin, 0)
        query = np.repeat(np.arange(len(sizes)), sizes)
        entry = np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        place = self.order[entry]
        exact = np.ones(len(query), bool)
        for i in range(int(queries.length.max(initial=0))):
            asked = queries.length[query] > i
            ours = self.full[np.minimum(place + i, len(self.full) - 1)]
            theirs = queries.words[np.minimum(queries.at[query] + i, len(queries.words) - 1)]
            exact &= ~asked | (ours == theirs)
        return query[exact], self.word[place[exact]]


def _lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _search(batch: pa.RecordBatch, queries: Queries) -> pa.RecordBatch:
    words, first = _words(batch.column("text"))
    n_docs, n_items = len(first) - 1, len(queries.names)
    depth = int(queries.length.max(initial=1))
    query, word = SuffixArray(words, first, depth).matches(queries)
    doc = np.searchsorted(first, word, side="right") - 1
    length = queries.length[query]

    pairs = np.unique(doc * max(n_items, 1) + queries.item[query])
    pair_doc, pair_item = pairs // max(n_items, 1), pairs % max(n_items, 1)
    names = np.array(queries.names, dtype=object)

    hit = covered(word, length, len(words))
    owner = owner_of(first)
    edge = np.ones(len(words), bool)
    edge[1:] = owner[1:] != owner[:-1]
    begin = hit & (edge | ~np.concatenate([[False], hit[:-1]])) if len(hit) else hit
    end = (
        hit & (np.concatenate([edge[1:], [True]]) | ~np.concatenate([hit[1:], [False]]))
        if len(hit)
        else hit
    )
    base = first[:-1][owner]
    spans = pa.StructArray.from_arrays(
        [
            pa.array((np.flatnonzero(begin) - base[begin]).astype(np.int32)),
            pa.array((np.flatnonzero(end) + 1 - base[end]).astype(np.int32)),
        ],
        ["start", "stop"],
    )

    # Occurrences one word apart, in document and item alike, are one longer match.
    shift = word - queries.offset[query]
    order = np.lexsort((word, shift, queries.item[query], doc))
    d, q, w, s = doc[order], query[order], word[order], shift[order]
    new = np.ones(len(order), bool)
    if len(order):
        item = queries.item[q]
        new[1:] = (
            (d[1:] != d[:-1])
            | (item[1:] != item[:-1])
            | (s[1:] != s[:-1])
            | (w[1:] != w[:-1] + 1)
        )
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(order))) - 1 + queries.length[q[heads]]
    longest = np.zeros(n_docs, np.int32)
    np.maximum.at(longest, d[heads], size.astype(np.int32))
    best = np.flatnonzero(size == longest[d[heads]])[::-1]
    which = np.full(n_docs, -1)
    which[d[heads[best]]] = heads[best]
    none = which < 0
    at = np.where(none, 0, which)
    item_of = queries.item[q[at]] if len(q) else np.zeros(n_docs, int)
    place = (w[at] - first[:-1]) if len(q) else np.zeros(n_docs, int)
    return pa.record_batch(
        {
            "doc_id": batch.column("doc_id"),
            "text_key": batch.column("text_key"),
            "n_words": pa.array(np.diff(first)),
            "items": _lists(
                pa.array(names[pair_item], pa.string()), np.bincount(pair_doc, minlength=n_docs)
            ),
            "spans": _lists(spans, per_text(begin, first)),
            "longest": pa.array(longest),
            "longest_item": pa.array(
                [None if n else names[i] for n, i in zip(none, item_of)], pa.string()
            ),
            "longest_at": pa.array(place.astype(np.int32), mask=none),
        }
    )


def _blocks(benchmark: DataFrame, width: int, block_bytes: int) -> Iterator[Queries]:
    """The benchmark's suffixes, a block of items at a time."""
    names, texts, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text")
    for name, text in rows.toLocalIterator():
        names.append(name)
        texts.append(text)
        size += len(text or "")
        if size >= block_bytes:
            yield Queries(names, pa.array(texts, pa.string()), width)
            names, texts, size = [], [], 0
    yield Queries(names, pa.array(texts, pa.string()), width)


def _n_hit(spans: str) -> F.Column:
    return F.aggregate(
        spans, F.lit(0).cast("long"), lambda total, x: total + (x["stop"] - x["start"])
    )


def _findings(docs: DataFrame, benchmark: DataFrame, width: int, block_bytes: int) -> DataFrame:
    prepare(docs.sparkSession)
    found = []
    for block in _blocks(benchmark, width, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield _search(batch, sent.value)

        found.append(keyed(docs).mapInArrow(run, FOUND))
    merged = found[0] if len(found) == 1 else _merged(found)
    return merged.select(
        "doc_id",
        "text_key",
        "n_words",
        _n_hit("spans").alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        "longest",
        "longest_item",
        "longest_at",
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """What of the benchmark each document holds, a row for each document.

    Returns doc_id, n_words, n_hit (words inside occurrences), items (ids found,
    sorted as strings), and the longest match: words, item and first word.
    """
    return _findings(docs, benchmark, width, block_bytes).drop("text_key")


def _merged(found: list[DataFrame]) -> DataFrame:
    """Findings of several blocks by document: items united, intervals merged."""
    rows = found[0].withColumn("block", F.lit(0))
    for i, more in enumerate(found[1:], 1):
        rows = rows.unionByName(more.withColumn("block", F.lit(i)))
    best = F.max_by(
        F.struct("longest", "longest_item", "longest_at"), F.struct("longest", -F.col("block"))
    )
    grouped = rows.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_set("items")).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("all"),
        best.alias("best"),
        F.sum(F.when(F.col("block") == 0, 1).otherwise(0)).alias("copies"),
    )
    empty = F.array().cast("array<struct<start: int, stop: int>>")

    def add(done: F.Column, x: F.Column) -> F.Column:
        """One more interval, behind those merged so far."""
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= x["start"])
        longer = F.struct(last["start"], F.greatest(last["stop"], x["stop"])).cast(
            "struct<start: int, stop: int>"
        )
        head = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(joins, F.concat(head, F.array(longer))).otherwise(
            F.concat(done, F.array(x))
        )

    # Rows stated twice come out twice again.
    return grouped.select(
        "doc_id",
        "text_key",
        "n_words",
        "items",
        F.aggregate("all", empty, add).alias("spans"),
        "best.*",
        F.explode(F.sequence(F.lit(1), F.col("copies"))),
    )


def contaminated() -> F.Column:
    """Whether enough of a document's words are hit."""
    return (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents, all columns, that are not contaminated."""
    found = _findings(docs, benchmark, width, block_bytes).where(contaminated())
    rows, names = matched(docs, found.select("doc_id", "text_key").distinct(), "left_anti")
    return rows.select(*names.values()).toDF(*docs.columns)
