"""Removal of byte strings that an earlier document holds, by sorted suffixes.

Every string of ``width`` bytes has an anchor: of the short grams it holds, the one
of least hash. Equal strings have theirs at the same place, so comparing suffixes
at anchors finds what comparing all suffixes would, at a fraction of them. Anchors
whose gram no other document holds are dropped first, by packed hashes.

The rest is a distributed merge sort of strings. Each chunk sorts its distinct
contexts (the suffix at the anchor, then what stands before it, backwards, as far
as the anchor's strings reach), front-codes the sorted run and sends each range of
it to the task that merges that range. There a loser tree merges the runs: it
orders two strings by what they share with the last one written, known from the
coding, and reads characters only where that ties, never before the known prefix.
The merged order and its common prefixes give, for every place of an anchor in a
string, the groups of equal strings; a string whose group has an earlier document
is told back to its chunk. A chunk sends a context once, with its least document,
however many of its documents hold it.

Strings may overlap and are judged on the input. Earlier means a smaller doc_id.

Cases: a null or empty text, or one shorter than the width, keeps its bytes; a null
id is smaller than all others; documents of equal id are none earlier than the
other; rows may repeat; tables may be empty; other columns are left behind. What is
kept is bytes, as a cut may part a character.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import (
    BUCKET_HASHES,
    PACKED,
    answers,
    as_stated,
    bits_for,
    chunked,
    flags_of,
    packed,
    per_chunk,
    text_bytes,
    with_answers,
)
from tidemark.llm.common import (
    U64,
    Rolling,
    joined,
    keyed,
    mixed,
    owner_of,
    per_text,
    prepare,
    repeated,
    sliding_min,
    strings,
    utf8,
)

WIDTH = 50
GRAM = 24
#: Bytes of text in a chunk, about.
CHUNK_BYTES = 1 << 20
#: Bytes whose grams are hashed at a time, or one document; a task holds about a
#: hundred times as much.
PART_BYTES = 1 << 18
#: Bytes of text whose contexts make one range of the sort, about.
RANGE_BYTES = 4 << 20
#: Bytes of text that the ranges' bounds are taken from, about; rows drawn one by one.
SAMPLE_BYTES = 4 << 20
#: Contexts that reach the driver at most, whatever the rows drawn hold.
HEADS = 1 << 16
SEED = 11
#: Bytes of a range's bound; fewer than a gram, so that equal grams meet.
BOUND = 16

RUNS = "chunk long, part long, body binary"
REPLIES = "chunk long, kind int, bucket long, flags binary"
RESULT = (
    "doc_id long, kept binary, n_bytes long, n_removed long, "
    "removed array<struct<start: int, stop: int>>"
)
#: Positions in a chunk take so many bits beside a gram's hash.
PLACE_BITS = 31
NONE = 255
FIRST_ID = np.iinfo(np.int64).min


class Anchors:
    """Anchors of a table of documents, and the strings each stands for."""

    def __init__(self, docs: pa.Table, width: int, gram: int) -> None:
        self.width, self.gram, self.reach = width, gram, width - gram
        self.data, self.offsets = utf8(docs.column("text"))
        ids = docs.column("doc_id").combine_chunks() if len(docs) else docs.column("doc_id")
        self.ids = ids.fill_null(int(FIRST_ID)).to_numpy()
        found = [self._part(a, b) for a, b in self._parts()] or [self._part(0, 0)]
        self.place, self.low, self.high, self.doc, self.grams = map(np.concatenate, zip(*found))
        self._distinct()

    def _parts(self) -> Iterator[tuple[int, int]]:
        """Ranges of documents that are worked on together."""
        start, count = 0, len(self.offsets) - 1
        while start < count:
            limit = self.offsets[start] + PART_BYTES
            stop = int(np.searchsorted(self.offsets, limit, side="right")) - 1
            stop = min(max(stop, start + 1), count)
            yield start, stop
            start = stop

    def _part(self, first: int, last: int) -> tuple[np.ndarray, ...]:
        """Anchors of a range of documents: places, first and last strings, ids, grams."""
        offsets, width = self.offsets[first : last + 1], self.width
        begin = int(offsets[0])
        data = self.data[begin : int(offsets[-1])]
        grams = Rolling(data).windows(self.gram)
        mask = U64((1 << PLACE_BITS) - 1)
        least = sliding_min((grams & ~mask) | np.arange(len(grams), dtype=U64), self.reach + 1)
        owner = owner_of(offsets)
        n = max(len(data) - width + 1, 0)
        start = np.flatnonzero(owner[:n] == owner[width - 1 : width - 1 + n])
        place = (least[start] & mask).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = place[1:] != place[:-1]
        heads = np.flatnonzero(new)
        low = start[heads]
        high = start[np.append(heads[1:], len(start)) - 1] if len(heads) else start
        place = place[heads]
        ids = self.ids[first:last][owner[place]]
        # Anchors are grams of small hashes: mixed again, they spread over all buckets.
        return place + begin, low + begin, high + begin, ids, mixed(grams[place])

    def _distinct(self) -> None:
        """Sorted distinct grams, each anchor's, and those that two ids here hold."""
        order = np.argsort(self.grams, kind="stable")
        arranged = self.grams[order]
        new = np.ones(len(order), bool)
        new[1:] = arranged[1:] != arranged[:-1]
        heads = np.flatnonzero(new)
        self.values = arranged[new]
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        doc = self.doc[order]
        # Documents are in the order of their ids, so a group's are as well.
        lasts = np.append(heads[1:], len(order)) - 1 if len(heads) else heads
        self.shared = doc[heads] != doc[lasts]


class Contexts:
    """Distinct contexts of the anchors that another document may share, sorted.

    A row is the suffix, what stands before the anchor backwards, both filled up
    with zeros, and the sizes of the second and the first.
    """

    def __init__(self, held: Anchors, elsewhere: np.ndarray) -> None:
        self.held = held
        chosen = (held.shared | elsewhere)[held.group] if len(held.group) else np.zeros(0, bool)
        self.at = np.flatnonzero(chosen)
        place, width, reach = held.place[self.at], held.width, held.reach
        after = held.high[self.at] + width - place
        before = place - held.low[self.at]
        rows = np.zeros((len(self.at), width + reach + 2), np.uint8)
        top = max(len(held.data) - 1, 0)
        ahead, behind = np.arange(width), np.arange(reach)
        if len(self.at):
            got = held.data[np.minimum(place[:, None] + ahead, top)]
            rows[:, :width] = np.where(ahead < after[:, None], got, 0)
            got = held.data[np.maximum(place[:, None] - 1 - behind, 0)]
            rows[:, width:-2] = np.where(behind < before[:, None], got, 0)
        rows[:, -2], rows[:, -1] = before, after
        names = rows.view(f"S{rows.shape[1]}")[:, 0] if len(rows) else np.zeros(0, "S1")
        order = np.argsort(names, kind="stable")
        arranged = names[order]
        new = np.ones(len(order), bool)
        new[1:] = arranged[1:] != arranged[:-1]
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.rows = rows[order][new]
        # The first of equal contexts is of the least id, as documents are in order.
        self.least = held.doc[self.at][order][new]

    def parts(self, bounds: np.ndarray) -> np.ndarray:
        """Range of each context."""
        if not len(self.rows):
            return np.zeros(0, np.int64)
        heads = np.ascontiguousarray(self.rows[:, :BOUND]).view(f"S{BOUND}")[:, 0]
        return np.searchsorted(bounds, heads, side="right")

    def removed(self, verdicts: np.ndarray) -> np.ndarray:
        """Marks the bytes that strings of earlier documents cover.

        ``verdicts`` has, for each context, the least and greatest place of the
        anchor in a string that a document before the context's first one holds.
        """
        held = self.held
        steps = np.zeros(len(held.data) + 1, np.int64)
        if len(self.at):
            place, low, high = (x[self.at] for x in (held.place, held.low, held.high))
            later = held.doc[self.at] > self.least[self.entry]
            least, most = verdicts[self.entry].T.astype(np.int64)
            told = later | (least != NONE)
            begin = np.where(later, low, place - most)[told]
            end = np.where(later, high, place - least)[told] + held.width
            np.add.at(steps, begin, 1)
            np.add.at(steps, end, -1)
        return np.cumsum(steps[:-1]) > 0


def shared_prefixes(rows: np.ndarray) -> np.ndarray:
    """Characters each row has in common with the row before it."""
    found = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        found[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return found


def front_coded(rows: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """A sorted run as common prefixes, sizes, ids and what each row adds."""
    common = shared_prefixes(rows)
    columns = np.arange(rows.shape[1] - 2)
    before, after = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    told = columns >= common[:, None]
    told &= np.where(columns < width, columns < after[:, None], columns - width < before[:, None])
    body = (
        np.array([len(rows)], "<i8").tobytes()
        + common.astype(np.uint8).tobytes()
        + rows[:, -2].tobytes()
        + rows[:, -1].tobytes()
        + ids.astype("<i8").tobytes()
        + rows[:, :-2][told].tobytes()
    )
    return zstandard.ZstdCompressor(level=1).compress(body)


def run_size(body: bytes) -> int:
    """Rows of a front-coded run, of which only the beginning is read."""
    with zstandard.ZstdDecompressor().stream_reader(body) as reader:
        return int(np.frombuffer(reader.read(8), "<i8")[0])


def decoded(body: bytes, width: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, common prefixes (a byte each) and ids of a front-coded run."""
    body = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(body, "<i8", 1)[0])
    common, before, after = np.frombuffer(body, np.uint8, 3 * n, 8).reshape(3, n)
    ids = np.frombuffer(body, "<i8", n, 8 + 3 * n)
    rest = np.frombuffer(body, np.uint8, -1, 8 + 11 * n)
    rows = np.zeros((n, width + reach + 2), np.uint8)
    columns = np.arange(width + reach)
    own = columns >= common[:, None]
    told = own & np.where(
        columns < width, columns < after[:, None], columns - width < before[:, None]
    )
    plain = np.zeros((n, width + reach), np.uint8)
    plain[told] = rest
    # A column's character is that of the last row that did not share it.
    last = np.maximum.accumulate(np.where(own, np.arange(n)[:, None], 0), axis=0)
    rows[:, :-2] = np.take_along_axis(plain, last, axis=0)
    rows[:, -2], rows[:, -1] = before, after
    return rows, common, ids


def merged(rows: np.ndarray, sizes: np.ndarray, shared: np.ndarray) -> tuple[array, array]:
    """Merge sorted runs: the run each output row comes from, and common prefixes.

    ``rows`` has all runs one after another, of so many rows each, and ``shared`` each
    row's common prefix with the one before it in its run. Only the head of a run is
    held as a string of its own.

    A loser tree. Every contender carries what it shares with the row last written;
    the one that shares more comes first, and only a tie is settled by characters,
    from the shared prefix on.
    """
    count = len(sizes)
    size = 1
    while size < count:
        size *= 2
    length = rows.shape[1]
    data, common = memoryview(rows.reshape(-1)), shared.tobytes()
    ends = np.cumsum(sizes).tolist() + [0] * (size - count)
    at = (np.cumsum(sizes) - sizes).tolist() + [0] * (size - count)
    head: list[bytes | None] = [
        bytes(data[a * length : (a + 1) * length]) if a < b else None for a, b in zip(at, ends)
    ]
    share = [0 if x is not None else -1 for x in head]
    losers = [0] * size

    def first_of(left: int, right: int) -> tuple[int, int]:
        """The smaller contender and the other, which then shares more with it."""
        a, b = share[left], share[right]
        if a != b:
            return (left, right) if a > b else (right, left)
        if a < 0:
            return left, right
        x, y = head[left], head[right]
        x, y = x[a:], y[a:]
        if x == y:
            share[right] = a + len(x)
            return left, right
        differ = int.from_bytes(x) ^ int.from_bytes(y)
        both = a + len(x) - (differ.bit_length() + 7) // 8
        if x < y:
            share[right] = both
            return left, right
        share[left] = both
        return right, left

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, loser = first_of(build(2 * node), build(2 * node + 1))
        losers[node] = loser
        return winner

    winner = build(1) if size > 1 else 0
    order, prefixes = array("i"), array("B")
    while head[winner] is not None:
        order.append(winner)
        prefixes.append(share[winner])
        k = at[winner] = at[winner] + 1
        if k < ends[winner]:
            head[winner] = bytes(data[k * length : (k + 1) * length])
            share[winner] = common[k]
        else:
            head[winner] = None
            share[winner] = -1
        node = (winner + size) >> 1
        while node:
            other = losers[node]
            a, b = share[winner], share[other]
            if a < b:
                losers[node], winner = winner, other
            elif a == b and a >= 0:
                winner, losers[node] = first_of(winner, other)
            node >>= 1
    return order, prefixes


def judged(
    rows: np.ndarray, common: np.ndarray, ids: np.ndarray, width: int, reach: int
) -> np.ndarray:
    """For sorted contexts, the least and greatest place of the anchor in a string
    that a context of a smaller id holds too."""
    before, after = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    found = np.full((len(rows), 2), NONE, np.uint8)
    left = np.zeros(len(rows), U64)
    for place in range(reach + 1):
        if place:
            left = left * U64(0x9E3779B97F4A7C15) + rows[:, width + place - 1].astype(U64) + U64(1)
        group = np.cumsum(common < width - place).astype(U64)
        keys = mixed(mixed(left + U64(place)) + group)
        own = np.flatnonzero((width - after <= place) & (place <= before))
        own = own[repeated(keys[own])]
        order = own[np.argsort(keys[own], kind="stable")]
        arranged = keys[order]
        new = np.ones(len(order), bool)
        new[1:] = arranged[1:] != arranged[:-1]
        heads = np.flatnonzero(new)
        if not len(heads):
            continue
        least = np.minimum.reduceat(ids[order], heads)[np.cumsum(new) - 1]
        hit = order[ids[order] > least]
        found[hit, 1] = place
        fresh = hit[found[hit, 0] == NONE]
        found[fresh, 0] = place
    return found


def merge_ranges(runs: DataFrame, width: int, reach: int) -> DataFrame:
    """Merge the runs of each range and tell every run its verdicts."""

    def run(table: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(table, sort_keys=[("chunk", "ascending")])
        table = table.take(order)
        bodies = [x.as_buffer() for x in table.column("body")]
        sizes = np.array([run_size(body) for body in bodies])
        begin = np.cumsum(sizes) - sizes
        rows = np.empty((int(sizes.sum()), width + reach + 2), np.uint8)
        shared, ids = np.empty(len(rows), np.uint8), np.empty(len(rows), np.int64)
        for a, n, body in zip(begin.tolist(), sizes.tolist(), bodies):
            rows[a : a + n], shared[a : a + n], ids[a : a + n] = decoded(body, width, reach)
        from_run, common = merged(rows, sizes, shared)
        # Rows of a run come out in its order, and runs lie one after another.
        source = np.empty(len(from_run), np.int64)
        source[np.argsort(np.array(from_run), kind="stable")] = np.arange(len(from_run))
        del from_run
        # The sorted rows take the place of the runs.
        rows, ids = rows[source], ids[source]
        verdicts = np.empty((len(rows), 2), np.uint8)
        verdicts[source] = judged(rows, np.array(common), ids, width, reach)
        bodies = [verdicts[a : a + n].tobytes() for a, n in zip(begin, sizes)]
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "part": table.column("part"),
                "body": pa.array(bodies, pa.binary()),
            }
        )

    return runs.groupBy("part").applyInArrow(run, RUNS)


def range_bounds(docs: DataFrame, total: int, width: int, gram: int, range_bytes: int) -> np.ndarray:
    """Bounds that part the contexts evenly, from a bounded sample of documents.

    Rows are drawn whatever they hold, so copies are not drawn together. Another draw
    gives other bounds and the same results.
    """
    count = max(1, -(-total // range_bytes))
    if count == 1:
        return np.zeros(0, f"S{BOUND}")
    rows = keyed(docs).where(F.rand(SEED) < SAMPLE_BYTES / total)

    def run(batches):
        for batch in batches:
            held = Anchors(pa.Table.from_batches([batch]), width, gram)
            place = held.place[held.grams % U64(8) == U64(0)]
            text = [held.data[p : p + BOUND].tobytes() for p in place.tolist()]
            yield pa.record_batch({"head": pa.array(text, pa.binary())})

    drawn = rows.mapInArrow(run, "head binary").orderBy(F.rand(SEED)).limit(HEADS)
    heads = drawn.toArrow().column("head").to_pylist()
    heads = np.sort(np.array(heads or [b""], f"S{BOUND}"))
    return np.unique(heads[np.arange(1, count) * len(heads) // count])


def remove_earlier(
    docs: DataFrame,
    width: int = WIDTH,
    gram: int = GRAM,
    chunk_bytes: int = CHUNK_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Documents without the strings that earlier documents hold.

    Returns doc_id, kept (bytes), n_bytes, n_removed and removed (maximal intervals
    of byte offsets, end exclusive), a row for each document.
    """
    prepare(docs.sparkSession)
    if not BOUND <= gram < width < NONE - 4:
        raise ValueError("gram must be at least 16 and less than width")
    reach = width - gram
    total = text_bytes(docs)
    bits = bits_for(-(-total // 14 // BUCKET_HASHES))
    bounds = range_bounds(docs, total, width, gram, range_bytes)
    rows = chunked(docs, total, chunk_bytes)

    def send_grams(chunk: int, table: pa.Table) -> pa.Table:
        held = Anchors(table, width, gram)
        return packed(chunk, held.values, np.zeros(len(held.values), U64), bits, np.uint32)

    def contexts(table: pa.Table, reply: pa.Table) -> Contexts:
        held = Anchors(table, width, gram)
        return Contexts(held, flags_of(reply, held.values, bits))

    def send_runs(chunk: int, table: pa.Table, reply: pa.Table) -> pa.Table:
        held = contexts(table, reply)
        parts = held.parts(bounds)
        names, begin = np.unique(parts, return_index=True)
        ends = np.append(begin[1:], len(parts))
        bodies = [
            front_coded(held.rows[a:b], held.least[a:b], width) for a, b in zip(begin, ends)
        ]
        return pa.table(
            {
                "chunk": pa.array(np.full(len(names), chunk, np.int64)),
                "part": pa.array(names.astype(np.int64)),
                "body": pa.array(bodies, pa.binary()),
            }
        )

    def finish(chunk: int, table: pa.Table, reply: pa.Table) -> pa.Table:
        kind = reply.column("kind").to_numpy() if len(reply) else np.zeros(0, np.int32)
        held = contexts(table, reply.filter(pa.array(kind == 0)))
        told = reply.filter(pa.array(kind == 1))
        told = told.take(pa.compute.sort_indices(told, sort_keys=[("bucket", "ascending")]))
        verdicts = b"".join(x.as_py() for x in told.column("flags"))
        gone = held.removed(np.frombuffer(verdicts, np.uint8).reshape(-1, 2))
        return _kept(table, held.held, gone)

    grams = answers(per_chunk(rows, send_grams, PACKED), np.uint32)
    runs = with_answers(rows, grams, send_runs, RUNS)
    verdicts = merge_ranges(runs, width, reach)
    replies = grams.select("chunk", F.lit(0).alias("kind"), "bucket", "flags").unionByName(
        verdicts.select(
            "chunk",
            F.lit(1).alias("kind"),
            F.col("part").alias("bucket"),
            F.col("body").alias("flags"),
        )
    )
    return as_stated(with_answers(rows, replies, finish, f"{RESULT}, stated long"))


def _kept(table: pa.Table, held: Anchors, gone: np.ndarray) -> pa.Table:
    """Result rows: what is left of each document, and the intervals removed."""
    offsets = held.offsets
    owner = owner_of(offsets)
    edge = np.ones(len(gone), bool)
    edge[1:] = owner[1:] != owner[:-1]
    last = np.append(edge[1:], True)[: len(gone)]

    def stretches(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = marks.copy()
        begin[1:] &= ~marks[:-1] | edge[1:]
        end = marks.copy()
        end[:-1] &= ~marks[1:] | last[:-1]
        return np.flatnonzero(begin), np.flatnonzero(end) + 1

    starts, ends = stretches(~gone)
    kept = joined(held.data, starts, ends, np.searchsorted(starts, offsets), space=False)
    starts, ends = stretches(gone)
    first = np.searchsorted(starts, offsets)
    base = offsets[:-1][owner_of(first)]
    spans = pa.StructArray.from_arrays(
        [
            pa.array((starts - base).astype(np.int32)),
            pa.array((ends - base).astype(np.int32)),
        ],
        ["start", "stop"],
    )
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "kept": strings(*kept, pa.binary()),
            "n_bytes": pa.array(np.diff(offsets)),
            "n_removed": pa.array(per_text(gone, offsets)),
            "removed": pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), spans),
            "stated": table.column("stated"),
        }
    )
