"""Removal of token windows that occur more than once anywhere.

Rabin-Karp hashes of every window of ``width`` words are counted over all
documents; the windows found twice or more merge into maximal intervals, whose
words are removed. Every occurrence goes, the first included.

Cases: a null or empty text, or one with fewer words than the width, has no window
and keeps its words; null ids are ids like any other; rows equal in id and text
are two documents, so all their windows repeat; tables may be empty; other columns
are left behind. Words are unchanged and joined by one space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.chunks import (
    BUCKET_HASHES,
    CHUNK_BYTES,
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
    covered,
    joined,
    owner_of,
    per_text,
    prepare,
    strings,
    utf8,
    words_of,
)

WIDTH = 35
RESULT = "doc_id long, text string, n_words long, n_removed long, removed array<struct<start: int, stop: int>>"


class _Windows:
    """Words of a chunk's documents and the distinct hashes of their windows."""

    def __init__(self, docs: pa.Table, width: int) -> None:
        self.data, self.offsets = utf8(docs.column("text"))
        self.starts, self.ends, self.first = words_of(self.data, self.offsets)
        words = Rolling(self.data).hash(self.starts, self.ends)
        self.width = width
        owner = owner_of(self.first)
        last = max(len(words) - width + 1, 0)
        self.at = np.flatnonzero(owner[:last] == owner[width - 1 : width - 1 + last])
        hashes = Rolling(words, 2).windows(width)[self.at]
        self.order = np.argsort(hashes, kind="stable")
        arranged = hashes[self.order]
        new = np.ones(len(arranged), bool)
        new[1:] = arranged[1:] != arranged[:-1]
        self.group = np.cumsum(new) - 1
        self.values = arranged[new]
        stated = docs.column("stated").to_numpy()[owner[self.at]]
        weights = stated[self.order].astype(float)
        self.twice = np.bincount(self.group, weights, minlength=len(self.values)) > 1
        firsts = self.at[self.order[new]]
        self.more = Rolling(words, 3).hash(firsts, firsts + width)

    def removed(self, elsewhere: np.ndarray) -> np.ndarray:
        """Marks the words covered by repeated windows."""
        hit = (self.twice | elsewhere)[self.group] if len(self.group) else np.zeros(0, bool)
        return covered(self.at[self.order[hit]], self.width, len(self.starts))


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Documents' kept words as text, with the word intervals removed.

    Returns doc_id, text, n_words, n_removed and removed (intervals of word numbers,
    end exclusive), a row for each document.
    """
    prepare(docs.sparkSession)
    total = text_bytes(docs)
    bits = bits_for(-(-total // 6 // BUCKET_HASHES))
    rows = chunked(docs, total, chunk_bytes)

    def send(chunk: int, table: pa.Table) -> pa.Table:
        held = _Windows(table, width)
        return packed(chunk, held.values, held.more, bits)

    def finish(chunk: int, table: pa.Table, reply: pa.Table) -> pa.Table:
        held = _Windows(table, width)
        gone = held.removed(flags_of(reply, held.values, bits))
        kept = ~gone
        counts = np.concatenate([[0], np.cumsum(kept)])
        text = joined(held.data, held.starts[kept], held.ends[kept], counts[held.first])
        owner = owner_of(held.first)
        edge = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else gone
        last = np.concatenate([edge[1:], [True]]) if len(owner) else gone
        begin = gone & (edge | ~np.concatenate([[False], gone[:-1]])) if len(gone) else gone
        end = gone & (last | ~np.concatenate([gone[1:], [False]])) if len(gone) else gone
        base = held.first[:-1][owner]
        spans = pa.StructArray.from_arrays(
            [
                pa.array((np.flatnonzero(begin) - base[begin]).astype(np.int32)),
                pa.array((np.flatnonzero(end) + 1 - base[end]).astype(np.int32)),
            ],
            ["start", "stop"],
        )
        ends = np.concatenate([[0], np.cumsum(begin)])[held.first].astype(np.int32)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "text": strings(*text),
                "n_words": pa.array(np.diff(held.first)),
                "n_removed": pa.array(per_text(gone, held.first)),
                "removed": pa.ListArray.from_arrays(pa.array(ends), spans),
                "stated": table.column("stated"),
            }
        )

    replies = answers(per_chunk(rows, send, PACKED))
    return as_stated(with_answers(rows, replies, finish, f"{RESULT}, stated long"))
