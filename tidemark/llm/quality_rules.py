"""Rules on repetition within a document.

Rolling hashes of several n-gram lengths, in numpy over a batch of documents at a
time, find the n-grams and lines a document repeats; the rules bound the share of
its characters that lie inside them.

Cases: a null or empty text has no words, fails the rule on too few words and is
not kept; null or repeated ids and repeated rows are judged alone, row by row;
tables may be empty; other columns are left behind by ``repetition`` and kept by
``kept_documents``. A line with no word counts for nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    U64,
    Rolling,
    byte_set,
    covered,
    mixed,
    owner_of,
    per_text,
    positional,
    prepare,
    repeated,
    runs_of,
    slices,
    utf8,
    words_of,
)

#: Bytes of text measured at a time: a slice's arrays hold some 60 bytes for each, which a
#: Python worker keeps for the operators after this one.
MEASURED_BYTES = 512 << 10
MIN_WORDS = 10
BASE_LENGTH = 5
BASE_PERCENT = 20
#: Most percent of the characters of words that may lie in repeats of an n-gram of
#: so many words, first occurrences not counted.
NGRAM_PERCENT = {5: 20, 6: 19, 8: 18, 10: 16}
#: The same for lines equal to an earlier line.
LINE_PERCENT = 30
#: Most symbols to 100 words.
SYMBOL_PERCENT = 10

#: The symbols #*$%&|<>
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
NEWLINE = byte_set((0x0A, 0x0A))

MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, dup_line_chars long, "
    + ", ".join(f"dup_{n}_chars long" for n in NGRAM_PERCENT)
)


def _later(keys: np.ndarray) -> np.ndarray:
    """Marks entries equal to an earlier one."""
    found = repeated(keys)
    at = np.flatnonzero(found)
    _, firsts = np.unique(keys[at], return_index=True)
    found[at[firsts]] = False
    return found


def _measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = utf8(batch.column("text"))
    starts, ends, first = words_of(data, offsets)
    owner = owner_of(first).astype(U64)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOLS[data], out=symbols[1:])
    in_doc = Rolling(data)
    words = in_doc.hash(starts, ends)
    sequence = Rolling(words, 2)

    def keys_of(length: int) -> tuple[np.ndarray, np.ndarray]:
        last = max(len(words) - length + 1, 0)
        at = np.flatnonzero(owner[:last] == owner[length - 1 : length - 1 + last])
        return at, mixed(sequence.windows(length)[at] + owner[at] * U64(0x9FB21C651E98DF25))

    dup_chars = {}
    repeat_words = None
    for length in NGRAM_PERCENT:
        at, keys = keys_of(length)
        if length == BASE_LENGTH:
            inside = covered(at[repeated(keys)], length, len(words))
            repeat_words = per_text(inside, first)
        inside = covered(at[_later(keys)], length, len(words))
        dup_chars[length] = per_text(np.where(inside, chars, 0), first)

    line_starts, line_ends, line_first = runs_of(~NEWLINE[data], offsets)
    holds = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    lines = in_doc.hash(line_starts, line_ends)
    line_owner = owner_of(line_first).astype(U64)
    dup_line = np.zeros(len(lines), bool)
    keep = np.flatnonzero(holds)
    dup_line[keep] = _later(mixed(lines[keep] + line_owner[keep] * U64(0x9FB21C651E98DF25)))
    word_chars = np.concatenate([[0], np.cumsum(chars)])
    line_chars = (
        word_chars[np.searchsorted(starts, line_ends)]
        - word_chars[np.searchsorted(starts, line_starts)]
    )
    columns = {
        "doc_id": batch.column("doc_id"),
        "n_words": np.diff(first),
        "word_chars": per_text(chars, first),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": per_text(dup_line, line_first),
        "n_repeat_words": repeat_words,
        "dup_line_chars": per_text(np.where(dup_line, line_chars, 0), line_first),
    } | {f"dup_{n}_chars": dup_chars[n] for n in NGRAM_PERCENT}
    return pa.record_batch({name: pa.array(value) for name, value in columns.items()})


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=MEASURED_BYTES):
        yield _measure(batch)


def judged(measures: DataFrame) -> DataFrame:
    """Measures with the verdicts of the base rules and of all rules."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words")
    )
    over = 100 * F.col("dup_line_chars") > LINE_PERCENT * F.col("word_chars")
    over |= 100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words")
    for length, percent in NGRAM_PERCENT.items():
        over |= 100 * F.col(f"dup_{length}_chars") > percent * F.col("word_chars")
    return measures.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)


def repetition(docs: DataFrame) -> DataFrame:
    """Each document's measures and verdicts: ``base_failed`` and ``kept``."""
    prepare(docs.sparkSession)
    return judged(docs.select("doc_id", "text").mapInArrow(_measures, MEASURES))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents, all columns, that the rules keep."""
    prepare(docs.sparkSession)
    # Columns of any name and type pass through beside the measures.
    plain, by_name = positional(docs)
    names, text = list(by_name.values()), by_name["text"]
    number = f"{MEASURES.removeprefix('doc_id long, ')}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, MEASURED_BYTES):
            found = _measure(
                pa.record_batch({"doc_id": batch.column(by_name["doc_id"]), "text": batch.column(text)})
            )
            yield pa.RecordBatch.from_arrays(
                batch.columns + found.columns[1:], names + found.schema.names[1:]
            )

    found = judged(plain.mapInArrow(run, f"{fields}, {number}"))
    return found.where("kept").select(*names).toDF(*docs.columns)
