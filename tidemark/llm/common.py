"""What the corpus operators share: document keys, batches, words and hashes.

Documents are told apart by ``doc_id`` and a hash of the text, so a repeated or
null id mixes no two different texts. Rows equal in both are one document stated
twice: they count twice where copies count, and get the same result.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import apply_settings, shared_folder

#: Bytes of text worked on at a time; a longer document is worked on alone.
SLICE_BYTES = 2 << 20
#: What a Python worker gets at a time, so that its memory does not follow the rows.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

U64 = np.uint64


#: Where this package lies. Python workers look there too, so that a session started
#: elsewhere finds it; a cluster that has it at another place names that itself.
ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on."""
    apply_settings(spark)
    told = spark.sparkContext.environment
    paths = told.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        told["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, ROOT]))
    for name, value in BATCH_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return prepare(spark).read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a written table, where every executor can read it."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends here."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text and text; other columns are left behind."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def positional(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Columns named by place, whatever they were called, and each one's new name."""
    names = {name: f"_{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def matched(docs: DataFrame, found: DataFrame, how: str) -> tuple[DataFrame, dict[str, str]]:
    """Documents, all columns named by place, joined with rows keyed like documents.

    ``found`` has doc_id, text_key and columns not named by place; documents get a
    column ``_text_key``.
    """
    rows, names = positional(docs)
    rows = rows.withColumn("_text_key", F.xxhash64(names["text"]))
    same = F.col(names["doc_id"]).eqNullSafe(F.col("doc_id")) & (
        F.col("_text_key") == F.col("text_key")
    )
    return rows.join(found, same, how), names


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the column holds at most ``limit`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + limit, side="right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of which bytes lie in the ranges, both ends included."""
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


#: The bytes \x20 and \x09-\x0D part words.
WHITE = byte_set((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs_of(
    inside: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes: starts, ends, and each text's first run.

    A run ends where its text ends. The third array has one more entry than texts.
    """
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(inside)]
    begin[heads] = inside[heads]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    end[tails] = inside[tails]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def words_of(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words ``[^\\x20\\x09-\\x0D]+`` and each text's first word."""
    return runs_of(~WHITE[data], offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the information of 64-bit values over all their bits."""
    values = (values ^ (values >> U64(32))) * U64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return values ^ (values >> U64(32))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Rolling:
    """Rabin-Karp hashes, modulo 2**64, of any stretch of a sequence.

    Values are spread by ``seed`` first, so two seeds give independent hashes.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, seed: int = 1) -> None:
        n = len(values)
        self.base = (0x9E3779B97F4A7C15 + 0x632BE59BD9B4E01A * seed) % (1 << 64) | 1
        up, self.down = self._tables(n)
        salt = U64(0xA24BAED4963EE407 * seed % (1 << 64))
        if values.dtype == np.uint8:
            spread = mixed(np.arange(256, dtype=U64) + salt)[values]
        else:
            spread = mixed(values + salt)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(spread * up[:n], out=self.sums[1:])

    def _tables(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = self._powers.get(self.base, (np.ones(1, U64), np.ones(1, U64)))
        if len(up) < n + 1:
            size = max(n + 1, 1 << 16)
            up, down = np.full(size, U64(self.base)), np.full(size, U64(_inverse(self.base)))
            up[0] = down[0] = 1
            up, down = np.cumprod(up), np.cumprod(down)
            if size <= 4 * SLICE_BYTES:
                self._powers[self.base] = up, down
        return up, down

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each stretch, its length included."""
        value = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mixed(value + (ends - starts).astype(U64) * U64(0xC2B2AE3D27D4EB4F))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every stretch of one width."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, U64)
        return mixed((self.sums[width:] - self.sums[:n]) * self.down[:n])


def per_text(marks: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of an array over each text's entries, given where they begin."""
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def owner_of(first: np.ndarray) -> np.ndarray:
    """Text number of every entry, given where each text's entries begin."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def repeated(values: np.ndarray) -> np.ndarray:
    """Marks values that occur twice or more."""
    ordered = np.sort(values)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    found = np.zeros(len(values), bool)
    if len(twice):
        near = np.zeros(1 << 16, bool)
        near[twice & U64(0xFFFF)] = True
        maybe = np.flatnonzero(near[values & U64(0xFFFF)])
        at = np.searchsorted(twice, values[maybe])
        at[at == len(twice)] = 0
        found[maybe] = twice[at] == values[maybe]
    return found


def covered(starts: np.ndarray, width: int | np.ndarray, size: int) -> np.ndarray:
    """Marks entries inside any stretch of the width."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:-1]) > 0


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every stretch of the width."""
    least, reach = values, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def strings(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Texts of one buffer as an Arrow column."""
    made = pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [
            None,
            pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
            pa.py_buffer(np.ascontiguousarray(data, np.uint8)),
        ],
    )
    kind = kind or pa.string()
    return made.cast(pa.binary()) if kind == pa.binary() else made.cast(pa.binary()).view(kind)


def joined(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, space: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of each text joined by one space, or by nothing.

    ``first`` tells where each text's stretches begin; returns bytes and offsets.
    """
    sizes = ends - starts
    if space and len(starts):
        gaps = np.ones(len(starts), np.int64)
        lasts = first[1:][first[1:] > first[:-1]] - 1
        gaps[lasts] = 0
        sizes = sizes + gaps
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    source = np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)
    if space and len(starts):
        out = data[np.minimum(source, max(len(data) - 1, 0))]
        out[(at[1:] - 1)[gaps == 1]] = 32
    else:
        out = data[source]
    return out, at[first]


class Scratch:
    """Tables an operator writes on its way, in one folder that goes when it is done."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = scratch(spark, name)

    def stored(self, frame: DataFrame, name: str) -> DataFrame:
        """The rows, written here and read back: lineage ends here."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def result(self, frame: DataFrame) -> DataFrame:
        """The rows as a checkpoint; what led to them is removed."""
        kept = frame.checkpoint()
        self.remove()
        return kept

    def remove(self) -> None:
        """Delete what was written."""
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(context.hadoopConfiguration()).delete(path, True)
