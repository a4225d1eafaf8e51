"""Documents dealt into chunks that exchange what they hold in packed form.

Operators that look for repeats everywhere deal the documents, once, into chunks
of a bounded size. A chunk sends each of its distinct hashes once, in rows of one
chunk and one bucket, so a group of copies reaches a bucket at most once a chunk
however large it is. Answers come back as bits in the order sent, and the chunk,
computing its hashes anew, applies them to all its documents.

Rows equal in id and text share a chunk. Where these alone would outgrow one, they
become one row with their number before they are dealt, and as many results after.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, keyed, repeated

#: Bytes of text in a chunk, about. What a task holds is a small multiple of it.
CHUNK_BYTES = 2 << 20
#: Rows in a chunk, about, where texts are so short that bytes do not bound them.
CHUNK_ROWS = 1 << 16
#: Hashes in a bucket, about.
BUCKET_HASHES = 1 << 20

PACKED = "chunk long, bucket long, hashes binary"
ANSWERS = "chunk long, bucket long, flags binary"


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def chunked(docs: DataFrame, total: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Keyed documents with the chunk each belongs to, and how often each is stated.

    The chunk follows from id and text alone, so it is the same wherever the rows are
    read from again; rows equal in both share one. They stay rows of their own (stated
    once each), unless they alone would outgrow a chunk: no more such keys exist than
    there are chunks.
    """
    rows = keyed(docs)
    many = (F.col("rows") > 1) & (
        (F.col("rows") > CHUNK_ROWS) | (F.col("rows") * F.col("size") > chunk_bytes)
    )
    counts = rows.groupBy("doc_id", "text_key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.max(F.octet_length("text")), F.lit(0)).alias("size"),
    )
    found = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.max(many)).first()
    count = max(1, -(-total // chunk_bytes), -(-found[0] // CHUNK_ROWS))
    once = F.lit(1).cast("long").alias("stated")
    dealt = rows.select("*", once)
    if found[1]:
        names = counts.where(many).select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")
        )
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
        dealt = rows.join(F.broadcast(names), same, "left_anti").select("*", once)
        alike = rows.join(F.broadcast(names), same, "left_semi")
        dealt = dealt.unionByName(
            alike.groupBy("doc_id", "text_key").agg(
                F.first("text").alias("text"), F.count(F.lit(1)).alias("stated")
            )
        )
    return dealt.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(count)))


def as_stated(results: DataFrame) -> DataFrame:
    """Each result as often as its document is stated, in two steps for large numbers."""
    step = 1 << 16
    left = F.col("stated") - F.col("_step") * step
    return (
        results.withColumn("_step", F.explode(F.expr(f"sequence(0, (stated - 1) div {step})")))
        .withColumn("_one", F.explode(F.sequence(F.lit(1).cast("long"), F.least(left, F.lit(step)))))
        .drop("stated", "_step", "_one")
    )


def ordered(rows: pa.Table) -> pa.Table:
    """Documents of a chunk in one order, whichever way they arrived; null ids first."""
    keys = [("doc_id", "ascending"), ("text_key", "ascending")]
    order = pa.compute.sort_indices(rows, sort_keys=keys, null_placement="at_start")
    return rows.take(order).combine_chunks()


def bits_for(count: int) -> int:
    """Bits that number so many buckets."""
    return max(0, (max(1, count) - 1).bit_length())


def packed(
    chunk: int, values: np.ndarray, more: np.ndarray, bits: int, dtype: type = np.uint64
) -> pa.Table:
    """Rows of sorted distinct hashes, one for each bucket.

    The bucket is the top ``bits`` of a hash; the bits after it are sent, filled up
    from a second hash, so that a hash has 64 bits besides its bucket's (or 32).
    """
    bucket = (values >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), int)
    rest = values
    if bits:
        rest = (values << U64(bits)) | (more >> U64(64 - bits))
    if dtype is np.uint32:
        rest = rest >> U64(32)
    rest = rest.astype(dtype)
    names, begin = np.unique(bucket, return_index=True)
    ends = np.append(begin[1:], len(values))
    return pa.table(
        {
            "chunk": pa.array(np.full(len(names), chunk, np.int64)),
            "bucket": pa.array(names.astype(np.int64)),
            "hashes": pa.array([rest[a:b].tobytes() for a, b in zip(begin, ends)], pa.binary()),
        }
    )


def answers(rows: DataFrame, dtype: type = np.uint64) -> DataFrame:
    """For each hash of each chunk, whether another chunk sent it too."""

    def judge(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x.as_buffer(), dtype) for x in table.column("hashes")]
        found = repeated(np.concatenate(blobs).astype(U64))
        cuts = np.cumsum([len(x) for x in blobs])[:-1]
        flags = [np.packbits(x).tobytes() for x in np.split(found, cuts)]
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "bucket": table.column("bucket"),
                "flags": pa.array(flags, pa.binary()),
            }
        )

    return rows.groupBy("bucket").applyInArrow(judge, ANSWERS)


def flags_of(answer: pa.Table, values: np.ndarray, bits: int) -> np.ndarray:
    """Answers to a chunk's sorted distinct hashes, in their order."""
    found = np.zeros(len(values), bool)
    if not len(values):
        return found
    bucket = (values >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), int)
    names, begin = np.unique(bucket, return_index=True)
    ends = np.append(begin[1:], len(values))
    where = {int(name): (a, b) for name, a, b in zip(names, begin, ends)}
    for name, blob in zip(answer.column("bucket").to_pylist(), answer.column("flags")):
        a, b = where[name]
        found[a:b] = np.unpackbits(np.frombuffer(blob.as_buffer(), np.uint8), count=b - a)
    return found


def per_chunk(
    rows: DataFrame, work: Callable[[int, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """Apply a function to each chunk's documents."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return work(key[0].as_py(), ordered(table))

    return rows.groupBy("chunk").applyInArrow(run, schema)


def with_answers(
    rows: DataFrame,
    replies: DataFrame,
    work: Callable[[int, pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """Apply a function to each chunk's documents and what came back for it."""

    def run(key: tuple, table: pa.Table, reply: pa.Table) -> pa.Table:
        return work(key[0].as_py(), ordered(table), reply)

    return rows.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, schema)
