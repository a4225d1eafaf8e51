"""Document classes from averaged subword embeddings.

A document is the mean of learned vectors of its words, word pairs and character
n-grams, hashed into buckets; a softmax over two classes follows. The vectors are
trained by numpy stochastic gradient descent on a bounded sample of labelled
documents, in one task; the documents they are chosen from are read by all. What scoring needs of them is one number a bucket, sent to
all tasks: its size is that of the buckets, whatever the input.

Cases: a null or empty text has no features and gets the score of the bias alone;
labels that are null are not learned from, and of several for one id the mean
decides (half and more is 1); with labels of one class or none at all every text
gets the share of that class, or a half; ids and rows may repeat, each row is
scored alone; tables may be empty; other columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    U64,
    Rolling,
    mixed,
    owner_of,
    prepare,
    slices,
    utf8,
    words_of,
)

#: Labelled documents of each class that are learned from, those of least id hash.
SAMPLE_PER_CLASS = 1500
BUCKET_BITS = 18
DIMENSIONS = 8
CHARACTERS = (3, 4, 5)
#: Bytes of text learned from at most, and of one such text.
SAMPLE_BYTES = 64 << 20
LONGEST = 1 << 20
#: Steps of training, one document each, the classes in turn.
STEPS = 9000
RATE = 0.1
SEED = 7

MODEL = "weights binary, bias double"
SCORED = "doc_id long, score double"


def features(
    data: np.ndarray, offsets: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Kinds of features of texts: bucket, and the range of entries of each text."""
    shift = U64(64 - BUCKET_BITS)
    grams = np.zeros(len(data), U64)
    for length in range(1, max(CHARACTERS) + 1):
        grams = grams[: max(len(data) - length + 1, 0)] * U64(0x100000001B3)
        grams += data[length - 1 :].astype(U64) + U64(1)
        if length in CHARACTERS:
            buckets = ((grams + U64(length)) * U64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
            begin = offsets[:-1]
            yield buckets, begin, np.maximum(offsets[1:] - length + 1, begin)
    starts, ends, first = words_of(data, offsets)
    words = Rolling(data).hash(starts, ends)
    yield (words >> shift).astype(np.int64), first[:-1], first[1:]
    last = max(len(words) - 1, 0)
    pairs = mixed(words[:last] * U64(3) + words[1:])
    yield (pairs >> shift).astype(np.int64), first[:-1], np.maximum(first[1:] - 1, first[:-1])


def train(texts: list[str], classes: list[int]) -> tuple[np.ndarray, float]:
    """A weight for each bucket and the bias of class 1, from labelled texts."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output = rng.normal(0, 1, (2, DIMENSIONS)).astype(np.float32)
    bias = np.zeros(2)
    encoded = [np.frombuffer((text or "").encode(), np.uint8) for text in texts]
    members = [np.flatnonzero(np.array(classes) == label) for label in (0, 1)]
    orders = [np.resize(rng.permutation(own), STEPS // 2 + 1) for own in members]
    for step in range(STEPS):
        i = orders[step % 2][step // 2]
        rate = RATE * (1 - step / STEPS)
        data = encoded[i]
        found = [b[x[0] : y[0]] for b, x, y in features(data, np.array([0, len(data)]))]
        buckets, counts = np.unique(np.concatenate(found), return_counts=True)
        share = (counts / max(1, counts.sum())).astype(np.float32)
        mean = share @ vectors[buckets]
        logits = output @ mean + bias
        odds = np.exp(logits - logits.max())
        error = -odds / odds.sum()
        error[classes[i]] += 1
        moved = (rate * error).astype(np.float32)
        pull = moved @ output
        output += np.outer(moved, mean)
        vectors[buckets] += np.outer(share / np.sqrt(share @ share), pull)
        bias += 0.01 * moved
    return vectors @ (output[1] - output[0]), float(bias[1] - bias[0])


def score(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """Chance of class 1 of each text."""
    total = np.zeros(len(offsets) - 1)
    count = np.zeros(len(offsets) - 1, np.int64)
    for buckets, begin, end in features(data, offsets):
        sums = np.concatenate([[0.0], np.cumsum(weights[buckets], dtype=np.float64)])
        top = len(buckets)
        begin, end = np.minimum(begin, top), np.minimum(end, top)
        total += sums[end] - sums[begin]
        count += end - begin
    return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + bias)))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = SAMPLE_PER_CLASS,
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """Labelled documents to learn from, as many of each class and so many bytes at most.

    ``labels`` has doc_id and label (0 or 1). Ids are chosen by their hash, one document
    an id, none longer than ``LONGEST`` bytes; where all would be more than the bytes,
    those of least hash. Texts are read by as many tasks as the documents have; only
    what is chosen comes to one.
    """
    chosen = (
        labels.where("doc_id is not null and label is not null")
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .withColumn("place", F.xxhash64("doc_id"))
    )
    least = [
        chosen.where(F.col("label") == label).orderBy("place", "doc_id").limit(per_class)
        for label in (0, 1)
    ]
    ids = least[0].unionByName(least[1])
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = rows.where(size <= LONGEST)
    # Of an id's documents the one of least text hash: no more rows are left than ids.
    one = F.min(F.struct(F.xxhash64("text").alias("key"), "text")).alias("one")
    rows = rows.groupBy("doc_id", "label", "place").agg(one)
    rows = rows.select("doc_id", "label", "place", "one.text")
    before = Window.orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("total", F.sum(size).over(before)).where(F.col("total") <= sample_bytes)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The model as one row: weights (float32 a bucket) and bias."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        rows.sort(key=lambda row: (row["place"], row["doc_id"], row["text"] or ""))
        classes = [row["label"] for row in rows]
        if len(set(classes)) == 2:
            weights, bias = train([row["text"] for row in rows], classes)
        else:
            weights = np.zeros(1 << BUCKET_BITS)
            bias = {(0,): -20.0, (1,): 20.0}.get(tuple(set(classes)), 0.0)
        yield pa.record_batch(
            {
                "weights": pa.array([weights.astype("<f4").tobytes()], pa.binary()),
                "bias": pa.array([bias]),
            }
        )

    # The running total leaves the sample, which is bounded, in one partition; an empty
    # one has a partition as well.
    return sample(docs, labels, per_class).repartition(1).mapInArrow(run, MODEL)


def scores(docs: DataFrame, model: DataFrame) -> DataFrame:
    """Each document's chance of class 1."""
    prepare(docs.sparkSession)
    row = model.first()
    weights = np.frombuffer(row["weights"], "<f4") if row else np.zeros(1 << BUCKET_BITS)
    bias = row["bias"] if row else 0.0
    sent = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = score(*utf8(batch.column("text")), *sent.value)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(found)})

    return docs.select("doc_id", "text").mapInArrow(run, SCORED)
