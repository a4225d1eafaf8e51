"""SimHash near-duplicates by pivot distance tables.

Distinct fingerprints are put into buckets that any two near ones share: the bits
are cut into more blocks than may differ, and a bucket is one choice of equal
blocks. Within a bucket, every fingerprint's Hamming distances to many reference
fingerprints are tabled; by the triangle inequality two fingerprints whose
distances to any reference differ by more than the bound are no pair, and only
those that no reference tells apart are compared. A bucket reports the links of a
spanning forest, not its pairs.

A bucket of more fingerprints than a task should compare is handled without
comparing: each of its fingerprints is sent to all values one bit away and to its
own, and two are within two bits if and only if they meet at one. At most 65 can
meet there, so these groups are small whatever the bucket. Bounds above 2 are
refused.

Cases: a null or empty text, or one without words, has fingerprint zero and links
like any other; a text of fewer words than a shingle is one shingle; documents of
equal fingerprint are one class, represented by its smallest id, null only if all
are null; ids and rows may repeat, each row comes out; tables may be empty; other
columns are left behind by ``near_duplicates`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, matched, mixed, prepare, slices, stored
from tidemark.llm.components import components

SHINGLE = 3
BITS = 2
HASH_SEED = 42
#: Reference fingerprints.
PIVOTS = 24
#: Blocks a fingerprint is cut into; all but as many as bits may differ are equal.
BLOCKS = 4
#: Fingerprints of a bucket that one task compares.
COMPARED = 512

PRINTED = "doc_id long, text_key long, print long"
LINKS = "a long, b long"


def fingerprints_of(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprint of each text."""
    from xxhash import xxh64_intdigest

    hashes: list[int] = []
    counts = []
    for text in texts:
        words = (text or "").encode().lower().split()
        n = max(len(words) - shingle + 1, 1) if words else 0
        counts.append(n)
        if not n:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        lasts = ends[min(shingle, len(words)) - 1 :].tolist()
        hashes += [xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in zip(starts.tolist(), lasts)]
    first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    values = np.array(hashes, U64)
    prints = np.zeros(len(texts), U64)
    for byte in range(8):
        part = ((values >> U64(8 * byte)) & U64(255)).astype(np.uint8)
        bits = np.unpackbits(part[:, None], axis=1, bitorder="little")
        sums = np.zeros((len(values) + 1, 8), np.int64)
        np.cumsum(bits, axis=0, out=sums[1:])
        over = 2 * (sums[first[1:]] - sums[first[:-1]]) > np.diff(first)[:, None]
        packed = np.packbits(over, axis=1, bitorder="little")[:, 0]
        prints |= packed.astype(U64) << U64(8 * byte)
    return prints


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Each document's fingerprint as a signed long: doc_id, text_key, print."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = fingerprints_of(batch.column("text").to_pylist(), shingle)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_key": batch.column("text_key"),
                    "print": pa.array(prints.view(np.int64)),
                }
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, PRINTED)


def pivots() -> np.ndarray:
    """Reference fingerprints, spread by a rule."""
    return mixed(np.arange(1, PIVOTS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def linked(values: np.ndarray, bucket: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs within the bound, of equal bucket numbers.

    Buckets are compared side by side: entry i with i + 1, i + 2 and so on, as long
    as any lie in one bucket and near in distance to the first reference.
    """
    table = np.bitwise_count(values[:, None] ^ pivots()[None, :]).astype(np.int16)
    order = np.lexsort((table[:, 0], bucket))
    values, bucket, table = values[order], bucket[order], table[order]
    left, right = [], []
    live = np.arange(len(values))
    step = 1
    while True:
        live = live[live + step < len(values)]
        near = (bucket[live + step] == bucket[live]) & (
            table[live + step, 0] - table[live, 0] <= bits
        )
        live = live[near]
        if not len(live):
            break
        pair = live
        for pivot in range(1, PIVOTS):
            far = np.abs(table[pair + step, pivot] - table[pair, pivot]) > bits
            pair = pair[~far]
        pair = pair[np.bitwise_count(values[pair] ^ values[pair + step]) <= bits]
        left.append(order[pair])
        right.append(order[pair + step])
        step += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _forest(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links enough to hold together what the pairs hold together."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    kept = []
    for a, b in zip(values[left].tolist(), values[right].tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            kept.append((a, b))
    return kept


def _blocks(value: Column, blocks: int, bits: int) -> Column:
    """Buckets of a fingerprint: a number for the choice of blocks, and their bits."""
    size = 64 // blocks
    masks = []
    for chosen in combinations(range(blocks), blocks - bits):
        mask = sum(((1 << size) - 1) << (size * block) for block in chosen)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return F.array(
        *[
            F.struct(F.lit(i).alias("choice"), value.bitwiseAND(F.lit(mask)).alias("part"))
            for i, mask in enumerate(masks)
        ]
    )


def links(prints: DataFrame, bits: int = BITS, compared: int = COMPARED) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within the bound.

    ``prints`` has one column ``print``, each value once.
    """
    if not 0 <= bits <= 2:
        raise ValueError("bits must be 0, 1 or 2")
    prepare(prints.sparkSession)
    keys = prints.select("print", F.explode(_blocks(F.col("print"), BLOCKS, bits)).alias("key"))
    keys = keys.select("key.choice", "key.part", "print")
    sizes = keys.groupBy("choice", "part").agg(F.count("*").alias("size")).where("size > 1")
    held = keys.join(sizes, ["choice", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            values = members.flatten().to_numpy(zero_copy_only=False).view(U64)
            bucket = np.repeat(np.arange(len(members)), members.value_lengths())
            left, right = linked(values, bucket, bits)
            kept = _forest(values.view(np.int64), left, right)
            yield pa.record_batch(
                {
                    "a": pa.array([a for a, _ in kept], pa.int64()),
                    "b": pa.array([b for _, b in kept], pa.int64()),
                }
            )

    small = (
        held.where(F.col("size") <= compared)
        .groupBy("choice", "part")
        .agg(F.collect_list("print").alias("members"))
        .select("members")
        .mapInArrow(run, LINKS)
    )
    # Two values differ in at most two bits if and only if some value differs in at
    # most one from both; one value has 65 such neighbours, so no group is larger.
    flips = [0, *[1 << i for i in range(63)], -(1 << 63)] if bits else [0]
    reach = F.array(*[F.lit(x).cast("long") for x in flips])
    large = held.where(F.col("size") > compared).select("print").distinct()
    meeting = large.select(
        "print", F.explode(F.transform(reach, lambda x: x.bitwiseXOR(F.col("print")))).alias("at")
    )
    met = meeting.groupBy("at").agg(F.array_sort(F.collect_list("print")).alias("all"))
    centre = F.get("all", F.lit(0)) if bits == 2 else F.col("at")
    if bits == 1:
        met = met.where(F.array_contains("all", F.col("at")))
    star = met.where(F.size("all") > 1).select(centre.alias("a"), F.explode("all").alias("b"))
    return small.unionByName(star.where("a != b"))


def _classes(docs: DataFrame, shingle: int, bits: int) -> DataFrame:
    """Documents with fingerprint, class and the class's root fingerprint."""
    prints = stored(fingerprints(docs, shingle), "prints")
    classes = stored(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes.select("print"), bits))
    labelled = classes.join(roots, F.col("print") == F.col("vertex"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(labelled.join(smallest, "root").drop("least"), "print")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Each document with its fingerprint and its class.

    Returns doc_id, text_key, print (a signed long) and component_id, the smallest
    doc_id reachable over links.
    """
    found = _classes(docs, shingle, bits)
    return found.select("doc_id", "text_key", "print", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One document, all columns, of each class: that of smallest id, null last.

    Of several with that id the one of least text hash stays, and of rows equal in
    both, one.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    found = _classes(docs, shingle, bits)
    kept = found.groupBy("root").agg(F.min(key).alias("key"))
    kept = kept.select("key.doc_id", "key.text_key")
    rows, names = matched(docs, kept, "left_semi")
    once = rows.dropDuplicates([names["doc_id"], "_text_key"])
    return once.select(*names.values()).toDF(*docs.columns)
