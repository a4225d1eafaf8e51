"""MinHash near-duplicates, screened by odd sketches and confirmed on full sets.

A document's set is its distinct shingles of five words, lower-cased in A-Z.
Documents of equal sets are one class; everything else is done for classes.

Candidates. A set's MinHash samples, one for each of 160 hash functions, are cut
into 32 bands of 5; classes that agree in a band are in one bucket. A pair at the
bound of 85 % misses all bands with a probability of 7e-9.

Odd sketches. Each sample, with its number, flips one bit of a bitmap; the bits
two bitmaps differ in come from unequal samples alone, so their XOR's population
count tells the similarity, the better the higher it is. A pair is dropped if it
differs in more bits than a pair at the bound does but with a probability of 1e-9.
Samples are few, so many pairs somewhat under the bound pass; a second bitmap, into
which all shingles are folded, differs in no more bits than the sets in shingles,
whatever the hashes, and drops most of those for certain.

Confirmation. The shingles of both texts are counted, and intersection and union
compared with the bound.

Pairs of a bucket are not written out. First each bucket's classes meet its least
one; what is confirmed makes components. Then only classes of different components
meet, each with the nearest by sketch, and last whatever pairs of different
components the sketch lets through, so that no component that any pair would join
stays apart, and a large group of near copies costs a row for each copy.

Cases: a null or empty text or one without words has an empty set, is linked with
nothing and is its own component; one of fewer words than a shingle has its whole
sequence as one; ids may repeat, rows of one id and different texts are documents
of their own; a component's id is its smallest, null only if all are null, and a
row is kept if its id is the component's (null with null); rows equal in all get
the same result; tables may be empty; other columns are left behind by
``near_duplicates`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    LOWER,
    U64,
    Rolling,
    Scratch,
    matched,
    mixed,
    owner_of,
    per_text,
    prepare,
    slices,
    utf8,
    words_of,
)
from tidemark.llm.components import components

SHINGLE = 5
#: Least similarity of linked documents, in percent.
PERCENT = 85
BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch, and the words of 64 they take.
SKETCH_BITS = 512
SKETCH_WORDS = SKETCH_BITS // 64
#: Bits of the sketch of all shingles, and its words.
SET_BITS = 1024
SET_WORDS = SET_BITS // 64
#: Chance with which a linked pair may differ in more bits than are allowed.
MISSED = 1e-9

SIGNED = (
    "doc_id {}, text_key long, n_shingles long, class binary, bands array<long>, "
    "sketch array<long>"
)


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, sorted, and where each text's begin."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, first = words_of(data, offsets)
    words = Rolling(data).hash(starts, ends)
    rolled = Rolling(words, seed=2)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    place = np.arange(len(words)) - np.repeat(first[:-1], counts)
    whole = np.flatnonzero(place <= np.repeat(counts, counts) - shingle)
    hashes = np.concatenate(
        [rolled.windows(shingle)[whole], rolled.hash(first[short], first[short + 1])]
    )
    owner = np.concatenate([owner_of(first)[whole], short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(offsets)))


def samples_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash samples of each set; a row for each set, none of which is empty."""
    salts = mixed(np.arange(1, SAMPLES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    found = np.empty((SAMPLES, len(first) - 1), U64)
    for i, salt in enumerate(salts):
        found[i] = np.minimum.reduceat(hashes * salt, first[:-1])
    return found.T


def bands_of(samples: np.ndarray) -> np.ndarray:
    """A value for each band, its number included."""
    found = np.empty((len(samples), BANDS), U64)
    for band in range(BANDS):
        value = np.full(len(samples), (band + 1) * 0x632BE59BD9B4E01B % (1 << 64), U64)
        for row in range(ROWS):
            value = mixed(value ^ samples[:, band * ROWS + row])
        found[:, band] = value
    return found


def sketches_of(samples: np.ndarray) -> np.ndarray:
    """Odd sketch of each row of samples, in words of 64 bits."""
    numbers = mixed(np.arange(1, SAMPLES + 1, dtype=U64) + U64(0xA24BAED4963EE407))
    owner = np.repeat(np.arange(len(samples)), samples.shape[1])
    return _parities(mixed(samples ^ numbers).ravel(), owner, len(samples), SKETCH_BITS)


def set_sketches_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Odd sketch of all of each set, in words of 64 bits."""
    return _parities(hashes, owner_of(first), len(first) - 1, SET_BITS)


def _parities(values: np.ndarray, owner: np.ndarray, count: int, bits: int) -> np.ndarray:
    """Bitmaps of each owner: a bit is set if an odd number of values fall on it."""
    bit = (values % U64(bits)).astype(np.int64) + owner * bits
    flips = np.bincount(bit, minlength=count * bits) & 1
    packed = np.packbits(flips.astype(np.uint8), bitorder="little")
    return packed.view(U64).reshape(count, bits // 64)


def allowed_bits(percent: int = PERCENT) -> int:
    """Bits that sketches of linked sets differ in, but for the chance ``MISSED``.

    A sample differs with the chance of one less the similarity, and flips two bits;
    bits that are flipped an odd number of times are counted.
    """
    apart = 1 - percent / 100
    odd = np.zeros(SKETCH_BITS + 1)
    odd[0] = 1.0
    counts = np.arange(SKETCH_BITS + 1)
    chance = np.zeros(SKETCH_BITS + 1)
    for differing in range(SAMPLES + 1):
        chance += odd * comb(SAMPLES, differing) * apart**differing * (1 - apart) ** (
            SAMPLES - differing
        )
        for _ in range(2):
            more = np.append(0, (odd * (SKETCH_BITS - counts) / SKETCH_BITS)[:-1])
            odd = more + np.append((odd * counts / SKETCH_BITS)[1:], 0)
    beyond = np.cumsum(chance[::-1])[::-1]
    return int(np.flatnonzero(beyond > MISSED)[-1])


def signed_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Each document's set: its size, its class (a hash of the set), bands and sketch."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, first = shingle_sets(batch.column("text"), shingle)
            sizes = np.diff(first)
            full = np.flatnonzero(sizes)
            bands, sketches = [None] * len(sizes), [None] * len(sizes)
            classes: list[bytes | None] = [None] * len(sizes)
            if len(full):
                begins = np.append(first[full], first[-1])
                samples = samples_of(hashes, begins)
                both = np.hstack([sketches_of(samples), set_sketches_of(hashes, begins)])
                made = bands_of(samples).view(np.int64), both.view(np.int64)
                for at, band, sketch in zip(full.tolist(), *made):
                    held = hashes[first[at] : first[at + 1]].tobytes()
                    classes[at] = hashlib.blake2b(held, digest_size=16).digest()
                    bands[at], sketches[at] = band, sketch
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_key": batch.column("text_key"),
                    "n_shingles": pa.array(sizes.astype(np.int64)),
                    "class": pa.array(classes, pa.binary()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                    "sketch": pa.array(sketches, pa.list_(pa.int64())),
                }
            )

    return rows.mapInArrow(run, SIGNED.format(docs.schema["doc_id"].dataType.simpleString()))


def _apart(words: range) -> Column:
    """Bits in which the sketches of a and b differ, in the words of that number."""
    each = [F.bit_count(F.col(f"_a{i}").bitwiseXOR(F.col(f"_b{i}"))) for i in words]
    return sum(each[1:], each[0])


def _may_be_linked(percent: int) -> Column:
    """Whether sketches of a and b allow a link.

    Linked sets of together S shingles differ in at most (100 - percent) * S /
    (100 + percent), and a sketch of all shingles in no more bits than that.
    """
    samples = _apart(range(SKETCH_WORDS)) <= allowed_bits(percent)
    shingles = _apart(range(SKETCH_WORDS, SKETCH_WORDS + SET_WORDS))
    total = F.col("_an") + F.col("_bn")
    return samples & ((100 + percent) * shingles <= (100 - percent) * total)


def _sketched(classes: DataFrame, name: str) -> DataFrame:
    """Classes named a or b, with sizes and the words of their sketches as columns."""
    words = [
        F.get("sketch", F.lit(i)).alias(f"_{name}{i}") for i in range(SKETCH_WORDS + SET_WORDS)
    ]
    size = F.col("n_shingles").alias(f"_{name}n")
    bands = F.col("bands").alias(f"_{name}bands")
    return classes.select(F.col("class").alias(name), size, bands, *words)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Pairs (a, b) whose sets are as similar as the bound asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text_a"):
                a, first_a = shingle_sets(batch.column("text_a"), shingle)
                b, first_b = shingle_sets(batch.column("text_b"), shingle)
                hashes = np.concatenate([a, b])
                pair = np.concatenate([owner_of(first_a), owner_of(first_b)])
                order = np.lexsort((hashes, pair))
                hashes, pair = hashes[order], pair[order]
                twice = np.zeros(len(hashes), bool)
                twice[1:] = (hashes[1:] == hashes[:-1]) & (pair[1:] == pair[:-1])
                both = per_text(twice, np.searchsorted(pair, np.arange(len(batch) + 1)))
                either = np.diff(first_a) + np.diff(first_b) - both
                linked = pa.array(100 * both >= percent * either)
                yield batch.select(["a", "b"]).filter(linked)

    ends = {x: texts.select(F.col("class").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab"}
    rows = pairs.join(ends["a"], "a").join(ends["b"], "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(run, "a binary, b binary")


def _texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One text of each class: class and text."""
    names = [F.coalesce(F.col("doc_id"), F.lit(0)), F.col("doc_id").isNull()]
    wanted = classes.select(
        F.col("source.doc_id").alias("doc_id"), F.col("source.text_key").alias("_key"), "class"
    )
    wanted = wanted.select(names[0].alias("_id"), names[1].alias("_none"), "_key", "class")
    rows = docs.select(
        names[0].alias("_id"), names[1].alias("_none"), F.xxhash64("text").alias("_key"), "text"
    )
    once = rows.join(wanted, ["_id", "_none", "_key"]).groupBy("_id", "_none", "_key")
    return once.agg(F.first("class").alias("class"), F.first("text").alias("text")).select(
        "class", "text"
    )


def links(
    docs: DataFrame,
    classes: DataFrame,
    work: Scratch,
    percent: int = PERCENT,
    shingle: int = SHINGLE,
) -> DataFrame:
    """Links (a, b) that hold together all classes that similar pairs hold together.

    ``classes`` has class, n_shingles, bands, sketch and source (doc_id and text_key of
    a member).
    """
    rows = classes.select("class", F.posexplode("bands").alias("place", "band"))
    shared = rows.groupBy("band").agg(F.min("class").alias("least"), F.max("class").alias("last"))
    shared = shared.where(F.col("least") != F.col("last")).select("band", "least")
    members = work.stored(rows.join(shared, "band"), "members")
    # No more texts than there are classes in buckets, read for all rounds at once.
    held = classes.join(members.select("class").distinct(), "class", "left_semi")
    texts = work.stored(_texts(docs, held), "texts")

    def screened(pairs: DataFrame) -> DataFrame:
        wide = pairs.join(_sketched(classes, "a"), "a").join(_sketched(classes, "b"), "b")
        return wide.where(_may_be_linked(percent)).select("a", "b")

    stars = members.where(F.col("class") != F.col("least"))
    stars = stars.select(F.col("least").alias("a"), F.col("class").alias("b")).distinct()
    tried = work.stored(screened(stars), "pairs")
    found = work.stored(confirmed(tried, texts, percent, shingle), "links")
    for nearest in (True, False):
        apart = _between(members, classes, components(found, work.stored), percent)
        if nearest:
            best = F.min(F.struct("bits", "b")).alias("best")
            apart = apart.groupBy("a").agg(best).select("a", F.col("best.b").alias("b"))
        pairs = apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        new = work.stored(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        more = work.stored(confirmed(new, texts, percent, shingle), "links")
        tried, found = tried.union(new), found.union(more)
    return found


def _between(
    members: DataFrame, classes: DataFrame, roots: DataFrame, percent: int
) -> DataFrame:
    """Pairs of one bucket and different components that sketches let through, both ways.

    Returns a, b and the bits they differ in, once for each way, at the first band
    they agree in. Buckets within one component have none and are left out before
    classes meet.
    """
    rooted = members.join(
        roots.select(F.col("vertex").alias("class"), "root"), "class", "left"
    ).select("band", "place", "class", F.coalesce("root", "class").alias("root"))
    mixed_bands = rooted.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    mixed_bands = mixed_bands.where(F.col("x") != F.col("y")).select("band")
    rows = rooted.join(mixed_bands, "band")
    ends = [
        rows.select(
            "band",
            F.col("class").alias(x),
            F.col("root").alias(f"root_{x}"),
            F.col("place").alias(f"place_{x}"),
        ).join(_sketched(classes, x), x)
        for x in "ab"
    ]
    earlier = [F.slice(f"_{x}bands", 1, F.col(f"place_{x}")) for x in "ab"]
    met = ends[0].join(ends[1], "band").where(
        (F.col("root_a") != F.col("root_b"))
        & _may_be_linked(percent)
        & ~F.arrays_overlap(*earlier)
    )
    return met.select("a", "b", _apart(range(SKETCH_WORDS)).alias("bits"))


def _classes(docs: DataFrame, percent: int, shingle: int, work: Scratch) -> DataFrame:
    """Documents with their sets' sizes, classes, the class's component and its id."""
    signed = work.stored(signed_sets(docs, shingle), "signed")
    member = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    classes = work.stored(
        signed.where(F.col("n_shingles") > 0)
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(member).alias("source"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    roots = components(links(docs, classes, work, percent, shingle), work.stored)
    labelled = classes.join(roots, F.col("class") == F.col("vertex"), "left").select(
        "class", "least", F.coalesce("root", "class").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("least").alias("smallest"))
    named = labelled.join(smallest, "root").select("class", "root", "smallest")
    rows = signed.select("doc_id", "text_key", "n_shingles", "class").join(named, "class", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "text_key", "n_shingles", "root", own.alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Each document with the size of its set and its component.

    Returns doc_id, text_key, n_shingles and component_id, the smallest doc_id
    reachable over links.
    """
    work = Scratch(prepare(docs.sparkSession), "minhash")
    found = _classes(docs, percent, shingle, work)
    return work.result(found.drop("root"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One document, all columns, of each component: that of smallest id, null last.

    Of several with that id the one of least text hash stays, and of rows equal in
    both, one. Documents without words all stay.
    """
    work = Scratch(prepare(docs.sparkSession), "minhash")
    found = _classes(docs, percent, shingle, work)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    chosen = found.where("root is not null").groupBy("root").agg(F.min(key).alias("key"))
    empty = found.where("root is null").select("doc_id", "text_key").distinct()
    kept = work.result(chosen.select("key.doc_id", "key.text_key").union(empty))
    rows, names = matched(docs, kept, "left_semi")
    wordless = rows.where(~_worded(names["text"]))
    once = rows.where(_worded(names["text"])).dropDuplicates([names["doc_id"], "_text_key"])
    return once.union(wordless).select(*names.values()).toDF(*docs.columns)


def _worded(text: str) -> Column:
    """Whether a text has a word."""
    return F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
