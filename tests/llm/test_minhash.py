"""MinHash components against comparing all sets."""

import random

import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import DOCS, clashing, docs, lower, no_docs, prose, rows, words  # noqa: F401

from tidemark.llm.common import Scratch
from tidemark.llm.minhash_dedup import (
    _between,
    allowed_bits,
    bands_of,
    near_duplicates,
    one_of_each,
    samples_of,
    set_sketches_of,
    shingle_sets,
    sketches_of,
)


def brute_set(text):
    said = words(lower(text))
    if 0 < len(said) < 5:
        return frozenset([tuple(said)])
    return frozenset(tuple(said[i : i + 5]) for i in range(len(said) - 4))


def brute_components(held):
    sets = [brute_set(r[1]) for r in held]
    root = list(range(len(held)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, r in enumerate(held):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return [
        (r[0], len(s), least.get(top(i)) if s else r[0]) for i, (r, s) in enumerate(zip(held, sets))
    ], [top(i) if sets[i] else None for i in range(len(held))]


def told(found):
    return sorted(
        ((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr
    )


def edited(text, made, changes):
    held = text.split()
    for _ in range(changes):
        held[made.randrange(len(held))] = f"new{made.randrange(10**9)}"
    return " ".join(held)


def test_sets(rows):
    texts = [r[1] for r in rows]
    hashes, first = shingle_sets(pa.array(texts, pa.string()))
    sizes = np.diff(first).tolist()
    assert sizes == [len(brute_set(t)) for t in texts]
    held = [frozenset(hashes[a:b].tolist()) for a, b in zip(first, first[1:])]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(held[i] & held[j]) == len(brute_set(a) & brute_set(b))


def test_documents(docs, rows):
    assert told(near_duplicates(docs)) == sorted(brute_components(rows)[0], key=repr)


def test_chains_hubs_and_sets_at_the_bound(spark):
    made = random.Random(2)
    base = prose(30, 150)
    held = [(i, edited(base, made, made.randint(0, 3))) for i in range(60)]
    # A hub whose neighbours are no links of each other.
    hub = prose(31, 200)
    held += [(100 + i, edited(hub, made, 4)) for i in range(40)] + [(99, hub)]
    chain = prose(32, 300)
    for i in range(12):
        held.append((200 + i, chain))
        chain = edited(chain, made, 5)
    # 100 * 85 = 85 * 100 and just under: sets of 85 of 100 shingles and of 84.
    long = [f"w{i}" for i in range(104)]
    held += [(300, " ".join(long)), (301, " ".join(long[:89])), (302, " ".join(long[:88]))]
    held += [(None, base), (None, edited(base, made, 1)), (400, base.upper()), (400, prose(33, 9))]
    made.shuffle(held)
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in held], DOCS).repartition(4)
    expected, _ = brute_components(held)
    assert len({c for _, _, c in expected}) < len(held) - 50
    assert told(near_duplicates(frame)) == sorted(expected, key=repr)


def test_one_of_each(clashing, rows):
    _, roots = brute_components(rows)
    found = one_of_each(clashing)
    assert found.columns == clashing.columns
    got = found.collect()
    empty = sum(r is None for r in roots)
    assert len(got) == len({r for r in roots if r is not None}) + empty
    ids = [r.doc_id for r in got]
    assert ids.count(0) == 1 and 3 not in ids and ids.count(17) == 1 and {5, 6, 7} <= set(ids)


def test_no_documents(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("similarity", [85, 95])
def test_sketches_tell_similarity(similarity):
    made = np.random.default_rng(1)
    both = made.integers(0, 1 << 63, (300, similarity * 4), dtype=np.uint64)
    own = [made.integers(0, 1 << 63, (300, 200 - similarity * 2), dtype=np.uint64) for _ in "ab"]
    sketches, bands = [], []
    for mine in own:
        whole = np.concatenate([both, mine], axis=1)
        samples = samples_of(whole.ravel(), np.arange(301) * whole.shape[1])
        sketches.append(sketches_of(samples))
        bands.append(bands_of(samples))
    apart = np.bitwise_count(sketches[0] ^ sketches[1]).sum(axis=1)
    assert apart.max() <= allowed_bits(similarity)
    assert (bands[0] == bands[1]).any(axis=1).all()
    # The count gives the similarity back.
    size = sketches[0].shape[1] * 64
    told = 1 + size / (4 * 160) * np.log(1 - 2 * apart.mean() / size)
    true = both.shape[1] / (both.shape[1] + 2 * own[0].shape[1])
    assert abs(told - true) < 0.01


def test_sketches_of_all_shingles_differ_in_no_more_than_the_sets():
    made = np.random.default_rng(4)
    for size, apart in ((3, 1), (100, 10), (100, 60), (3000, 400), (3000, 3000)):
        both = made.integers(0, 1 << 63, size, dtype=np.uint64)
        other = np.concatenate([both[: size - apart], made.integers(0, 1 << 63, apart, dtype=np.uint64)])
        sketches = set_sketches_of(np.concatenate([both, other]), np.array([0, size, 2 * size]))
        bits = int(np.bitwise_count(sketches[0] ^ sketches[1]).sum())
        assert bits <= 2 * apart
        if apart <= 60:
            assert bits >= 2 * apart * 0.8 - 2


def test_unlike_sketches_are_refused():
    made = np.random.default_rng(2)
    samples = [made.integers(0, 1 << 63, (300, 160), dtype=np.uint64) for _ in "ab"]
    apart = np.bitwise_count(sketches_of(samples[0]) ^ sketches_of(samples[1])).sum(axis=1)
    assert apart.min() > allowed_bits()
    assert allowed_bits(95) < allowed_bits(85) < 200


def test_a_bucket_of_one_component_is_not_paired(spark):
    members = spark.createDataFrame(
        [(1 + p, p, bytearray([n]), bytearray([0])) for n in range(50) for p in range(3)],
        "band long, place int, class binary, least binary",
    )
    roots = spark.createDataFrame(
        [(bytearray([n]), bytearray([0])) for n in range(50)], "vertex binary, root binary"
    )
    classes = members.where("place = 0").selectExpr(
        "class", "9 AS n_shingles", "array(1L, 2L, 3L) AS bands", "array_repeat(0L, 24) AS sketch"
    )
    assert _between(members, classes, roots, 85).count() == 0
    assert _between(members, classes, roots.where("vertex <> x'07'"), 85).count() == 2 * 49


def test_nothing_is_left_behind(spark, docs, tmp_path, monkeypatch):
    made = []
    start = Scratch.__init__

    def noted(self, *given):
        start(self, *given)
        self.folder = f"{tmp_path}/work"
        made.append(self.folder)

    monkeypatch.setattr(Scratch, "__init__", noted)
    assert near_duplicates(docs).count() == docs.count()
    assert made and not (tmp_path / "work").exists()
