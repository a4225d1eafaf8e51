"""Interaction of filters against counting document by document."""

import random
from itertools import permutations

import numpy as np
import pytest
from corpus_cases import clashing, docs, no_docs, rows, words  # noqa: F401

from tidemark.llm import filter_audit
from tidemark.llm.filter_audit import audit, difference, failing, gallop, posting_lists, union

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark):
    made = [(i, i % 2, i % 3 == 0) for i in range(0, 21, 2)]
    made = [(i, int(q), int(t)) for i, q, t in made] + [(4, 1, None), (4, None, 0), (None, 1, 1)]
    return spark.createDataFrame(made, LABELS)


def brute_fails(held):
    """Letters each document fails."""
    ids = {}
    for i, text, *_ in held:
        if i is not None:
            ids[text or ""] = min(ids.get(text or "", i), i)
    found = []
    for i, text, *_ in held:
        text = text or ""
        said = words(text)
        letters = "A" * (len(said) < 100) + "B" * (100 * len(set(said)) < 80 * len(said))
        letters += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text))
        letters += "D" * any(c in "#$%&*|" for c in text)
        letters += "E" * (i is not None and i > ids[text])
        found.append(letters)
    return found


def brute_audit(held, known):
    good = {i for i, q, _ in known if q == 1 and i is not None}
    toxic = {i for i, _, t in known if t == 1 and i is not None}
    failed = [(r[2] or "", r[0], f) for r, f in zip(held, brute_fails(held))]
    found = {}
    for part in {p for p, _, _ in failed}:
        mine = [(i, f) for p, i, f in failed if p == part]
        for order in map("".join, permutations("ABCDE")):
            for step, name in enumerate(order):
                before = order[:step]
                left = [(i, f) for i, f in mine if not set(f) & set(before)]
                lost = [(i, f) for i, f in left if name in f]
                found[part, order, step + 1] = [
                    len(left) - len(lost),
                    len(lost),
                    sum(name in f for _, f in mine) - len(lost),
                    sum(f == name for _, f in mine),
                    sum(i in good for i, _ in lost),
                    sum(i in toxic for i, _ in lost),
                ]
    shares = {}
    for (part, order, step), row in found.items():
        shares[part, order[step - 1]] = shares.get((part, order[step - 1]), 0) + row[1]
    return sorted((*key, *row, shares[key[0], key[1][key[2] - 1]]) for key, row in found.items())


def got(found):
    return sorted(map(tuple, found.collect()))


def test_failing(docs, rows):
    expected = sorted(
        ((r[0], f) for r, f in zip(rows, brute_fails(rows))), key=repr
    )
    told = [
        (r.doc_id, "".join(x for i, x in enumerate("ABCDE") if r.fails >> i & 1))
        for r in failing(docs).collect()
    ]
    assert sorted(told, key=repr) == expected
    assert {x for _, f in expected for x in f} == set("ABCDE") - {"C"}


def test_capitals_alone_and_at_the_bound(spark):
    texts = ["A" + "b" * 9, "AA" + "b" * 9, "Ä" * 5, "A" + "é" * 8]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)],
                                  "doc_id long, text string, lang string")
    fails = {r.doc_id: bool(r.fails & 4) for r in failing(frame).collect()}
    assert fails == {0: False, 1: True, 2: False, 3: True}


@pytest.mark.parametrize("size", [1 << 16, 4])
def test_audit(docs, rows, labels, size):
    known = [tuple(r) for r in labels.collect()]
    assert got(audit(docs, labels, size)) == brute_audit(rows, known)


def test_clashing_columns(clashing, rows, labels):
    known = [tuple(r) for r in labels.collect()]
    assert got(audit(clashing, labels)) == brute_audit(rows, known)


def test_empty_tables(spark, docs, rows, no_docs, labels):
    assert audit(no_docs, labels).count() == 0
    assert got(audit(docs, spark.createDataFrame([], LABELS))) == brute_audit(rows, [])


def test_many_documents_and_a_busy_part(spark):
    made = random.Random(8)
    texts = [" ".join(made.choice("ab#cDE") * made.randint(1, 3) for _ in range(n))
             for n in (0, 1, 5, 99, 100, 101, 130)]
    held = [(made.randrange(2000) if made.random() < 0.9 else None, made.choice([*texts, None]),
             made.choice(["en", "en", "de", "", None])) for _ in range(3000)]
    known = [(i, made.randint(0, 1), made.randint(0, 1)) for i in range(0, 2000, 3)]
    frame = spark.createDataFrame(held, "doc_id long, text string, lang string").repartition(7)
    found = audit(frame, spark.createDataFrame(known, LABELS))
    assert got(found) == brute_audit(held, known)


def test_ranges_are_bounded_and_sorted(docs, labels):
    held = posting_lists(docs, labels, 3).collect()
    assert sum(r.documents for r in held) == docs.count()
    for r in held:
        assert r.documents <= 3
        assert all(list(r[x]) == sorted(set(r[x])) for x in filter_audit.LISTS)
        assert r.first_id is None or r.first_id <= r.last_id


@pytest.mark.parametrize("seed", range(6))
def test_galloping_merges(seed):
    made = np.random.default_rng(seed)
    lists = []
    for _ in range(5):
        starts = made.integers(0, 60000, made.integers(0, 40))
        runs = [np.arange(s, s + made.integers(1, 2500)) for s in starts]
        ids = np.concatenate([np.zeros(0, int), *runs, made.integers(0, 60000, made.integers(0, 3000))])
        lists.append(np.unique(ids).astype(np.int32))
    whole = union(lists)
    assert whole.tolist() == sorted(set().union(*[x.tolist() for x in lists]))
    for a in lists:
        for b in lists:
            assert difference(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
    for bound in made.integers(0, 62000, 50).tolist():
        start = int(made.integers(0, len(whole) + 1))
        expected = next((i for i in range(start, len(whole)) if whole[i] >= bound), len(whole))
        assert gallop(whole, start, bound) == expected
    assert union([]).tolist() == [] and difference(whole[:0], whole).tolist() == []
