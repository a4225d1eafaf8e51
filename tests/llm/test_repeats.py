"""Line, window and suffix removal against brute force."""

from collections import Counter, defaultdict

import pytest
from corpus_cases import clashing, docs, no_docs, prose, rows, sample_rows, sorted_rows, words  # noqa: F401

from tidemark.llm import chunks, suffix_dedup
from tidemark.llm.line_dedup import repeated_lines, without_repeats
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.suffix_dedup import (
    decoded,
    front_coded,
    merged,
    remove_earlier,
    run_size,
    shared_prefixes,
)


DOC = "doc_id long, text string"


def key_of(row):
    return (row[0] is not None, row[0] or 0)


def brute_lines(rows, width=3):
    first = {}
    split = [(r[0], r[1], r[1].split("\n") if r[1] else []) for r in rows]
    for doc, text, lines in split:
        for i in range(len(lines) - width + 1):
            held = tuple(lines[i : i + width])
            if any(words(x) for x in held):
                first.setdefault(held, []).append((key_of((doc,)), text, i))
    result = []
    for doc, text, lines in split:
        gone = set()
        for i in range(len(lines) - width + 1):
            places = first.get(tuple(lines[i : i + width]))
            if places:
                ids = min(p[0] for p in places)
                mine = (key_of((doc,)), text, i)
                # Ties of id are settled by text hash; the tests have none that repeat.
                least = min(p for p in places if p[0] == ids)
                if mine != least:
                    gone |= set(range(i, i + width))
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        result.append((doc, len(lines), len(gone), kept if gone else text))
    return result


def test_lines(docs, rows):
    found = repeated_lines(docs).select("doc_id", "n_lines", "n_removed", "text")
    assert sorted_rows(found) == sorted(brute_lines(rows), key=repr)


def test_lines_keep_other_columns(clashing, rows):
    found = without_repeats(clashing)
    assert found.columns == clashing.columns
    texts = {r[0]: r[1] for r in sorted_rows(repeated_lines(clashing), "doc_id", "text") if r[0] == 11}
    got = [r for r in found.collect() if r.doc_id == 11]
    assert [r.text for r in got] == [texts[11]] == ["head\ntail"]
    assert got[0].n_chars == 9 and got[0].h1 == "h1"
    assert found.count() == len(rows)


def brute_windows(rows, width):
    parts = [words(r[1]) for r in rows]
    seen = Counter(tuple(w[i : i + width]) for w in parts for i in range(len(w) - width + 1))
    result = []
    for row, w in zip(rows, parts):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        result.append((row[0], kept, len(w), len(gone)))
    return sorted(result, key=repr)


@pytest.mark.parametrize("width,chunk_bytes", [(35, 1 << 21), (35, 3000), (5, 500)])
def test_windows(docs, rows, width, chunk_bytes):
    found = remove_repeats(docs, width, chunk_bytes)
    assert sorted_rows(found, "doc_id", "text", "n_words", "n_removed") == brute_windows(rows, width)
    for row in found.collect():
        assert sum(b - a for a, b in row.removed) == row.n_removed


def brute_suffixes(rows, width=50):
    first = {}
    texts = [(key_of(r), r[0], (r[1] or "").encode()) for r in rows]
    for key, _, data in sorted(texts, key=lambda x: x[0]):
        for i in range(len(data) - width + 1):
            first.setdefault(data[i : i + width], key)
    result = []
    for key, doc, data in texts:
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < key:
                gone[i : i + width] = b"\1" * width
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        result.append((doc, kept, len(data), sum(gone), spans))
    return sorted(result, key=repr)


@pytest.mark.parametrize("chunk_bytes,range_bytes", [(1 << 21, 1 << 24), (4000, 9000)])
def test_suffixes(docs, rows, chunk_bytes, range_bytes):
    found = remove_earlier(docs, chunk_bytes=chunk_bytes, range_bytes=range_bytes)
    got = [
        (r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, len(r.removed)) for r in found.collect()
    ]
    assert sorted(got, key=repr) == brute_suffixes(rows)


def test_suffixes_of_a_small_alphabet(spark):
    import random

    made = random.Random(5)
    base = ["".join(made.choice("ab") for _ in range(90)) for _ in range(4)]
    rows = [
        (i, "".join(made.choice(base)[made.randrange(30) :] for _ in range(3)).replace("aaaa", "\x00a"))
        for i in range(60)
    ]
    found = remove_earlier(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=900)
    got = [
        (r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, len(r.removed)) for r in found.collect()
    ]
    assert sorted(got, key=repr) == brute_suffixes(rows)


def test_many_lines_of_which_many_go(spark):
    """Work follows the lines: 200,000 of them, most removed from the second document."""
    import time

    text = "\n".join(f"line {n} of a long document" for n in range(200_000))
    docs = spark.createDataFrame([(1, text), (2, "own\n" + text + "\nown too")], DOC)
    begin = time.time()
    found = {r.doc_id: r for r in repeated_lines(docs).collect()}
    assert found[1].n_removed == 0 and found[1].text == text
    assert found[2].n_removed == 200_000 and found[2].text == "own\nown too"
    assert time.time() - begin < 60


def test_runs_come_back_from_their_coding():
    import numpy as np

    made = np.random.default_rng(5)
    for count in (0, 1, 200):
        rows = made.integers(97, 99, (count, 12), dtype=np.uint8)
        rows[:, -2], rows[:, -1] = 4, 6
        order = np.lexsort(rows.T[::-1])
        rows, ids = rows[order], made.integers(0, 99, count)
        body = front_coded(rows, ids, 6)
        assert run_size(body) == count
        got, common, told = decoded(body, 6, 4)
        assert (got == rows).all() and (told == ids).all()
        assert (common == shared_prefixes(rows)).all()


def test_merging_runs():
    import random

    import numpy as np

    made = random.Random(3)
    runs = [
        sorted({bytes(made.choices(b"ab\0", k=9)) for _ in range(made.randrange(40))})
        for _ in range(11)
    ]
    tables = [np.array([list(x) for x in run], np.uint8).reshape(len(run), 9) for run in runs]
    shared = np.concatenate([shared_prefixes(t) for t in tables]).astype(np.uint8)
    order, common = merged(np.concatenate(tables), np.array([len(t) for t in tables]), shared)
    at = defaultdict(int)
    out = []
    for run in order:
        out.append(runs[run][at[run]])
        at[run] += 1
    assert out == sorted(x for run in runs for x in run)
    for a, b, shared in zip(out, out[1:], common[1:]):
        assert a[:shared] == b[:shared] and a[shared : shared + 1] != b[shared : shared + 1] or a == b


def test_no_documents(no_docs):
    for found in (repeated_lines(no_docs), remove_repeats(no_docs), remove_earlier(no_docs)):
        assert found.count() == 0


def test_other_columns_do_not_matter(clashing, docs):
    for work in (remove_repeats, remove_earlier, repeated_lines):
        assert sorted_rows(work(clashing)) == sorted_rows(work(docs))


def test_a_group_of_copies_meets_once_a_chunk(spark):
    """Copies of one text: all but the first go, whatever the chunks."""
    text = sample_rows()[0][1]
    rows = [(i, text) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in remove_earlier(frame, chunk_bytes=20_000).collect()}
    assert found[0].n_removed == 0 and all(found[i].n_removed == len(text.encode()) for i in range(1, 300))
    found = remove_repeats(frame, chunk_bytes=20_000)
    assert all(r.n_removed == r.n_words for r in found.collect())


def test_bounds_of_large_groups_of_copies(spark, monkeypatch):
    """Copies are not drawn all or none, and few of their contexts reach the driver."""
    texts = [prose(i, 50) for i in range(4)]
    docs = spark.createDataFrame(
        [(i, texts[i % 4]) for i in range(4000)], "doc_id long, text string"
    ).repartition(3)
    total = sum(len(t.encode()) for t in texts) * 1000
    got, collect = [], type(docs).toArrow

    def seen(frame):
        got.append(collect(frame))
        return got[-1]

    monkeypatch.setattr(type(docs), "toArrow", seen)
    monkeypatch.setattr(suffix_dedup, "HEADS", 300, raising=False)
    for share in (50, 2):
        monkeypatch.setattr(suffix_dedup, "SAMPLE_BYTES", total // share)
        bounds = suffix_dedup.range_bounds(docs, total, 50, 24, 20_000)
        assert len(bounds) > 4 and 0 < got.pop().num_rows <= 300


def test_rows_stated_often(spark, monkeypatch):
    """Rows equal in id and text do not pile up in a chunk, nor do many short ones."""
    same = prose(1, 50)
    rows = [(None, same)] * 700 + [(None, None)] * 400 + [(3, prose(2, 60))] * 2
    rows += [(4, "x " + same), (5, prose(2, 60) + " y"), (6, prose(3, 60))] + [(i, "") for i in range(7, 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(chunks, "CHUNK_ROWS", 50, raising=False)
    total = chunks.text_bytes(docs)
    dealt = chunks.chunked(docs, total, 20_000)
    assert max(r["count"] for r in dealt.groupBy("chunk").count().collect()) < 100
    found = remove_repeats(docs, chunk_bytes=20_000)
    assert found.columns == ["doc_id", "text", "n_words", "n_removed", "removed"]
    assert sorted_rows(found, "doc_id", "text", "n_words", "n_removed") == brute_windows(rows, 35)
    found = remove_earlier(docs, chunk_bytes=20_000)
    assert found.columns == ["doc_id", "kept", "n_bytes", "n_removed", "removed"]
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, len(r.removed)) for r in found.collect()]
    assert sorted(got, key=repr) == brute_suffixes(rows)


def test_a_large_number_of_rows_comes_out_again(spark):
    rows = spark.sql("select 1 id, 150000L stated union all select 2, 1L union all select 3, 65536L")
    got = {r.id: r["count"] for r in chunks.as_stated(rows).groupBy("id").count().collect()}
    assert got == {1: 150000, 2: 1, 3: 65536}
