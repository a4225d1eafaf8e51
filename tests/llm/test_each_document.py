"""Operators that judge, encode or search each document, against brute force."""

import pyarrow as pa
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from corpus_cases import (  # noqa: F401
    BENCH_WORD,
    clashing,
    docs,
    lower,
    no_docs,
    prose,
    rows,
    sorted_rows,
    words,
)

from tidemark.llm import subword_classifier
from tidemark.llm.decontamination import clean_documents, contaminated, contamination
from tidemark.llm.personal_data import personal_data, spans_of
from tidemark.llm.quality_rules import kept_documents, repetition
from tidemark.llm.sentencepiece_bpe import Pieces, round_trip
from tidemark.llm.token_files import (
    Encoder,
    read_token_files,
    token_folder,
    token_rows,
    write_token_files,
)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

ODD_TEXTS = [
    None, "", " ", " a", "a ", "a  b", "   a   ", "\n\n\n", "a\tb\n c", "▁a ▁▁ b", "\x00 x", "a\x02. b.",
    "𝒳👩‍👩‍👧 日本語テスト", "á b ́c", "x y", " " * 100 + "x" + " " * 77,
    "</s> <s> <0x41> <|endoftext|> hi<|startoftext|>", "a.<|endoftext|> b", "aaaaaaaa" * 50, "é" * 100,
    "ΑΣ ΣΑ Σ İstanbul ẞ ﬁ", "don't 's 'S it'LL", "A., b,. É. x.\nThe,\ty.", "a~b ~ ~~ x", "1.5 2,000 e.g., i.e.",
]


def brute_repetition(text):
    text = text or ""
    held = words(text)
    seen = Counter(tuple(held[i : i + 5]) for i in range(len(held) - 4))
    inside = set()
    for i in range(len(held) - 4):
        if seen[tuple(held[i : i + 5])] > 1:
            inside |= set(range(i, i + 5))
    earlier, n_dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            n_dup += line in earlier
            earlier.add(line)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(held), sum(map(len, held)), symbols, n_dup, len(inside)


def test_repetition(docs, rows):
    found = repetition(docs)
    got = sorted_rows(
        found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    )
    assert got == sorted([(r[0], *brute_repetition(r[1])) for r in rows], key=repr)
    for row in found.collect():
        failed = row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words
        assert row.base_failed == failed and not (failed and row.kept)


def test_kept_documents(clashing, no_docs):
    found = kept_documents(clashing)
    assert found.columns == clashing.columns
    ids = Counter(r.doc_id for r in found.collect())
    assert ids[0] == 1 and ids[16] == 2 and ids[None] == 2
    assert not {5, 6, 7, 8, 9, 12, 18} & set(ids)
    assert kept_documents(no_docs).count() == repetition(no_docs).count() == 0


BENCHMARK = [
    (1, prose(1, 60)), (2, "Word"), (3, None), (4, ""), (5, "line ONE here, unlike"),
    (6, prose(2, 6000)[3000:3400]), (7, prose(3, 80)[:300]), (7, prose(4, 30)), (None, prose(9, 50)[100:400]), (9, "same " * 20),
]


def brute_contamination(text, items, width=13):
    held = BENCH_WORD.findall(lower(text))
    hit, found = set(), set()
    for name, own in items:
        size = min(width, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            window = own[i : i + size]
            for j in range(len(held) - size + 1):
                if held[j : j + size] == window:
                    hit |= set(range(j, j + size))
                    found.add(name)
    return len(held), len(hit), sorted(found, key=lambda name: (name is None, name or ""))


@pytest.mark.parametrize("block_bytes", [1 << 25, 400])
def test_contamination(spark, docs, rows, block_bytes):
    bench = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    items = [
        (None if i is None else str(i), BENCH_WORD.findall(lower(text))) for i, text in BENCHMARK
    ]
    found = contamination(docs, bench, block_bytes=block_bytes)
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()]
    expected = [(r[0], *brute_contamination(r[1], items)) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    longest = {r.doc_id: (r.longest, r.longest_item, r.longest_at) for r in found.collect()}
    assert longest[2] == (60, "1", 0) and longest[1] == (60, "1", 30) and longest[5][0] == 0


def test_an_item_without_an_id_is_not_one_of_an_empty_id(spark):
    texts = [prose(70, 20), prose(71, 20)]
    bench = spark.createDataFrame([(None, texts[0]), ("", texts[1])], "item_id string, text string")
    docs = spark.createDataFrame([(1, " ".join(texts)), (2, texts[0])], "doc_id long, text string")
    for block_bytes in (1 << 25, 10):
        found = {r.doc_id: r for r in contamination(docs, bench, block_bytes=block_bytes).collect()}
        assert list(found[1]["items"]) == ["", None] and list(found[2]["items"]) == [None]


def test_clean_documents(spark, clashing, docs, no_docs):
    bench = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    bad = sorted_rows(contamination(docs, bench).where(contaminated()), "doc_id")
    found = clean_documents(clashing, bench)
    assert found.columns == clashing.columns
    assert found.count() + len(bad) == clashing.count() and bad
    assert clean_documents(no_docs, bench).count() == 0
    none = bench.limit(0)
    assert clean_documents(docs, none).count() == docs.count()
    assert contamination(docs, none).agg({"n_hit": "sum"}).first()[0] == 0


def test_encoder_is_the_tokenizer(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    texts = ODD_TEXTS + [r[1] for r in rows]
    for remembered in (10**6, 50):
        encoder = Encoder(WORD_BPE, remembered)
        for _ in range(2):
            made = encoder.encode(pa.array(texts, pa.string())).to_pylist()
            for text, ids in zip(texts, made):
                assert ids == library.encode(text or "", add_special_tokens=False).ids + [2]


def test_token_files(spark, docs, rows, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    path = write_token_files(docs, token_folder(spark), WORD_BPE)
    got = sorted(token_rows(spark, path).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    expected = Counter()
    for row in rows:
        made = library.encode(row[1] or "", add_special_tokens=False).ids + [2]
        expected[row[0], len(made), zlib.crc32(np.array(made, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    picked = read_token_files(spark, path, [16]).collect()
    assert [r.doc_id for r in picked] == [16, 16] and all(r.ids[-1] == 2 for r in picked)
    plan = read_token_files(spark, path, [16])._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[[^\]]*doc_id", plan)
    empty = write_token_files(no_docs, token_folder(spark), WORD_BPE)
    assert token_rows(spark, empty).count() == 0


def test_pieces_are_those_of_the_library(rows):
    import random

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    pieces = Pieces(PIECE_BPE, remembered=500)
    made = random.Random(8)
    names = list(pieces.score)
    texts = ODD_TEXTS + [r[1] for r in rows]
    texts += ["".join(made.choices(names, k=made.randint(1, 9))) for _ in range(1500)]
    texts += ["".join(made.choices("aeinrst .▁", k=made.randint(1, 90))) for _ in range(300)]
    for _ in range(2):
        for text, ids, decoded in zip(texts, *pieces.round_trip(texts)):
            expected = library.encode(text or "") + [2]
            assert ids.tolist() == expected
            assert decoded == library.decode(expected) == pieces.decode(expected)


def traced(work):
    """Bytes still held after the work, and the most held meanwhile."""
    import tracemalloc

    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()


def test_stretches_are_remembered_once():
    pieces = Pieces(PIECE_BPE)
    texts = [" ".join(f"w{i * 97 + j}" for j in range(500)) for i in range(0, 200, 6)]

    def learn():
        pieces.round_trip(texts)
        pieces.pairs.clear()

    held, _ = traced(learn)
    assert len(pieces.known) > 10_000 and not pieces.said
    assert held < 220 * len(pieces.known)


def test_decoded_text_is_told_apart_where_it_differs():
    pieces = Pieces(PIECE_BPE, remembered=4)
    texts = ["a\u2581b  c", "\x02a \x02 b", "see. it, \x02", "\x02\x02. x.", "plain one. two", "", None]
    for _ in range(3):
        for ids, decoded in zip(*pieces.round_trip(texts)):
            assert decoded == pieces.decode(ids.tolist())
        assert pieces.said.keys() <= pieces.known.keys()


def test_measures_need_little_memory_at_a_time():
    from tidemark.llm.quality_rules import _measures

    text = " ".join(f"word{i % 900} of{i % 77}" for i in range(200))
    batch = pa.record_batch({"doc_id": list(range(900)), "text": [text] * 900})
    assert batch.nbytes > 2 << 20
    _, most = traced(lambda: [None for _ in _measures(iter([batch]))])
    assert most < 64 << 20


def test_round_trip(docs, clashing, no_docs):
    assert sorted_rows(round_trip(docs, PIECE_BPE)) == sorted_rows(round_trip(clashing, PIECE_BPE))
    assert round_trip(no_docs, PIECE_BPE).count() == 0


def brute_personal(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
        if 16 <= len(digits) <= 19 and sum(sum(divmod(x, 10)) for x in doubled) % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_plain_personal_data():
    import random

    made = random.Random(2)
    parts = ["a", "b.", "@", "@", ".", "-", "1", "23", "255", "4.4", " ", "+", "(", "x@y.z", "é"]
    parts += ["4111 1111 1111 1111", "1.2.3.4", "+1 (555) 010-9999"]
    for _ in range(20000):
        text = "".join(made.choices(parts, k=made.randint(1, 14)))
        assert [s[:3] for s in spans_of(text) if s[3]] == brute_personal(text), text


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("to john (at) mail [dot] example [dot] com now", "email", "john (at) mail [dot] example [dot] com"),
        ("jane at mail dot example dot com", "email", "jane at mail dot example dot com"),
        ("x jоhn@mail.cоm y", "email", "jоhn@mail.cоm"),
        ("ｊｏｅ＠ｍａｉｌ．ｃｏｍ", "email", "ｊｏｅ＠ｍａｉｌ．ｃｏｍ"),
        ("call plus one five five five two one two three four five six", "phone", "plus one five five five two one two three four five six"),
        ("card " + "four" + " one" * 15 + " ok", "card", "four" + " one" * 15),
        ("ip one nine two dot one six eight dot one dot two five x", "ip", "one nine two dot one six eight dot one dot two five"),
    ],
)
def test_disguised_personal_data(text, kind, found):
    added = [(s[0], text[s[1] : s[2]]) for s in spans_of(text) if not s[3]]
    assert added == [(kind, found)]


@pytest.mark.parametrize("unseen", ["\u00ad", "\u200b", "\u200c", "\u200d", "\u2060", "\ufeff"])
@pytest.mark.parametrize(
    "kind,value",
    [
        ("email", "john@mail.com"), ("ip", "192.168.10.25"), ("card", "4111111111111111"),
        ("card", "4111 1111 1111 1111"), ("phone", "+1 555 010 9999"),
    ],
)
def test_unseen_characters_anywhere_inside(unseen, kind, value):
    for i in range(1, len(value)):
        odd = value[:i] + unseen + value[i:]
        text = f"see {unseen}{odd}{unseen} now"
        at = text.index(odd)
        assert (kind, at, at + len(odd)) in [s[:3] for s in spans_of(text)]
    apart = unseen.join(value)
    assert (kind, 0, len(apart), False) in spans_of(apart)
    # One outside changes nothing.
    assert spans_of(f"{value} {unseen}x") == [(kind, 0, len(value), True)]


@pytest.mark.parametrize("at", ["@", " [at] ", "(at)", " at ", "  AT "])
def test_every_mixture_of_marks(at):
    marks = [".", " [dot] ", "(dot)", " dot ", " DOT  "]
    for own, first, last in itertools.product(["", *marks], marks, marks):
        address = "john" + (own and f"{own}smith") + f"{at}mail{first}example{last}com"
        text = f"to {address}, then"
        found = [s for s in spans_of(text) if s[1:3] == (3, 3 + len(address))]
        plain = at == "@" and {own, first, last} <= {"", "."}
        # A bare "at" among plain dots is prose that names a site.
        prose = at.strip().lower() == "at" and {own, first, last} <= {"", "."}
        assert found == ([] if prose else [("email", 3, 3 + len(address), plain)]), text


@pytest.mark.parametrize(
    "text,found",
    [
        ("john [at] example dot com", "john [at] example dot com"),
        ("john@example dot com", "john@example dot com"),
        ("john at example [dot] com", "john at example [dot] com"),
        ("say john dot smith at example dot com", "john dot smith at example dot com"),
        ("a dot b dot c_d at example dot co dot uk is", "a dot b dot c_d at example dot co dot uk"),
        ("john at example dot com dot Then", "john at example dot com"),
        ("ann at x dot pl or bob at y dot dev now", "ann at x dot pl|bob at y dot dev"),
        ("john [at] example dot unheard", "john [at] example dot unheard"),
    ]
    + [(f"x at y dot {n} z", f"x at y dot {n}") for n in "co ai dev app me pl se biz".split()],
)
def test_mixed_addresses(text, found):
    added = [text[s[1] : s[2]] for s in spans_of(text) if s[0] == "email" and not s[3]]
    assert added == found.split("|")


def test_prose_beside_marks():
    for text in [
        "look at example.com now", "look at the dot to see", "pointed at a dot so small",
        "he stood at one dot unheard", "@john dot com", "x dot y",
    ]:
        assert spans_of(text) == [], text
    for text in (" at a dot b" * 30_000, "a dot " * 60_000, " at " * 90_000 + "x dot com", "a@b dot " * 40_000):
        spans_of(text)


@pytest.mark.parametrize(
    "kind,value",
    [
        ("phone", "+1 five five five 867 5309"), ("phone", "+1 555 867 53 zero nine"),
        ("phone", "plus one five 55 867 5309"), ("card", "4111 1111 1111 one one one one"),
        ("card", "4111 1111 1111 11 one one"), ("ip", "one dot one.22.33"),
        ("email", "john@four-two.com"), ("email", "john at example [dot] com"),
    ],
)
def test_identifiers_do_not_depend_on_text_far_away(kind, value):
    alone = spans_of(f"{value}, yes")
    assert (kind, 0, len(value)) in [s[:3] for s in alone]
    for far in (" а", " –", " Ａ", " x dot y", " [dot]", " seven eight", " one" * 9, "\u200b"):
        assert spans_of(f"{value}, yes.{far}") == alone


def test_clean_texts_have_no_personal_data(rows):
    for text in ["he was at the dot of it", "one two three", "at a dot b", prose(1, 300), None, ""]:
        assert spans_of(text) == []


def test_personal_data_of_long_texts():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1 " * 150_000, "one " * 70_000, "+1" + " " * 300_000):
        spans_of(text)


def test_personal_data(docs, clashing, no_docs, rows):
    assert personal_data(docs).count() == len(rows)
    assert sorted_rows(personal_data(docs)) == sorted_rows(personal_data(clashing))
    assert personal_data(no_docs).count() == 0


@pytest.mark.parametrize("white", [" ", "\t", "\n", " \n"])
def test_long_white_space_beside_every_hint(white):
    """Work follows the text: a run of white space is looked at from its beginning only."""
    import time

    run = white * 150_000
    hints = ["\u0458", "[at]", "[", "(dot", " dot ", "one two", "plus one", "john at", "a dot", "@"]
    begin = time.time()
    for hint in hints:
        for text in (hint + run, run + hint, "x" + run + hint + run + hint):
            spans_of(text)
    assert time.time() - begin < 20
    disguised = f"write{white * 3000}to john{white}[at]{white * 2000}example (dot) com now"
    (found,) = spans_of(disguised)
    assert disguised[found[1] : found[1] + 4] == "john"


def labelled(n):
    texts = [prose(i, 60) for i in range(n)]
    texts = [t.upper().replace(" ", "!! ") if i % 3 == 0 else t for i, t in enumerate(texts)]
    return [(i, t) for i, t in enumerate(texts)], [(i, int(i % 3 != 0)) for i in range(n)]


def test_classifier_on_held_out(spark):
    rows, labels = labelled(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id long, label int")
    model = subword_classifier.fit(docs, known)
    assert model.count() == 1
    got = {r.doc_id: r.score for r in subword_classifier.scores(docs, model).collect()}
    right = [(got[i] >= 0.5) == bool(label) for i, label in labels if i % 2 == 0]
    assert sum(right) >= 0.95 * len(right)


def test_classifier_without_two_classes(spark, docs, rows, no_docs):
    none = spark.createDataFrame([], "doc_id long, label int")
    for labels, score in ((none, 0.5), (none.union(spark.sql("select 0L, 1")), 1.0)):
        model = subword_classifier.fit(docs, labels)
        got = subword_classifier.scores(docs, model).collect()
        assert len(got) == len(rows) and all(abs(r.score - score) < 1e-6 for r in got)
    odd = spark.sql("select 0L doc_id, null label union all select null, 1")
    model = subword_classifier.fit(no_docs, odd.selectExpr("doc_id", "cast(label as int) label"))
    assert subword_classifier.scores(no_docs, model).count() == 0


def test_the_sample_is_bounded(spark):
    """By ids of each class, by one document an id, by bytes; whatever ids repeat."""
    rows, labels = labelled(60)
    rows += [(1, f"again {n}") for n in range(500)] + [(2, "x" * 3000), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, label int")
    held = subword_classifier.sample(docs, known, 15).collect()
    assert len({r.doc_id for r in held}) == len(held) == 30
    assert sorted(r.label for r in held) == [0] * 15 + [1] * 15
    few = subword_classifier.sample(docs, known, 15, 2000).collect()
    assert 0 < sum(len(r.text) for r in few) <= 2000 and len(few) < 30
    assert {r.doc_id for r in few} <= {r.doc_id for r in held}
    long = [(i, t + " y" * (subword_classifier.LONGEST // 2)) for i, t in rows[:3]] + rows[3:60]
    docs = spark.createDataFrame(long, "doc_id long, text string")
    assert {r.doc_id for r in subword_classifier.sample(docs, known).collect()} == set(range(3, 60))
    # Documents are read by as many tasks as they have, not by the one that learns.
    plan = subword_classifier.fit(docs, known)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan


def test_classifier_query_on_the_given_labels(spark):
    from pathlib import Path

    import pyarrow.parquet as pq

    from tidemark.llm.queries import op7_subword_classifier

    folder = "/root/testdata/sf0.01"
    if not Path(folder).exists():
        pytest.skip("no test data")
    got = op7_subword_classifier(spark, folder).collect()
    assert len(got) == pq.read_metadata(f"{folder}/documents.parquet").num_rows
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    labels = pq.read_table(f"{folder}/labels.parquet").to_pylist()
    quality = {x["doc_id"]: x["quality"] for x in labels}
    told = [(r.predicted, quality[r.doc_id]) for r in got if r.held_out and r.doc_id in quality]
    assert len(told) > 80 and len({q for _, q in told}) == 2
    assert sum(p == q for p, q in told) >= 0.93 * len(told)


def test_empty_texts_have_a_score(spark):
    rows, labels = labelled(40)
    docs = spark.createDataFrame(rows + [(100, ""), (101, None)], "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, label int")
    got = subword_classifier.scores(docs, subword_classifier.fit(docs, known)).collect()
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 42


def test_owners_are_not_mixed(rows):
    """Batches of any cut give the same result."""
    import pyarrow as pa

    from tidemark.llm.quality_rules import _measure

    table = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    whole = pa.Table.from_batches([_measure(b) for b in table.to_batches()])
    single = pa.Table.from_batches([_measure(b) for b in table.to_batches(max_chunksize=1)])
    assert whole.equals(single)
