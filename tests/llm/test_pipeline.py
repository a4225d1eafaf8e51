"""The pipeline against a brute-force run of its stages."""

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from corpus_cases import BENCH_WORD, DOCS, lower, no_docs, prose, sample_rows, words  # noqa: F401
from test_each_document import BENCHMARK, brute_contamination
from test_near import brute_print, brute_roots
from test_repeats import brute_lines

import __spark_entry__ as entry
from tidemark.llm.quality_rules import LINE_PERCENT, NGRAM_PERCENT, SYMBOL_PERCENT


def brute_kept(text):
    """Whether all rules keep a text."""
    held = words(text)
    chars = sum(map(len, held))

    def inside(length, later):
        first, marked = {}, set()
        for i in range(len(held) - length + 1):
            first.setdefault(tuple(held[i : i + length]), []).append(i)
        for places in first.values():
            for i in places[1:] if later else places if len(places) > 1 else []:
                marked |= set(range(i, i + length))
        return marked

    if len(held) < 10 or 100 * len(inside(5, False)) > 20 * len(held):
        return False
    if 100 * sum(text.count(c) for c in "#*$%&|<>") > SYMBOL_PERCENT * len(held):
        return False
    for length, percent in NGRAM_PERCENT.items():
        if 100 * sum(len(held[i]) for i in inside(length, True)) > percent * chars:
            return False
    earlier, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += sum(map(len, words(line))) * (line in earlier)
            earlier.add(line)
    return 100 * dup <= LINE_PERCENT * chars


def brute_pipeline(rows, benchmark):
    rows = [r for r in rows if brute_kept(r[1])]
    rows = [(doc, text) for doc, _, _, text in brute_lines(rows)]
    prints = [brute_print(text) for _, text in rows]
    roots = brute_roots(prints, 2)
    least = {}
    for (doc, _), value in zip(rows, prints):
        least[roots[value]] = min(least.get(roots[value], doc), doc)
    rows = [r for r, value in zip(rows, prints) if least[roots[value]] == r[0]]
    items = [(str(i), BENCH_WORD.findall(lower(text))) for i, text in benchmark]
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    result = []
    for doc, text in rows:
        n_words, n_hit, _ = brute_contamination(text, items)
        if n_hit and 20 * n_hit >= n_words:
            continue
        ids = model.encode(text) + [2]
        told = " ".join(map(str, ids)).encode()
        spoken = model.decode(ids).encode()
        digests = hashlib.sha256(told).hexdigest(), hashlib.sha256(spoken).hexdigest()
        result.append((doc, len(ids), *digests))
    return sorted(result)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    seen, rows = set(), []
    for row in sample_rows():
        if row[0] is not None and row[0] not in seen:
            seen.add(row[0])
            rows.append(row)
    page = "\n".join(prose(40 + i, 12) for i in range(9))
    other = prose(60, 200)
    more = [page + "\n" + prose(70, 30), prose(71, 30) + "\n" + page, other, other + " x", other]
    rows += [(100 + i, text, "en", "src", len(text)) for i, text in enumerate(more)]
    path = str(tmp_path_factory.mktemp("tables"))
    frame = spark.createDataFrame(rows, DOCS).repartition(2)
    frame.write.parquet(f"{path}/documents.parquet")
    bench = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    bench.write.parquet(f"{path}/benchmark.parquet")
    return path, rows


def test_stages_are_the_five_named():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "line_dedup",
        "simhash_dedup",
        "decontamination",
        "sentencepiece",
    ]
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_run(spark, folder):
    path, rows = folder
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, path).collect())
    expected = brute_pipeline(rows, BENCHMARK)
    assert got == expected
    assert 0 < len(got) < len(rows)


def test_stages_keep_the_columns(spark, folder, no_docs):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == no_docs.columns
        assert stage(spark, no_docs, path).count() == 0
