"""Token ids in ORC files.

Documents are sorted by id over all files and encoded; each becomes a row of ORC
with its ids as an integer list, which ORC run-length encodes. Row indexes and a
Bloom filter on ``doc_id`` let a reader of few documents skip files, stripes and
row groups; readers of all take stripes in parallel. A row holds where its ids
start within its file part, and a table of part totals, one row a part, places the
parts one after another.

The tokenizer's pieces never reach over white space, so a text's ids are those of
its stretches between spaces, in order. A Python worker remembers the ids of
stretches, as many as its memory is given. Other tokenizers are refused.

Cases: a null or empty text has the end id alone; ids are written in ascending
order, null first, equal ids by a hash of the text, equal rows one after another;
tables may be empty; other columns are left behind.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import keyed, prepare, scratch, slices

END_ID = 2
#: Distinct stretches whose ids a task keeps; beyond it the memory starts anew.
REMEMBERED = 700_000
#: A longer stretch is encoded but not kept.
LONGEST_KEPT = 48
#: Parts stretches encoded together; what holds it is encoded alone.
MARK = "~"
#: Words of letters that have one form only, and stops after one: how they
#: are set apart.
WHOLE = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
STOP = ("([A-Za-zÀ-ÖØ-öø-ÿ])([.,!?;:#$%&*]+)(\\s|$)", "\\1 \\2\\3")
WORD_END = "</w>"

WRITER = {
    "compression": "zstd",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
ROWS = "doc_id long, part int, start long, n_tokens long, ids array<int>"
CHECKED = "doc_id long, part int, start long, n_tokens long, ids_crc32 long"


@cache
def _tokenizer(path: str) -> object:
    """The tokenizer, one to a Python worker and without threads of its own."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path) as file:
        told = json.load(file)
    white = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if told["pre_tokenizer"]["type"] != "Sequence" or white not in told["normalizer"].get(
        "normalizers", []
    ) or told["model"].get("end_of_word_suffix") != WORD_END:
        raise ValueError(f"{path} is not a tokenizer whose pieces end at white space")
    return Tokenizer.from_file(path)


@cache
def _letters_only(path: str) -> object:
    """The same tokenizer for lower-case words that are letters from end to end.

    Its normalizer leaves them as they are and its pattern takes each whole, so
    both may be left out.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    made = Tokenizer.from_str(_tokenizer(path).to_str())
    made.normalizer = None
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return made


class Encoder:
    """Ids of texts, remembering those of stretches between spaces."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.tokenizer = _tokenizer(path)
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        mark = self._ids(MARK)
        self.mark = mark[0] if len(mark) == 1 else None
        self.letters = _letters_only(path)
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith(WORD_END)]] = True

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, stretches: list[str]) -> None:
        """Remember the ids of stretches, many of them in one text."""
        words, rest = [], []
        for s in stretches:
            (words if WHOLE.fullmatch(s) else rest).append(s)
        lower = [s.lower() for s in words]
        self._learn_words([*set(lower).difference(self.known)])
        self.known.update(zip(words, list(map(self.known.__getitem__, lower))))
        self._learn_any(rest)

    def _learn_words(self, words: list[str]) -> None:
        """Words of lower-case letters are one pre-token each, whose last id ends it."""
        if not words:
            return
        made = self.letters.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(made[0].ids, np.int32)
        self._cut(words, ids, np.flatnonzero(self.ends[ids]) + 1, 0)

    def _learn_any(self, stretches: list[str]) -> None:
        if self.mark is not None and stretches:
            plain = [s for s in stretches if MARK not in s]
            ids = np.array(self._ids(f" {MARK} ".join([*plain, ""])), np.int32)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(plain):
                self._cut(plain, ids, ends, 1)
                stretches = [s for s in stretches if MARK in s]
        for s in stretches:
            self.known[s] = np.array(self._ids(s), np.int32).tobytes()

    def _cut(self, stretches: list[str], ids: np.ndarray, ends: np.ndarray, gap: int) -> None:
        """Remember stretches encoded together, ``gap`` ids apart."""
        if len(ends) != len(stretches):
            raise ValueError("the tokenizer does not part words as told")
        data = ids.tobytes()
        begins = np.append(0, ends[:-1] + gap)
        for s, a, b in zip(stretches, (4 * begins).tolist(), (4 * ends).tolist()):
            self.known[s] = data[a:b]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text, the end id last.

        Texts are split and their distinct stretches numbered in Arrow; only these are
        looked up, and each one's ids are then taken wherever it is said.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # Stops after a letter are a piece of their own, as if a space stood before, and
        # a line feed is white space like any other.
        apart = pc.replace_substring(pc.replace_substring_regex(texts, *STOP), "\n", " ")
        parts = pc.split_pattern(apart, " ")
        said = parts.flatten().dictionary_encode()
        first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False), out=first[1:])
        distinct = said.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [s for s in distinct if s not in self.known]
        self._learn(new)
        held = list(map(self.known.__getitem__, distinct))
        ids = np.frombuffer(b"".join(held), np.int32)
        sizes = np.array(list(map(len, held)), np.int64) // 4
        begins = np.cumsum(sizes) - sizes
        said = said.indices.to_numpy(zero_copy_only=False)
        size = sizes[said]
        ends = np.zeros(len(said) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        # Ids lie one after another, those of each text moved on by the end ids before.
        source = np.arange(ends[-1]) + np.repeat(begins[said] - ends[:-1], size)
        offsets = ends[first] + np.arange(len(first))
        whole = np.full(offsets[-1], END_ID, np.int32)
        inside = np.ones(len(whole), bool)
        inside[offsets[1:] - 1] = False
        whole[inside] = ids[source]
        for s in new:
            if len(s) > LONGEST_KEPT:
                del self.known[s]
        if len(self.known) > self.remembered:
            # What came first is what comes often.
            self.known = dict(islice(self.known.items(), self.remembered // 2))
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(whole))


@cache
def _encoder(path: str) -> Encoder:
    """The encoder of a Python worker, which outlives its tasks."""
    return Encoder(path)


def write_token_files(docs: DataFrame, path: str, tokenizer: str) -> str:
    """Encode documents and write their ids, in ascending order of doc_id."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, start = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            lists = encoder.encode(batch.column("text"))
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "part": pa.array(np.full(len(lists), part, np.int32)),
                    "start": pa.array(start + ends - sizes),
                    "n_tokens": pa.array(sizes),
                    "ids": lists,
                }
            )
            start += int(ends[-1])

    rows = keyed(docs)
    rows = rows.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    rows.select("doc_id", "text").mapInArrow(run, ROWS).write.options(**WRITER).orc(path)
    return path


def read_token_files(
    spark: SparkSession, path: str, doc_ids: list[int] | None = None
) -> DataFrame:
    """Written rows: doc_id, part, start within the part, n_tokens and ids.

    Naming documents reads only the stripes and row groups that may hold them.
    """
    rows = spark.read.schema(ROWS).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part: one row a part, from the index columns alone."""
    rows = spark.read.schema(ROWS).orc(path)
    totals = rows.groupBy("part").agg(F.max(F.col("start") + F.col("n_tokens")).alias("total"))
    # A row for each file: their running sum is taken on the driver.
    begin, told = 0, []
    for part, total in sorted(totals.collect()):
        told.append((part, begin))
        begin += total
    return spark.createDataFrame(told, "part int, part_start long")


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """Each written document: doc_id, start among all ids, n_tokens and ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            begins = np.concatenate([[0], ends])[:-1]
            data = memoryview(values.tobytes())
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begins, ends)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(sums, pa.int64())],
                ["doc_id", "part", "start", "n_tokens", "ids_crc32"],
            )

    prepare(spark)
    rows = read_token_files(spark, path).mapInArrow(run, CHECKED)
    starts = part_starts(spark, path)
    return rows.join(F.broadcast(starts), "part").select(
        "doc_id",
        (F.col("part_start") + F.col("start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def token_folder(spark: SparkSession) -> str:
    """A new shared folder for token files."""
    return scratch(spark, "tokens")
