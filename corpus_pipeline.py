"""From raw documents to training tokens: five stages, each over what the last kept.

Every stage is written to the shared folder and read back, so a lost executor
repeats tasks of one stage only. All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import prepare, stored, table
from tidemark.llm.decontamination import clean_documents
from tidemark.llm.line_dedup import without_repeats
from tidemark.llm.quality_rules import kept_documents
from tidemark.llm.queries import token_digests, tokenizer
from tidemark.llm.sentencepiece_bpe import round_trip
from tidemark.llm.simhash_dedup import one_of_each

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules on words, symbols and repetition keep."""
    prepare(spark)
    return kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line windows."""
    prepare(spark)
    return without_repeats(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to be contaminated."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text they decode to."""
    prepare(spark)
    return token_digests(round_trip(docs, tokenizer("piece_bpe_32k.model")))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Fingerprints and token ids are beyond SQL; tests hold a brute-force run against it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
