"""The corpus operators applied to the given tables, by query name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.centroid_search import clustered
from tidemark.llm.common import table
from tidemark.llm.decontamination import contaminated, contamination
from tidemark.llm.filter_audit import audit
from tidemark.llm.line_dedup import repeated_lines
from tidemark.llm.minhash_dedup import near_duplicates as alike
from tidemark.llm.oracles import ORACLES  # noqa: F401
from tidemark.llm.personal_data import KINDS, personal_data
from tidemark.llm.quality_rules import repetition
from tidemark.llm.sentencepiece_bpe import round_trip
from tidemark.llm.simhash_dedup import near_duplicates
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.subword_classifier import fit, scores
from tidemark.llm.suffix_dedup import remove_earlier
from tidemark.llm.token_files import token_folder, token_rows, write_token_files


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows, removed from every document."""
    found = repeated_lines(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return found.select("doc_id", "n_lines", "n_removed", kept.alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 35 words that occur twice or more, removed from every document."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written to ORC files and read back from them."""
    docs = table(spark, sf_dir, "documents")
    path = write_token_files(docs, token_folder(spark), tokenizer("word_bpe_49k.json"))
    return token_rows(spark, path)


def token_digests(found: DataFrame) -> DataFrame:
    """Digests of ids and of the text they decode to."""
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    docs = table(spark, sf_dir, "documents")
    return token_digests(round_trip(docs, tokenizer("piece_bpe_32k.model")))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: plain spans counted, all spans told."""
    found = personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])

    def told(spans: F.Column) -> F.Column:
        return F.array_join(
            F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ","
        )

    def count(kind: str) -> F.Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def held_out() -> F.Column:
    """Documents whose labels are not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document holds, removed."""
    found = remove_earlier(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return scores(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdicts of every document."""
    found = repetition(table(spark, sf_dir, "documents"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(*base, "base_failed", "kept")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds."""
    found = clustered(table(spark, sf_dir, "embeddings"))
    told = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(told, 256).alias("centroid_sha256"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, by language."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set, and its component of near-duplicates."""
    found = alike(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_files": op3_token_files,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_personal_data": op5_personal_data,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_subword_classifier": op7_subword_classifier,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_decontamination": op10_decontamination,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_filter_audit": op12_filter_audit,
    "op13_minhash_dedup": op13_minhash_dedup,
}
