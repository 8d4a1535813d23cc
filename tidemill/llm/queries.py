"""One query for each operator, on whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import chat, collocations, minhash, mixing, neighbours, outliers, packing, pii, secrets, suffixes, toxicity, warc, whitening
from tidemill.llm.common import table
from tidemill.session import apply_semantics

PII_KEY = "change-me-in-production"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    return toxicity.document_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    rendered = chat.rotate(table(spark, sf_dir, "conversations"))
    return rendered.withColumn("mask", chat.written(F.col("mask")))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    return secrets.document_findings(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    return outliers.filter_documents(table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    done = pii.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)

    def number(kind: str) -> Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return done.select("row.doc_id", *map(number, pii.PATTERNS), "row.text")


def tokenizer() -> tuple[str, str, dict[str, int]]:
    """The ranks of the byte-level vocabulary, the pattern that parts texts into words, and the
    vocabulary's added tokens."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer())


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    return whitening.by_component(whitening.whitened(table(spark, sf_dir, "embeddings")))


def op13_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantics(spark)
    return warc.archived(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_chat_perspectives, op3_secret_scans, op4_nearest_neighbours, op5_suffix_dedup,
        op6_minhash_dedup, op7_quality_outliers, op8_pii_surrogates, op9_packing, op10_mixing,
        op11_collocations, op12_whitening, op13_warc_bundles)
}

ORACLES: dict[str, str] = {
    "op2_chat_perspectives": chat.oracle(),
    "op3_secret_scans": secrets.oracle(),
    "op4_nearest_neighbours": neighbours.oracle(),
    "op5_suffix_dedup": suffixes.oracle(),
    "op6_minhash_dedup": minhash.oracle(85),
    "op10_mixing": mixing.oracle(),
    "op11_collocations": collocations.oracle(),
    "op13_warc_bundles": warc.oracle(),
}
