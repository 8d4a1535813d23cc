"""A corpus prepared for training: toxicity, near duplicates, personal data, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import minhash, mixing, packing, pii, toxicity
from tidemill.llm.common import one_row_each, settled, table
from tidemill.llm.queries import PII_KEY, tokenizer
from tidemill.session import apply_semantics


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold."""
    apply_semantics(spark)
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    return docs.filter(toxicity.scored(model, F.col("text")) < toxicity.THRESHOLD)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates (five words, 0.8), and the
    rows without an id. Texts that share an id are documents of their own; of rows equal in id and
    text one stays."""
    apply_semantics(spark)
    ids = minhash.survivors(docs, percent=80).select(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark"))
    same = (F.col("own") == F.col("kept_id")) & (F.col("mark") == F.col("kept_mark"))
    one = one_row_each(docs.filter(F.col("doc_id").isNotNull())).join(ids, same, "left_semi")
    return one.select("row.*").unionByName(docs.filter(F.col("doc_id").isNull()))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data."""
    apply_semantics(spark)
    done = pii.replace_entities(docs, PII_KEY)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of the curriculum."""
    apply_semantics(spark)
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    apply_semantics(spark)
    return packing.pack(docs, *tokenizer())


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None  # models and graphs: each stage is tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
