"""Train, freeze, evaluate once, and second opinions that re-enter the landing."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.scores import anomaly_score
from tidemill.operators.escalation import (
    attach_features,
    build_validation_events,
    pending_escalations,
)
from tidemill.operators.forest import (
    Forest,
    fit_isolation_forest,
    load_forest,
    save_forest,
    score_isolation_forest,
)
from tidemill.operators.threshold import confusion_at_threshold, select_threshold_max_f1
from tidemill.schema import (
    CLOUD_TREES,
    EDGE_TREES,
    FEATURES,
    FOREST_SEED,
    NORMAL_LABEL,
    SCORE_STEEPNESS,
    TEST,
    VALIDATION,
    VALIDATION_THRESHOLD,
)
from tidemill.sources.landing import write_landing
from tidemill.session import stable

THRESHOLD_METHOD = "validation_max_f1"


def train_reader(features: DataFrame, dataset_run_id: str) -> DataFrame:
    """Training-eligible rows of one run, complete in every feature."""
    return (
        features.filter(F.col("dataset_run_id") == dataset_run_id)
        .filter("is_training_eligible")
        .dropna(subset=list(FEATURES))
    )


def split_reader(features: DataFrame, dataset_run_id: str, split: str) -> DataFrame:
    return (
        features.filter(F.col("dataset_run_id") == dataset_run_id)
        .filter(F.col("dataset_split") == split)
        .dropna(subset=list(FEATURES))
    )


def validation_reader(features: DataFrame, dataset_run_id: str) -> DataFrame:
    return split_reader(features, dataset_run_id, VALIDATION)


def with_score(df: DataFrame, forest: Forest, name: str = "anomaly_score") -> DataFrame:
    return df.withColumn(name, anomaly_score(score_isolation_forest(forest)))


def frozen_threshold(
    selected: DataFrame, run_id: str, dataset_run_id: str, n_training_rows: int | None = None
) -> DataFrame:
    """The one-row record of a training run, from ``select_threshold_max_f1``."""
    return selected.select(
        F.lit(run_id).alias("run_id"),
        F.lit(dataset_run_id).alias("dataset_run_id"),
        F.array(*[F.lit(f) for f in FEATURES]).alias("feature_columns"),
        F.lit(SCORE_STEEPNESS).alias("score_sigmoid_k"),
        F.lit(THRESHOLD_METHOD).alias("threshold_selection_method"),
        F.col("threshold").alias("selected_threshold"),
        *[F.col(c).alias(f"validation_{c}") for c in ("tp", "fp", "fn", "tn", "precision",
                                                       "recall", "f1")],
        "candidates_evaluated",
        F.lit(n_training_rows).cast("long").alias("n_training_rows"),
    )


@dataclass(frozen=True)
class TrainingRun:
    run_id: str
    forest: Forest
    frozen: DataFrame


def freeze_threshold(
    features: DataFrame, dataset_run_id: str, models: str, run_id: str, score: Column
) -> DataFrame:
    """Select the threshold of ``score`` on VALIDATION and store it under ``models/<run id>``."""
    # Scores are fixed once: they are read for the sweep and again for its totals.
    scored = stable(
        validation_reader(features, dataset_run_id).select(score.alias("anomaly_score"), "is_actual_anomaly")
    )
    path = f"{models}/{run_id}/threshold"
    n = train_reader(features, dataset_run_id).count()
    frozen_threshold(select_threshold_max_f1(scored), run_id, dataset_run_id, n).write.parquet(path)
    frozen = features.sparkSession.read.parquet(path)
    if frozen.isEmpty():
        raise ValueError(f"no VALIDATION rows for run {dataset_run_id!r}: no threshold")
    return frozen


def train(
    features: DataFrame,
    dataset_run_id: str,
    models: str,
    n_trees: int = EDGE_TREES,
    max_samples: int | float | str = "auto",
    contamination: float | str = "auto",
    seed: int = FOREST_SEED,
) -> TrainingRun:
    """Fit on TRAIN, select the threshold on VALIDATION, store both under ``models/<run id>``.
    TEST rows are never read here."""
    run_id = uuid.uuid4().hex
    forest = fit_isolation_forest(
        train_reader(features, dataset_run_id),
        n_trees=n_trees, max_samples=max_samples, contamination=contamination, seed=seed,
    )
    score = anomaly_score(score_isolation_forest(forest))
    frozen = freeze_threshold(features, dataset_run_id, models, run_id, score)
    save_forest(forest, f"{models}/{run_id}")
    return TrainingRun(run_id, forest, frozen)


def evaluate_scored(scored: DataFrame, threshold: float) -> DataFrame:
    """One confusion at the frozen threshold, with windows and distinct recordings."""
    return confusion_at_threshold(
        scored,
        threshold,
        "anomaly_score",
        "is_actual_anomaly",
        F.count(F.lit(1)).alias("n_windows"),
        F.count_distinct("source_file").alias("n_recordings"),
    )


def evaluate_frozen(features: DataFrame, models: str, run_id: str, score: Column | None = None) -> DataFrame:
    """TEST once, with the model and threshold of an explicitly named run; no search. ``score``
    stands in for the stored forest's where the threshold was frozen for another score."""
    if not run_id:
        raise ValueError("run_id is required: an evaluation names the training run it judges")
    spark = features.sparkSession
    frozen = spark.read.parquet(f"{models}/{run_id}/threshold").first()
    if score is None:
        score = anomaly_score(score_isolation_forest(load_forest(spark, f"{models}/{run_id}")))
    rows = split_reader(features, frozen["dataset_run_id"], TEST)
    if rows.isEmpty():
        raise ValueError(f"no TEST rows for run {frozen['dataset_run_id']!r}")
    return evaluate_scored(rows.withColumn("anomaly_score", score), frozen["selected_threshold"]).select(
        F.lit(run_id).alias("run_id"),
        F.lit(frozen["selected_threshold"]).alias("selected_threshold"),
        "*",
    )


def train_second_opinion(
    sensor: DataFrame, n_trees: int = CLOUD_TREES, contamination: float | str = "auto",
    seed: int = FOREST_SEED,
) -> Forest:
    """The larger forest, on every normal row of the sensor table."""
    normal = sensor.filter(F.col("ground_truth_label") == NORMAL_LABEL)
    return fit_isolation_forest(normal, n_trees=n_trees, contamination=contamination, seed=seed)


def score_escalations(
    inference: DataFrame,
    validated: DataFrame,
    sensor: DataFrame,
    score: Forest | Column,
    model_version: str,
    threshold: float = VALIDATION_THRESHOLD,
) -> DataFrame:
    """Second-opinion envelope rows for every pending escalation, by a forest or another score
    over the features. The latency of a row is the time from the start of the job to its score,
    taken from the clock of the task that scores it."""
    value = anomaly_score(score_isolation_forest(score)) if isinstance(score, Forest) else score
    pending = attach_features(pending_escalations(inference, validated), sensor)
    scored = _clocked(pending.withColumn("cloud_score", value))
    return build_validation_events(scored, model_version, threshold, F.col("_latency_ms"))


def _clocked(scored: DataFrame) -> DataFrame:
    """Adds ``_latency_ms``: milliseconds from now until a row passes here in its task."""
    began = time.time()

    @F.pandas_udf("double")
    def elapsed(scores: pd.Series) -> pd.Series:
        return pd.Series((time.time() - began) * 1000.0, index=scores.index)

    return scored.withColumn("_latency_ms", F.greatest(elapsed.asNondeterministic()("cloud_score"), F.lit(0.0)))


def run_second_opinion(
    spark: SparkSession,
    inference: DataFrame,
    validated: DataFrame,
    sensor: DataFrame,
    score: Forest | Column,
    model_version: str,
    landing: str,
    threshold: float = VALIDATION_THRESHOLD,
) -> None:
    """Append the second opinions to the landing tree; a repeated run adds only copies with the
    same ids."""
    write_landing(
        score_escalations(inference, validated, sensor, score, model_version, threshold), landing
    )
