"""Confusion at a threshold and the exact best-F1 threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scores import ratio_or_zero
from tidemill.operators.ordered import MAX_ROWS_PER_TASK, OrderedRuns
from tidemill.session import stable


def _rates(counted: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    p, r = F.col("precision"), F.col("recall")
    return (
        counted.withColumn("precision", ratio_or_zero(tp, tp + fp))
        .withColumn("recall", ratio_or_zero(tp, tp + fn))
        .withColumn("f1", ratio_or_zero(2 * p * r, p + r))
    )


def confusion_at_threshold(
    df: DataFrame,
    threshold: float | Column,
    score: str = "anomaly_score",
    actual: str = "is_actual_anomaly",
    *extra: Column,
) -> DataFrame:
    """One row of counts and rates; a score equal to the threshold is an anomaly."""
    predicted = F.col(score) >= threshold
    actual_ = F.col(actual)
    return _rates(
        df.agg(
            F.count_if(predicted & actual_).alias("tp"),
            F.count_if(predicted & ~actual_).alias("fp"),
            F.count_if(~predicted & actual_).alias("fn"),
            F.count_if(~predicted & ~actual_).alias("tn"),
            *extra,
        )
    )


def threshold_candidates(
    df: DataFrame,
    score: str = "anomaly_score",
    actual: str = "is_actual_anomaly",
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Every distinct score as threshold with its confusion counts and rates.

    Counts per score come first (with map-side partials); a running sum from the highest score
    down then gives all confusions in O(n log n), in range-partitioned chunks when there are
    more distinct scores than one task should hold.
    """
    # The counts are read for the totals and for the sweep; the scores behind them, which may
    # come from a model, are computed once.
    per_score = stable(
        df.groupBy(F.col(score).alias("threshold"))
        .agg(F.count_if(F.col(actual)).alias("_pos"), F.count_if(~F.col(actual)).alias("_neg"))
        .filter(F.col("threshold").isNotNull())
        .withColumn("_down", -F.col("threshold"))
    )
    totals = per_score.agg(F.struct(F.sum("_pos").alias("p"), F.sum("_neg").alias("n")).alias("t"))
    swept = (
        OrderedRuns.of(per_score, [], ["_down"], max_rows)
        .running(tp=("sum", F.col("_pos")), fp=("sum", F.col("_neg")))
        .rows()
    )
    return _rates(
        swept.withColumn("_all", totals.scalar())
        .withColumn("fn", F.col("_all.p") - F.col("tp"))
        .withColumn("tn", F.col("_all.n") - F.col("fp"))
        .select("threshold", "tp", "fp", "fn", "tn")
    )


def select_threshold_max_f1(
    df: DataFrame,
    score: str = "anomaly_score",
    actual: str = "is_actual_anomaly",
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """The best threshold as one row: highest F1, then precision, then recall, then the
    smallest value. No row comes back for an empty input."""
    names = ("f1", "precision", "recall", "_small", "threshold", "tp", "fp", "fn", "tn")
    best = (
        threshold_candidates(df, score, actual, max_rows)
        .withColumn("_small", -F.col("threshold"))
        .agg(F.max(F.struct(*names)).alias("b"), F.count(F.lit(1)).alias("candidates_evaluated"))
    )
    return best.filter("candidates_evaluated > 0").select(
        *[F.col(f"b.{n}") for n in names if n != "_small"], "candidates_evaluated"
    )
