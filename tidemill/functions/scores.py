"""Score, bucket and outcome expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.schema import NORMAL_LABEL, SCORE_STEEPNESS


def anomaly_score(raw: Column, steepness: float = SCORE_STEEPNESS) -> Column:
    """Map a decision value (higher = normal) to (0, 1), higher = more anomalous."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(raw * F.lit(steepness)))


def bucket_confidence(confidence: Column) -> Column:
    return (
        F.when(confidence.isNull(), "unknown")
        .when(confidence < 0.5, "low")
        .when(confidence < 0.8, "medium")
        .otherwise("high")
    )


def is_actual_anomaly(label: Column) -> Column:
    return label != F.lit(NORMAL_LABEL)


def confusion_outcome(predicted: Column, actual: Column) -> Column:
    """TP/FP/FN/TN; a NULL on either side falls through to TN."""
    return (
        F.when(predicted & actual, "TP")
        .when(predicted & ~actual, "FP")
        .when(~predicted & actual, "FN")
        .otherwise("TN")
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    """Exact to the microsecond, which epoch seconds as doubles are not."""
    return (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000


def mean_seconds(seconds: Column) -> Column:
    """Average of spans of time in seconds, exact to the microsecond, halves up.

    Whole microseconds are added and divided as integers: no order of addition and no engine's
    rounding of doubles shows in the result."""
    micros = F.round(seconds * 1_000_000).cast("long")
    n = F.count(micros)
    doubled, parts = F.sum(micros) * 2 + n, n * 2
    return F.when(n > 0, (doubled - F.pmod(doubled, parts)) / F.nullif(parts, F.lit(0)) / 1_000_000)
