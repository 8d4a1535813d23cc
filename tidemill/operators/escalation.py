"""Asynchronous second opinion on escalated decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.ids import deterministic_event_id
from tidemill.operators.silver import dedup_latest
from tidemill.schema import (
    ENVELOPE_FIELDS,
    ESCALATION_MODE,
    FEATURES,
    UNVERSIONED,
    VALIDATION_NAMESPACE,
    VALIDATION_THRESHOLD,
)


def pending_escalations(
    inference: DataFrame, validated: DataFrame, mode: str = ESCALATION_MODE
) -> DataFrame:
    """Escalated decisions without a second opinion yet."""
    done = validated.select(F.col("source_event_id").alias("event_id"))
    return inference.filter(F.col("mode") == mode).join(done, "event_id", "left_anti")


def attach_features(
    pending: DataFrame, sensor: DataFrame, features: tuple[str, ...] = FEATURES
) -> DataFrame:
    """Join the feature vector by (device_id, seq), the newest sensor row of each pair."""
    newest = dedup_latest(sensor, ["device_id", "seq"], ["timestamp", "event_id"])
    return pending.join(newest.select("device_id", "seq", *features), ["device_id", "seq"])


def build_validation_events(
    scored: DataFrame,
    model_version: str,
    threshold: float = VALIDATION_THRESHOLD,
    latency_ms: Column | float = 0.0,
    at: Column | None = None,
) -> DataFrame:
    """Envelope rows of the second opinion; ``scored`` carries ``cloud_score``.

    Here a score must *exceed* the threshold. The id depends on the source event alone, so a
    repeated run produces the same events and deduplication removes them.
    """
    decided = scored.withColumn("cloud_anomaly", F.col("cloud_score") > threshold).withColumn(
        "agrees_with_edge", F.col("cloud_anomaly") == F.coalesce("anomaly", F.lit(False))
    )
    latency = latency_ms if isinstance(latency_ms, Column) else F.lit(float(latency_ms))
    version = F.coalesce(F.nullif(F.col("model_version"), F.lit("")), F.lit(UNVERSIONED))
    payload = F.struct(
        F.col("event_id").alias("source_event_id"),
        F.coalesce("anomaly", F.lit(False)).alias("edge_anomaly"),
        F.col("anomaly_score").alias("edge_score"),
        F.col("edge_confidence"),
        F.col("cloud_anomaly"),
        F.col("cloud_score"),
        F.when(F.col("cloud_anomaly"), "anomaly").otherwise("normal").alias("cloud_decision"),
        F.col("agrees_with_edge"),
        version.alias("edge_model_version"),
        F.lit(model_version).alias("cloud_model_version"),
        latency.alias("validation_latency_ms"),
        F.col("mode"),
    )
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    envelope = {
        "event_id": deterministic_event_id(VALIDATION_NAMESPACE, "event_id"),
        "device_id": F.col("device_id"),
        "asset_type": F.lit("cloud_validation"),
        "timestamp": now if at is None else at,
        "priority": F.when(~F.col("agrees_with_edge"), "high").otherwise("normal"),
        "schema_version": F.lit("1.0.0"),
        "payload": F.to_variant_object(payload),
    }
    return decided.select(*[envelope[n].alias(n) for n in ENVELOPE_FIELDS])
