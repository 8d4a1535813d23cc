"""Landing to gold in one composition of the operators."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemill.config import AssetConfig, discover_asset_configs
from tidemill.operators.features import bearing_ml_features, feature_quarantine
from tidemill.operators.gold import (
    asset_health_summary,
    cloud_egress,
    detection_performance,
    edge_autonomy,
    escalation_efficacy,
    mode_history,
)
from tidemill.operators.silver import clean_events, fan_out_assets, quarantine_events
from tidemill.session import scratch_path


@dataclass(frozen=True)
class Silver:
    cleaned: DataFrame
    quarantine: DataFrame
    tables: dict[str, DataFrame]


def silver(bronze: DataFrame, configs: Iterable[AssetConfig] | None = None) -> Silver:
    """Silver tables of a bronze table.

    ``cleaned`` is written once, partitioned by asset type: the rows are deduplicated in one
    shuffle, and each table, and each gold table after it, reads its own folder."""
    spark = bronze.sparkSession
    path = scratch_path(spark, "cleaned")
    rows = clean_events(bronze)
    rows.write.partitionBy("asset_type").parquet(path)
    cleaned = spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
    configs = discover_asset_configs() if configs is None else configs
    return Silver(cleaned, quarantine_events(bronze), fan_out_assets(cleaned, configs))


def gold(layer: Silver) -> dict[str, DataFrame]:
    """The gold tables of the shipped asset types, by name."""
    t = layer.tables
    inference = t["silver_bearing_inference_results"]
    sensor = t["silver_bearing_sensor_telemetry"]
    return {
        "asset_health_summary": asset_health_summary(layer.cleaned),
        "mode_history": mode_history(t["silver_orchestrator_mode"], t["silver_context_snapshot"]),
        "detection_performance": detection_performance(inference),
        "edge_autonomy": edge_autonomy(inference),
        "cloud_egress": cloud_egress(inference),
        "escalation_efficacy": escalation_efficacy(inference, t["silver_cloud_validation_results"]),
        "bearing_ml_features": bearing_ml_features(sensor),
        "bearing_ml_features_quarantine": feature_quarantine(sensor),
    }
