"""Upstream raw records to envelope rows.

``raw`` holds one JSON record per row in a VARIANT column ``raw``. Each translation returns
(envelope rows, rejects): a record lacking a needed field goes to the rejects with a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.ids import deterministic_event_id
from tidemill.schema import BRIDGE_NAMESPACE, ENVELOPE_FIELDS, NORMAL_LABEL

SCHEMA_VERSION = "1.0.0"


def parse_records(lines: DataFrame, body: str = "value") -> DataFrame:
    """Text lines to the VARIANT column the translations read (NULL when not JSON).

    ``inline`` keeps the optimizer from copying the parsing into every field lookup.
    """
    strict = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
    parsed = lines.selectExpr(
        f"{body} AS raw_body",
        f"inline(array(from_json('{{\"_raw\":' || {body} || '}}', '_raw variant', {strict})))",
    )
    whole = F.expr("json_array_length('[' || raw_body || ']') <=> 1")
    return parsed.select("raw_body", F.when(whole, F.col("_raw")).alias("raw"))


def field(name: str, spark_type: str = "string") -> Column:
    return F.expr(f"try_variant_get(raw, '$.{name}', '{spark_type}')")


def _translate(
    records: DataFrame,
    asset_type: str,
    subject: str,
    device: str,
    key_parts: Sequence[str],
    needed: Sequence[str],
    priority: Column,
    payload: Column,
) -> tuple[DataFrame, DataFrame]:
    missing = F.array_compact(F.array(*[F.when(field(n).isNull(), F.lit(n)) for n in needed]))
    checked = records.withColumn(
        "_reason",
        F.when(F.col("raw").isNull(), F.lit("invalid_json")).otherwise(
            F.when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ",")))
        ),
    )
    envelope = {
        "event_id": deterministic_event_id(
            BRIDGE_NAMESPACE, F.lit(subject), *[field(p) for p in key_parts]
        ),
        "device_id": field(device),
        "asset_type": F.lit(asset_type),
        "timestamp": field("ts"),
        "priority": priority,
        "schema_version": F.lit(SCHEMA_VERSION),
        "payload": payload,
    }
    rows = checked.filter(F.col("_reason").isNull()).select(
        *[envelope[n].alias(n) for n in ENVELOPE_FIELDS]
    )
    rejects = checked.filter(F.col("_reason").isNotNull()).select(
        "raw_body", F.col("_reason").alias("error_reason")
    )
    return rows, rejects


def _high_when(condition: Column) -> Column:
    return F.when(condition, F.lit("high")).otherwise(F.lit("normal"))


def translate_sensor(records: DataFrame, subject: str = "sensors.bearing"):
    return _translate(
        records, "bearing_sensor", subject, "sensor_id", ["sensor_id", "seq", "ts"],
        ["sensor_id", "seq", "ts", "label"],
        _high_when(field("label") != NORMAL_LABEL), F.col("raw"),
    )


def translate_inference(records: DataFrame, subject: str = "inference.bearing"):
    return _translate(
        records, "bearing_inference", subject, "sensor_id", ["sensor_id", "seq", "ts"],
        ["sensor_id", "seq", "ts", "anomaly"],
        _high_when(field("anomaly", "boolean")), F.col("raw"),
    )


def translate_mode_transition(records: DataFrame, subject: str = "orchestrator.mode"):
    return _translate(
        records, "orchestrator_mode", subject, "device_id",
        ["device_id", "from_mode", "to_mode", "ts"],
        ["device_id", "from_mode", "to_mode", "ts"],
        F.lit("high"), F.col("raw"),
    )


def translate_context(records: DataFrame, subject: str = "context.snapshot"):
    """The payload gets ``is_breach_sample``, taken from the record's own ``breach`` flag."""
    stamp = F.to_variant_object(F.array(F.coalesce(field("breach", "boolean"), F.lit(False))))
    entries = F.expr("try_variant_get(raw, '$', 'map<string,variant>')")
    payload = F.to_variant_object(
        F.map_concat(
            F.map_filter(entries, lambda key, _: key != "is_breach_sample"),
            F.create_map(F.lit("is_breach_sample"), F.variant_get(stamp, "$[0]", "variant")),
        )
    )
    return _translate(
        records, "context_snapshot", subject, "device_id", ["device_id", "ts"],
        ["device_id", "ts"], F.lit("normal"), payload,
    )
