"""Canonical views over the supplied tables, so that each operator has whole tables to run on.

The expressions marked shared are plain SQL that Spark and the checking engine both read; they
only define the input data. Everything an operator computes is written separately for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.envelope import annotate_envelope, valid_rows
from tidemill.operators.ordered import OrderedRuns
from tidemill.operators.signal import time_domain_features
from tidemill.schema import LINE_HASH
from tidemill.session import apply_semantics

# Shared: columns of `telemetry` over (event_id, ts, user_id, event_type, value, k).
TELEMETRY = {
    "event_id": "CAST(event_id AS STRING)",
    "device_id": "'dev-' || CAST(user_id AS STRING)",
    "asset_type": "event_type",
    "priority": "CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'high' "
    "ELSE 'normal' END",
    "mode": "CASE event_type WHEN 'error' THEN 'EDGE_AUTONOMOUS' WHEN 'click' THEN 'HYBRID' "
    "WHEN 'purchase' THEN 'EDGE_ONLY' ELSE 'CLOUD_OPTIMISED' END",
    "ground_truth_label": "CASE WHEN k % 3 = 0 THEN 'normal' ELSE 'inner_race' END",
    "anomaly": "value > 60",
    "infer_ms": "value",
    "edge_confidence": "CASE WHEN k % 10 <> 0 THEN k / 100.0E0 END",
    "stats_total": "CAST(event_id + 1 AS INT)",
    "model_version": "CASE WHEN k % 7 <> 0 THEN 'v' || CAST(k % 2 AS STRING) END",
    "is_breach_sample": "k >= 80",
    "seq": "CAST(event_id AS INT)",
    "anomaly_score": "k / 128.0E0",
}

# Shared: columns of the sensor table over the same input.
SENSOR = {
    "event_id": "CAST(event_id AS STRING)",
    "device_id": "'dev-' || CAST(user_id AS STRING)",
    "source_file": "'rec-' || CAST(user_id AS STRING) || '.mat'",
    "ground_truth_label": "CASE user_id % 4 WHEN 0 THEN 'normal' WHEN 1 THEN 'inner_race' "
    "WHEN 2 THEN 'ball' ELSE 'outer_race' END",
    "seq": "CAST(event_id AS INT)",
    "window_idx": "CAST(event_id AS INT)",
    "sampling_rate_hz": "12000",
    "dataset_run_id": "'run-1'",
    "rms": "CASE WHEN k % 20 <> 0 THEN value END",
    "peak": "value + k",
    "crest": "k / 8.0E0",
    "kurtosis": "CASE WHEN k <> 50 THEN CAST(k % 7 AS DOUBLE) END",
    "skew": "k / 64.0E0",
    "variance": "value * 2",
    "mean_abs": "value / 2",
}

# Shared: JSON text over (event_id, user_id, event_type, k, cents, d, t); d = event_id % 17
# picks the defect.
_S = "CAST({} AS STRING)".format
_READING = (
    "CASE d WHEN 6 THEN '\"very high\"' WHEN 7 THEN 'null' ELSE " + _S("cents") + " END"
)
PAYLOAD = (
    "CASE event_type "
    "WHEN 'view' THEN '{\"seq\":' || " + _S("event_id") + " || ',\"file\":\"rec-' || "
    + _S("user_id") + " || '.mat\",\"label\":\"normal\",\"window_idx\":' || " + _S("k")
    + " || ',\"features\":{\"rms\":' || " + _READING + " || ',\"peak\":' || " + _S("k")
    + " || '}}' "
    "WHEN 'click' THEN '{\"seq\":' || " + _S("event_id")
    + " || ',\"anomaly\":' || CASE WHEN k > 50 THEN 'true' ELSE 'false' END || "
    "',\"infer_ms\":' || " + _READING + " || ',\"stats\":{\"total\":' || " + _S("event_id")
    + " || '}}' "
    "WHEN 'purchase' THEN '{\"from_mode\":\"A\",\"to_mode\":\"B\",\"rtt_ms\":' || " + _READING
    + " || ',\"breach_count\":' || " + _S("k") + " || '}' "
    "WHEN 'signup' THEN '{\"rtt_ms\":' || " + _READING + " || ',\"cpu_pct\":' || " + _S("k")
    + " || '}' "
    "ELSE '{\"vehicle_id\":\"v-' || " + _S("user_id") + " || '\",\"speed_kmh\":' || " + _S("k")
    + " || ',\"battery_voltage\":' || " + _READING + " || ',\"location\":{\"latitude\":' || "
    + _S("k") + " || '}}' END"
)
ASSET = (
    "CASE WHEN d = 5 THEN 'mystery_sensor' ELSE CASE event_type WHEN 'view' THEN 'bearing_sensor' "
    "WHEN 'click' THEN 'bearing_inference' WHEN 'purchase' THEN 'orchestrator_mode' "
    "WHEN 'signup' THEN 'context_snapshot' ELSE 'vehicle' END END"
)
BODY = (
    "'{' || CASE d WHEN 0 THEN '' WHEN 1 THEN '\"event_id\":\"\",' "
    "ELSE '\"event_id\":\"e-' || " + _S("event_id") + " || '\",' END || "
    "'\"device_id\":\"' || CASE WHEN d = 14 THEN '  ' ELSE 'dev-' || " + _S("user_id") + " END || "
    "'\",\"asset_type\":\"' || " + ASSET + " || '\",\"timestamp\":\"' || "
    "CASE WHEN d = 4 THEN 'not-a-real-timestamp' ELSE t END || '\"' || "
    "CASE d WHEN 9 THEN ',\"priority\":null' "
    "WHEN 10 THEN ',\"priority\":\"high\",\"schema_version\":\"2.0.0\"' ELSE '' END || "
    "CASE d WHEN 3 THEN ',\"payload\":\"text\"' WHEN 12 THEN '' "
    "ELSE ',\"payload\":' || " + PAYLOAD + " END || "
    "CASE d WHEN 2 THEN ',\"unexpected_field\":1' ELSE '' END || '}' || "
    "CASE d WHEN 8 THEN ' trailing' ELSE '' END"
)

SAMPLES_PER_WINDOW = 16

#: Two small trees over (k, value): tree, node, feature, split, left, right, size, depth.
GIVEN_TREES = (
    (0, 0, 0, 50.0, 1, 2, 16, 0), (0, 1, 1, 40.0, 3, 4, 9, 1), (0, 2, -1, 0.0, -1, -1, 7, 1),
    (0, 3, -1, 0.0, -1, -1, 1, 2), (0, 4, -1, 0.0, -1, -1, 8, 2),
    (1, 0, 1, 75.5, 1, 2, 16, 0), (1, 1, -1, 0.0, -1, -1, 14, 1), (1, 2, 0, 10.0, 3, 4, 2, 1),
    (1, 3, -1, 0.0, -1, -1, 1, 2), (1, 4, -1, 0.0, -1, -1, 1, 2),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return apply_semantics(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, often: bool = False) -> DataFrame:
    """The events with ``timestamp`` as an instant and ``k`` read from the properties.

    ``often``: many columns depend on ``k``, so it is read once per row behind ``inline``.
    Otherwise it stays an expression, which column pruning can drop.
    """
    k = "inline(array(from_json(props, 'k int')))" if often else "from_json(props, 'k int').k AS k"
    return table(spark, sf_dir, "events").selectExpr("*", "CAST(ts AS TIMESTAMP) AS timestamp", k)


def _bound(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select("timestamp", *[F.expr(e).alias(n) for n, e in columns.items()])


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bound(events(spark, sf_dir), TELEMETRY)


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bound(events(spark, sf_dir, often=True), SENSOR)


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as mode transitions."""
    return (
        events(spark, sf_dir)
        .filter("event_type = 'purchase'")
        .select(
            "timestamp",
            F.expr(TELEMETRY["event_id"]).alias("event_id"),
            F.expr(TELEMETRY["device_id"]).alias("device_id"),
            F.expr("'M' || CAST(k % 3 AS STRING)").alias("from_mode"),
            F.expr("'M' || CAST(k % 2 AS STRING)").alias("to_mode"),
            F.expr("'T' || CAST(k % 5 AS STRING)").alias("trigger"),
            F.col("value").alias("rtt_ms"),
            F.col("k").cast("double").alias("cpu_pct"),
            F.expr(TELEMETRY["edge_confidence"]).alias("edge_confidence"),
            F.col("k").alias("breach_count"),
            F.lit("p1").alias("policy_version"),
        )
    )


def validations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second opinions on every other escalated event."""
    return (
        events(spark, sf_dir)
        .filter("event_type = 'click' AND event_id % 2 = 0")
        .select(
            F.expr(TELEMETRY["event_id"]).alias("source_event_id"),
            F.expr("k > 40").alias("cloud_anomaly"),
            F.expr("(k > 40) = (value > 60)").alias("agrees_with_edge"),
            F.col("value").alias("validation_latency_ms"),
        )
    )


def dealt(rows: DataFrame) -> DataFrame:
    """The given table is one file with one row group; text made from it row by row comes, as from
    many landing files, to all tasks."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, "event_id")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with one defect or none each: (value, _source_file, _ingested_at).

    Every 17th event is sent a second time, later and from another file.
    """
    base = dealt(events(spark, sf_dir, often=True)).select(
        "event_id",
        "user_id",
        "event_type",
        "k",
        F.expr("CAST(round(value * 100) AS BIGINT)").alias("cents"),
        F.expr("event_id % 17").alias("d"),
        F.col("timestamp").alias("_at"),
    )
    timed = base.withColumn(
        "t", F.expr("date_format(CASE WHEN d = 13 THEN _at - INTERVAL 30 DAYS ELSE _at END, "
                    "\"yyyy-MM-dd'T'HH:mm:ss'Z'\")"),
    )
    # ``explode`` of one text keeps it from being put together again at every later use.
    texts = timed.select("*", F.explode(F.array(F.expr(BODY))).alias("value"))
    copies = texts.withColumn(
        "_copy", F.explode(F.when(F.col("d") == 11, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))))
    )
    return copies.select(
        "value",
        F.concat(F.lit("file-"), "_copy").alias("_source_file"),
        F.expr("_at + make_interval(0, 0, 0, 0, _copy, 0, k)").alias("_ingested_at"),
        F.col("_at").alias("received_at"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_lines(spark, sf_dir).withColumn(LINE_HASH, F.xxhash64("value"))
    return valid_rows(annotate_envelope(lines)).drop("value", "received_at")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of a part as its sample series."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("part-"), "l_partkey").alias("source_file"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        F.col("l_quantity").alias("value"),
    )
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "value"]
    numbered = OrderedRuns.of(lines, ["source_file"], order).running(
        _n=("sum", F.lit(1).cast("long"))
    )
    return numbered.rows().select("source_file", (F.col("_n") - 1).alias("sample_idx"), "value")


def window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the sample windows, labelled by part."""
    features = time_domain_features(samples(spark, sf_dir), SAMPLES_PER_WINDOW)
    return features.withColumn("ground_truth_label", F.expr(PART_LABEL))


# Shared: label of a part's series.
PART_LABEL = (
    "CASE CAST(substring(source_file, 6) AS BIGINT) % 4 WHEN 0 THEN 'normal' "
    "WHEN 1 THEN 'inner_race' WHEN 2 THEN 'ball' ELSE 'outer_race' END"
)
