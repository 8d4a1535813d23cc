"""Every operator as a query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, TimestampType

from tidemill.config import load_asset_config
from tidemill.functions.expectations import violations
from tidemill.functions.ids import deterministic_event_id
from tidemill.functions.scores import anomaly_score, bucket_confidence
from tidemill.operators import egress, escalation, features, forest, gold, monitoring, signal
from tidemill.operators.envelope import (
    annotate_envelope,
    reject_rows,
    replay_dead_letters,
    valid_rows,
    validate_envelope,
)
from tidemill.operators.heartbeat import heartbeat_downsample
from tidemill.operators.rank import exact_quantile
from tidemill.operators.silver import (
    clean_events,
    dedup_latest,
    flatten_payload,
    quarantine_events,
    select_valid,
)
from tidemill.operators.threshold import confusion_at_threshold, select_threshold_max_f1
from tidemill.operators.tracker import parse_tracker_packets
from tidemill.operators.translate import (
    parse_records,
    translate_context,
    translate_inference,
    translate_mode_transition,
    translate_sensor,
)
from tidemill.plans import bindings as b
from tidemill.plans import lifecycle
from tidemill.plans.medallion import gold as gold_tables, silver
from tidemill.schema import BRIDGE_NAMESPACE, LINE_HASH
from tidemill.session import scratch_path, stable
from tidemill.sources.landing import (
    bronze_from_landing,
    read_dead_letters,
    read_landing,
    write_dead_letters,
    write_landing,
)
from tidemill.sources.tables import compact_small_files, compact_table, read_current, read_table, write_gold
from tidemill.streaming.heartbeat import read_heartbeats, stream_heartbeat_downsample
from tidemill.streaming.ingest import stream_ingest, stream_to_landing
from tidemill.streaming.monitors import (
    read_dlq_volume,
    read_gap_alarms,
    read_ingest_windows,
    read_lag_alarms,
    stream_dlq_volume,
    stream_ingest_windows,
)
from tidemill.streaming.upsert import read_upserted, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ENVELOPE_TEXT = ["event_id", "device_id", "asset_type", "timestamp", "priority", "schema_version"]
DAY_SECONDS = 86400.0


def query(make: Query) -> Query:
    """Register under the function's name, with results in plain comparable types."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(make(spark, sf_dir))

    QUERIES[make.__name__] = run
    return make


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places, instants to UTC wall time, integers to 64 bits."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, IntegerType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


# -- landing ------------------------------------------------------------------


@query
def envelope_valid(spark, sf_dir):
    valid, _ = validate_envelope(b.raw_lines(spark, sf_dir))
    return valid.select(*ENVELOPE_TEXT, "_source_file")


@query
def envelope_rejects(spark, sf_dir):
    _, rejects = validate_envelope(b.raw_lines(spark, sf_dir))
    return rejects.select("raw_body", "error_reason")


@query
def envelope_defaults(spark, sf_dir):
    valid = valid_rows(annotate_envelope(b.raw_lines(spark, sf_dir)))
    empty = F.to_json("payload") == "{}"
    return valid.groupBy("priority", "schema_version", empty.alias("empty_payload")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def dead_letter_records(spark, sf_dir):
    path = scratch_path(spark, "landing")
    write_dead_letters(_rejects(spark, sf_dir), path)
    return read_dead_letters(spark, path)


def _rejects(spark, sf_dir):
    annotated = annotate_envelope(b.raw_lines(spark, sf_dir))
    return reject_rows(annotated, at=F.col("received_at"))


@query
def dead_letter_replay(spark, sf_dir):
    repair = F.regexp_replace("raw_body", '"priority":null', '"priority":"low"')
    valid, still = replay_dead_letters(_rejects(spark, sf_dir), repair)
    recovered = valid.select("event_id", "priority", F.lit("recovered").alias("outcome"))
    return recovered.unionByName(
        still.select(
            F.lit(None).cast("string").alias("event_id"),
            F.lit(None).cast("string").alias("priority"),
            F.col("error_reason").alias("outcome"),
        )
    )


@query
def landing_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "landing")
    valid, rejects = validate_envelope(b.raw_lines(spark, sf_dir))
    write_landing(valid, path)
    write_dead_letters(rejects, path)
    return bronze_from_landing(read_landing(spark, path)).select(
        *ENVELOPE_TEXT, F.expr("try_variant_get(payload, '$.seq', 'bigint')").alias("seq")
    )


@query
def stream_ingest_availablenow(spark, sf_dir):
    root = scratch_path(spark, "stream")
    b.raw_lines(spark, sf_dir).select("value").write.text(f"{root}/incoming")
    incoming = spark.readStream.format("text").load(f"{root}/incoming")
    stream_to_landing(incoming, f"{root}/landing", f"{root}/landing-progress").awaitTermination()
    stream_ingest(
        spark, f"{root}/landing", f"{root}/bronze", f"{root}/bronze-progress"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/bronze").select(*ENVELOPE_TEXT)


@query
def table_scan(spark, sf_dir):
    return read_table(
        spark,
        f"{sf_dir}/lineitem.parquet",
        ["l_orderkey", "l_linenumber", "l_quantity"],
        "l_shipdate >= DATE '1998-01-01' AND l_quantity > 45",
    )


@query
def published_table(spark, sf_dir):
    rows = gold.detection_performance(b.telemetry(spark, sf_dir))
    expectations = {"counts_add_up": "tp + fp + fn + tn = n_events", "named": "mode IS NOT NULL"}
    return write_gold(rows, scratch_path(spark, "gold"), expectations)


@query
def compacted_table_equals_source(spark, sf_dir):
    table = scratch_path(spark, "table")
    rows = b.events(spark, sf_dir).select("event_id", "user_id", "timestamp", "value")
    write_gold(rows.repartition(24, "event_id"), table)
    compact_table(spark, table, ["user_id", "timestamp"])
    return read_current(spark, table)


@query
def small_files_merged_equals_source(spark, sf_dir):
    table = scratch_path(spark, "table")
    rows = b.events(spark, sf_dir).select("event_id", "user_id", "timestamp", "value")
    write_gold(rows.repartition(24, "event_id"), table)
    return compact_small_files(spark, table)


# -- translation --------------------------------------------------------------


@query
def deterministic_event_ids(spark, sf_dir):
    e = b.events(spark, sf_dir)
    new = deterministic_event_id(BRIDGE_NAMESPACE, F.lit("é"), "event_type", "user_id", "event_id")
    return e.select("event_id", new.alias("uuid"))


def _records(spark, sf_dir):
    """Raw records as JSON text; every eleventh lacks the field named by its translation."""
    e = b.dealt(b.events(spark, sf_dir, often=True)).withColumn("lacking", F.expr("event_id % 11 = 0"))
    t = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    device = F.concat(F.lit("dev-"), "user_id")
    record = F.struct(
        t.alias("ts"),
        F.col("event_id").alias("seq"),
        device.alias("sensor_id"),
        device.alias("device_id"),
        F.when(~F.col("lacking"), F.expr(b.TELEMETRY["ground_truth_label"])).alias("label"),
        F.when(~F.col("lacking"), F.col("value") > 60).alias("anomaly"),
        F.when(~F.col("lacking"), "A").alias("from_mode"),
        F.lit("B").alias("to_mode"),
        (F.col("k") >= 80).alias("breach"),
        F.col("k").alias("rtt_ms"),
    )
    return parse_records(e.select(F.explode(F.array(F.to_json(record))).alias("value")))


def _translated(rows, path, spark_type):
    return rows.select(
        *ENVELOPE_TEXT, F.expr(f"try_variant_get(payload, '$.{path}', '{spark_type}')").alias(path)
    )


@query
def translate_sensor_records(spark, sf_dir):
    return _translated(translate_sensor(_records(spark, sf_dir))[0], "label", "string")


@query
def translate_inference_records(spark, sf_dir):
    return _translated(translate_inference(_records(spark, sf_dir))[0], "anomaly", "boolean")


@query
def translate_mode_records(spark, sf_dir):
    return _translated(translate_mode_transition(_records(spark, sf_dir))[0], "to_mode", "string")


@query
def translate_context_records(spark, sf_dir):
    rows = translate_context(_records(spark, sf_dir))[0]
    return _translated(rows, "is_breach_sample", "boolean")


@query
def malformed_raw_rejects(spark, sf_dir):
    records = _records(spark, sf_dir)
    out = None
    for translate in (translate_sensor, translate_inference, translate_mode_transition):
        one = translate(records)[1].groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def _snapshots(spark, sf_dir):
    return b.events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("dev-"), "user_id").alias("device_id"),
        "timestamp",
        (F.col("k") >= 95).alias("breach"),
    )


@query
def heartbeat_downsampled(spark, sf_dir):
    """One sample a day suits the density of the events."""
    return heartbeat_downsample(_snapshots(spark, sf_dir), interval=DAY_SECONDS)


@query
def stream_heartbeats(spark, sf_dir):
    """The same from a stream over the events, in several batches in no order of time."""
    root = scratch_path(spark, "heartbeats")
    _snapshots(spark, sf_dir).repartition(3, "event_id").write.parquet(f"{root}/in")
    source = spark.readStream.schema(_snapshots(spark, sf_dir).schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    stream_heartbeat_downsample(source, root, f"{root}/progress", interval=DAY_SECONDS).awaitTermination()
    return read_heartbeats(spark, root).select("event_id", "device_id", "timestamp", "breach")


def _packets(spark, sf_dir):
    """Tracker lines: positions, keep-alives, logins, blanks, junk and broken numbers."""
    e = b.events(spark, sf_dir, often=True)
    position = F.concat(
        F.lit("$$76,8652800"), F.lpad(F.col("user_id").cast("string"), 8, "0"), F.lit(",AAA,"),
        F.date_format("timestamp", "yyMMdd,HHmmss"), F.lit(","),
        F.expr("CAST(k AS STRING) || '.5,' || CASE WHEN k % 2 = 0 THEN 'N' ELSE 'S' END"),
        F.lit(","),
        F.expr("CAST(user_id AS STRING) || '.25,' || CASE WHEN k % 3 = 0 THEN 'E' ELSE 'W' END"),
        F.lit(","), F.col("k").cast("string"), F.lit(".0,"), F.col("k").cast("string"),
        F.expr("',' || CAST(k % 2 AS STRING) || ',12,1.2*AB'"),
    )
    d = F.col("event_id") % 13
    line = (
        F.when(d == 0, "$$10,865280000000001,HBT*00")
        .when(d == 1, "$$10,865280000000001,log")
        .when(d == 2, "   ")
        .when(d == 3, F.concat(F.lit("junk-"), "event_id"))
        .when(d == 4, F.regexp_replace(position, r"\.5,", ".5.5,"))
        .when(d == 5, F.concat(F.lit("  "), position, F.lit("\r")))
        .otherwise(position)
    )
    return e.select(F.explode(F.array(line)).alias("value"))


@query
def tracker_packets(spark, sf_dir):
    rows, _ = parse_tracker_packets(_packets(spark, sf_dir))
    get = lambda n, t: F.expr(f"try_variant_get(payload, '$.{n}', '{t}')").alias(n)
    return rows.select(
        "device_id",
        "timestamp",
        get("imei", "string"),
        get("latitude", "double"),
        get("longitude", "double"),
        get("speed_kmh", "double"),
        get("course_deg", "double"),
        get("gps_valid", "boolean"),
    )


@query
def tracker_rejects(spark, sf_dir):
    return parse_tracker_packets(_packets(spark, sf_dir))[1]


# -- silver -------------------------------------------------------------------


@query
def expectations_summary(spark, sf_dir):
    return violations(
        b.telemetry(spark, sf_dir),
        {
            "has_confidence": "edge_confidence IS NOT NULL",
            "confident": "edge_confidence >= 0.5",
            "fast": "infer_ms < 100",
            "known_mode": "mode IN ('HYBRID', 'EDGE_ONLY', 'EDGE_AUTONOMOUS', 'CLOUD_OPTIMISED')",
        },
    )


@query
def clean_events_table(spark, sf_dir):
    return clean_events(b.bronze(spark, sf_dir)).select(*ENVELOPE_TEXT, "_source_file")


@query
def dedup_latest_rows(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate"] + [c for c in lines.columns if c not in (*keys, "l_shipdate")]
    return dedup_latest(lines, keys, order)


@query
def stream_upsert_latest(spark, sf_dir):
    """The newest row of each key from a stream of files whose rows come in no order."""
    root = scratch_path(spark, "upsert")
    lines = b.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate"] + [c for c in lines.columns if c not in (*keys, "l_shipdate")]
    lines.repartition(3, "l_partkey").write.parquet(f"{root}/in")
    source = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    stream_upsert(source, f"{root}/table", f"{root}/progress", keys, order, buckets=16).awaitTermination()
    return read_upserted(spark, f"{root}/table", lines.schema)


@query
def quarantine_events_table(spark, sf_dir):
    return quarantine_events(b.bronze(spark, sf_dir)).select(
        "event_id", "device_id", "timestamp", F.array_join("_quarantine_reason", ",").alias("reasons")
    )


@query
def flatten_payload_table(spark, sf_dir):
    cleaned = clean_events(b.bronze(spark, sf_dir))
    return flatten_payload(cleaned, load_asset_config("bearing_sensor")).select(
        "event_id", "device_id", "timestamp", "seq", "source_file", "ground_truth_label",
        "window_idx", "rms", "peak", "crest", "sampling_rate_hz",
    )


@query
def flatten_all_types(spark, sf_dir):
    """Every flattened table, each row with the number of filled payload columns."""
    out = None
    for name, df in silver(b.bronze(spark, sf_dir)).tables.items():
        filled = [F.col(c).isNotNull().cast("bigint") for c in df.columns[len(ENVELOPE_TEXT):]]
        total = F.lit(0).cast("bigint")
        for c in filled:
            total = total + c
        one = df.select(F.lit(name).alias("silver_table"), "event_id", total.alias("filled"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def layer_reconciliation(spark, sf_dir):
    """Rows per event id in every layer, of which only ids are read; dead letters without an id
    that can be told are a row of their own."""
    root = scratch_path(spark, "layers")
    lines = b.raw_lines(spark, sf_dir).withColumn(LINE_HASH, F.xxhash64("value"))
    annotated = annotate_envelope(lines)
    annotated.drop("received_at").withColumn("value", F.when(~F.col("_valid"), F.col("value"))).write.parquet(f"{root}/annotated")
    stored = spark.read.parquet(f"{root}/annotated")
    bronze = valid_rows(stored).drop("value")
    layer = silver(bronze)
    return monitoring.layer_reconciliation(
        {
            "dead_letters": monitoring.dead_letter_ids(stored.filter("NOT _valid"), "value"),
            "bronze": bronze,
            "valid": select_valid(bronze),
            "cleaned": layer.cleaned,
            "quarantined": layer.quarantine,
            "flattened": layer.tables["silver_bearing_sensor_telemetry"],
        }
    )


@query
def medallion_gold_counts(spark, sf_dir):
    """Landing to gold: the rows of each gold table."""
    path = scratch_path(spark, "landing")
    write_landing(valid_rows(annotate_envelope(b.raw_lines(spark, sf_dir))), path)
    layer = silver(bronze_from_landing(read_landing(spark, path)))
    out = None
    for name, df in gold_tables(layer).items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("gold_table"), "n")
        out = one if out is None else out.unionByName(one)
    return out


# -- gold ---------------------------------------------------------------------


@query
def asset_health_summary(spark, sf_dir):
    return gold.asset_health_summary(b.telemetry(spark, sf_dir))


def _modes(spark, sf_dir):
    return b.transitions(spark, sf_dir).withColumn("transition_at", F.col("timestamp"))


@query
def time_in_previous_mode(spark, sf_dir):
    return gold.time_in_previous_mode(_modes(spark, sf_dir)).select(
        "event_id", "device_id", "transition_at", "time_in_previous_mode_s"
    )


@query
def asof_latest_breach(spark, sf_dir):
    return gold.asof_latest_breach(_modes(spark, sf_dir), b.telemetry(spark, sf_dir)).select(
        "event_id", "device_id", "transition_at", "latest_breach_at"
    )


@query
def mode_history(spark, sf_dir):
    return gold.mode_history(b.transitions(spark, sf_dir), b.telemetry(spark, sf_dir))


@query
def mode_trigger_breakdown(spark, sf_dir):
    return gold.mode_trigger_breakdown(
        gold.mode_history(b.transitions(spark, sf_dir), b.telemetry(spark, sf_dir))
    )


@query
def confusion_outcome(spark, sf_dir):
    return gold.with_outcome(b.telemetry(spark, sf_dir)).select("event_id", "mode", "outcome")


@query
def detection_performance(spark, sf_dir):
    return gold.detection_performance(b.telemetry(spark, sf_dir))


@query
def state_sessions(spark, sf_dir):
    return gold.sessions_by_state(
        b.telemetry(spark, sf_dir), "device_id", "timestamp", "mode"
    ).select("event_id", "device_id", "mode", "window_id", "gap_s")


@query
def edge_autonomy(spark, sf_dir):
    return gold.edge_autonomy(b.telemetry(spark, sf_dir))


@query
def cloud_egress(spark, sf_dir):
    return gold.cloud_egress(b.telemetry(spark, sf_dir))


@query
def confidence_buckets(spark, sf_dir):
    t = b.telemetry(spark, sf_dir)
    return t.groupBy("mode", bucket_confidence(F.col("edge_confidence")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def escalation_efficacy(spark, sf_dir):
    return gold.escalation_efficacy(b.telemetry(spark, sf_dir), b.validations(spark, sf_dir))


# -- features -----------------------------------------------------------------


@query
def feature_validity(spark, sf_dir):
    return features.feature_validity(b.sensor(spark, sf_dir)).select(
        "event_id", "missing_columns", "is_valid"
    )


@query
def feature_quarantine(spark, sf_dir):
    return features.feature_quarantine(b.sensor(spark, sf_dir)).drop("quarantined_at")


@query
def recording_split(spark, sf_dir):
    return features.assign_recording_split(b.sensor(spark, sf_dir))


@query
def split_windows(spark, sf_dir):
    rows = b.sensor(spark, sf_dir)
    return features.broadcast_split(rows, features.assign_recording_split(rows)).select(
        "event_id", "source_file", "ground_truth_label", "dataset_split"
    )


@query
def trend_features(spark, sf_dir):
    return features.trend_features(
        features.feature_validity(b.sensor(spark, sf_dir)).filter("is_valid")
    ).select(
        "event_id",
        "rms_roll_mean_5",
        "rms_roll_std_5",
        "rms_delta_1",
        "kurtosis_roll_mean_5",
        "window_position",
        "trend_window_complete",
    )


@query
def training_eligibility(spark, sf_dir):
    rows = b.sensor(spark, sf_dir)
    split = features.broadcast_split(rows, features.assign_recording_split(rows))
    return (
        features.training_eligibility(split)
        .groupBy("dataset_split", "is_actual_anomaly", "is_training_eligible")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def bearing_ml_features(spark, sf_dir):
    return features.bearing_ml_features(b.sensor(spark, sf_dir)).drop("generated_at")


# -- signal -------------------------------------------------------------------


@query
def segment_windows(spark, sf_dir):
    windows = signal.segment_windows(b.samples(spark, sf_dir), b.SAMPLES_PER_WINDOW)
    text = F.array_join(F.transform("waveform", lambda v: v.cast("int").cast("string")), ",")
    return windows.select("source_file", "window_idx", text.alias("samples"))


@query
def time_domain_features(spark, sf_dir):
    return signal.time_domain_features(b.samples(spark, sf_dir), b.SAMPLES_PER_WINDOW)


@query
def waveform_features(spark, sf_dir):
    return signal.waveform_features(b.table(spark, sf_dir, "embeddings"), "embedding").drop(
        "embedding"
    )


def _files(spark, sf_dir):
    prefix = (
        "CASE user_id % 5 WHEN 0 THEN 'normal' WHEN 1 THEN 'inner_race' WHEN 2 THEN 'ball' "
        "WHEN 3 THEN 'outer_race' ELSE 'other' END"
    )
    return b.events(spark, sf_dir).select(
        "event_id",
        F.expr(f"{prefix} || '_' || CAST(user_id AS STRING) || '.mat'").alias("source_file"),
    )


@query
def label_from_prefix(spark, sf_dir):
    return _files(spark, sf_dir).select(
        "event_id", "source_file", signal.label_from_prefix(F.col("source_file")).alias("label")
    )


@query
def pick_channel(spark, sf_dir):
    variables = b.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("cust-"), "o_custkey").alias("source_file"),
        F.expr(
            "'X' || CAST(o_orderkey AS STRING) || "
            "CASE WHEN o_orderkey % 3 = 0 THEN '_FE_time' ELSE '_DE_time' END"
        ).alias("variable"),
    )
    chosen, none = signal.pick_channel(variables)
    return chosen.unionByName(none, allowMissingColumns=True)


@query
def windows_to_events(spark, sf_dir):
    records = signal.windows_to_records(
        b.window_features(spark, sf_dir), "run-1", "bearing.1", "2027-03-02 04:30:00"
    )
    rows, _ = translate_sensor(records)
    get = lambda n, t: F.expr(f"try_variant_get(payload, '$.{n}', '{t}')")
    return rows.select(
        "event_id",
        "timestamp",
        "priority",
        get("seq", "bigint").alias("seq"),
        get("file", "string").alias("source_file"),
        get("window_idx", "bigint").alias("window_idx"),
        get("features.rms", "double").alias("rms"),
        get("dataset_run_id", "string").alias("dataset_run_id"),
    )


@query
def recording_summary(spark, sf_dir):
    labelled = b.samples(spark, sf_dir).withColumn("ground_truth_label", F.expr(b.PART_LABEL))
    counted = labelled.groupBy("source_file", "ground_truth_label").agg(
        F.count(F.lit(1)).alias("n_samples")
    )
    split = features.assign_recording_split(counted)
    return signal.recording_summary(
        features.broadcast_split(counted, split), b.SAMPLES_PER_WINDOW
    )


# -- models -------------------------------------------------------------------


@query
def isolation_forest_scores(spark, sf_dir):
    rows = signal.waveform_features(b.table(spark, sf_dir, "embeddings"), "embedding")
    grown = forest.fit_isolation_forest(rows.filter("label = 0"), key="vec_id")
    raw = forest.score_isolation_forest(grown)
    return rows.select("vec_id", "label", raw.alias("decision")).withColumn(
        "anomaly_score", anomaly_score(F.col("decision"))
    )


@query
def forest_samples(spark, sf_dir):
    """The rows that each of 20 trees is grown from."""
    rows = b.table(spark, sf_dir, "embeddings").select("vec_id")
    return forest.tree_samples(rows, "vec_id", 20, 32, 7, rows.count()).select("tree", "vec_id")


@query
def forest_path_lengths(spark, sf_dir):
    """Decision values of the events in given trees, whose paths SQL can follow too."""
    nodes = spark.createDataFrame(b.GIVEN_TREES, forest.NODE_SCHEMA)
    given = forest.Forest(nodes, ("k", "value"), 16, -0.5)
    rows = b.events(spark, sf_dir).select("event_id", "k", "value")
    return rows.select("event_id", forest.score_isolation_forest(given).alias("decision"))


@query
def anomaly_scores(spark, sf_dir):
    raw = (F.col("value") - 50) / 128
    return b.events(spark, sf_dir).select("event_id", anomaly_score(raw).alias("anomaly_score"))


def _scored(spark, sf_dir):
    return b.telemetry(spark, sf_dir).select(
        "event_id",
        "device_id",
        (F.col("infer_ms") / 1000).alias("anomaly_score"),
        (F.col("ground_truth_label") != "normal").alias("is_actual_anomaly"),
    )


@query
def confusion_at_fixed_threshold(spark, sf_dir):
    return confusion_at_threshold(_scored(spark, sf_dir), 0.06)


@query
def select_threshold(spark, sf_dir):
    return select_threshold_max_f1(_scored(spark, sf_dir))


#: A given score, so that the model jobs can be checked exactly.
GIVEN_SCORE = "rms / 1000"


def _frozen(spark, sf_dir):
    """(feature table, models folder) after a threshold was frozen for the given score."""
    path = scratch_path(spark, "features")
    features.bearing_ml_features(b.sensor(spark, sf_dir)).write.parquet(path)
    rows = spark.read.parquet(path)
    lifecycle.freeze_threshold(rows, "run-1", f"{path}-models", "given", F.expr(GIVEN_SCORE))
    return rows, f"{path}-models"


@query
def train_rows(spark, sf_dir):
    rows = features.bearing_ml_features(b.sensor(spark, sf_dir))
    return lifecycle.train_reader(rows, "run-1").select("event_id", "source_file", "window_idx", "rms")


@query
def frozen_threshold(spark, sf_dir):
    _, models = _frozen(spark, sf_dir)
    return spark.read.parquet(f"{models}/given/threshold").drop("feature_columns")


@query
def evaluate_frozen(spark, sf_dir):
    """Threshold from VALIDATION, one confusion on TEST."""
    rows, models = _frozen(spark, sf_dir)
    return lifecycle.evaluate_frozen(rows, models, "given", F.expr(GIVEN_SCORE)).drop("run_id")


@query
def second_opinion_loop(spark, sf_dir):
    """Second opinions go to the landing and come back through silver; a second run adds nothing."""
    path = scratch_path(spark, "opinions")
    inference, sensor = b.telemetry(spark, sf_dir), b.sensor(spark, sf_dir)
    done = b.validations(spark, sf_dir)
    for _ in range(2):
        lifecycle.run_second_opinion(spark, inference, done, sensor, F.expr(GIVEN_SCORE), "second-v1", path)
    rows = clean_events(bronze_from_landing(read_landing(spark, path)))
    table = flatten_payload(rows, load_asset_config("cloud_validation"))
    return table.select("event_id", "source_event_id", "cloud_score", "cloud_decision", "agrees_with_edge",
                        (F.col("validation_latency_ms") > 0).alias("latency_measured"))


@query
def pending_escalations(spark, sf_dir):
    return escalation.pending_escalations(
        b.telemetry(spark, sf_dir), b.validations(spark, sf_dir)
    ).select("event_id", "device_id", "seq")


@query
def attach_features(spark, sf_dir):
    pending = escalation.pending_escalations(
        b.telemetry(spark, sf_dir), b.validations(spark, sf_dir)
    ).select("event_id", "device_id", "seq")
    return escalation.attach_features(pending, b.sensor(spark, sf_dir))


@query
def validation_events(spark, sf_dir):
    pending = escalation.pending_escalations(
        b.telemetry(spark, sf_dir), b.validations(spark, sf_dir)
    ).withColumn("cloud_score", F.col("infer_ms") / 100)
    rows = escalation.build_validation_events(
        pending, "second-v1", latency_ms=F.col("infer_ms") * 2, at=F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    get = lambda n, t: F.expr(f"try_variant_get(payload, '$.{n}', '{t}')").alias(n)
    return rows.select(
        "event_id", "device_id", "asset_type", "timestamp", "priority",
        get("source_event_id", "string"), get("edge_anomaly", "boolean"),
        get("edge_score", "double"), get("edge_confidence", "double"), get("cloud_score", "double"),
        get("cloud_decision", "string"), get("agrees_with_edge", "boolean"),
        get("edge_model_version", "string"), get("cloud_model_version", "string"),
        get("validation_latency_ms", "double"), get("mode", "string"),
    )


def _sized(spark, sf_dir):
    rows = b.events(spark, sf_dir).withColumn("waveform", F.sequence(F.lit(1), F.col("k") + 1))
    return egress.payload_bytes(rows, ["event_id", "user_id", "event_type", "k"], limit=200)


@query
def payload_bytes(spark, sf_dir):
    return _sized(spark, sf_dir).select(
        "event_id", "stats_only_bytes", "stats_plus_waveform_bytes", "waveform_bytes",
        "waveform_share", "overhead_ratio", "bytes_per_sample", "within_limit",
    )


@query
def projected_egress(spark, sf_dir):
    return egress.projected_egress(_sized(spark, sf_dir), [0.0, 0.05, 0.2, 0.6, 1.0])


# -- monitoring ---------------------------------------------------------------


@query
def exact_quantiles(spark, sf_dir):
    """Order statistics as the forest's threshold takes them, over all prices."""
    lines = b.table(spark, sf_dir, "lineitem")
    rows = [(q, exact_quantile(lines, "l_extendedprice", q)) for q in (0.001, 0.01, 0.1, 0.5, 0.999)]
    return spark.createDataFrame(rows, "share double, price double")


@query
def dlq_volume(spark, sf_dir):
    return monitoring.dlq_volume(_rejects(spark, sf_dir), width="6 hours")


@query
def stream_dead_letter_volume(spark, sf_dir):
    root = scratch_path(spark, "dlq-stream")
    rejects = _rejects(spark, sf_dir)
    rejects.write.parquet(f"{root}/in")
    source = spark.readStream.schema(rejects.schema).parquet(f"{root}/in")
    stream_dlq_volume(source, f"{root}/counts", f"{root}/progress", width="6 hours").awaitTermination()
    return read_dlq_volume(spark, f"{root}/counts")


@query
def ingest_gaps(spark, sf_dir):
    return monitoring.ingest_gaps(b.telemetry(spark, sf_dir))


def _arrivals(spark, sf_dir):
    return b.events(spark, sf_dir).select(
        "timestamp", F.expr("timestamp + make_interval(0, 0, 0, 0, 0, 0, k)").alias("_ingested_at")
    )


@query
def ingest_lag(spark, sf_dir):
    return monitoring.ingest_lag(_arrivals(spark, sf_dir), width="1 hour", limit=95.0)


def _arrival_windows(spark, sf_dir, at, width):
    """The windows of a stream of three files, the last of which holds the earliest rows."""
    root = scratch_path(spark, "ingest-stream")
    rows = _arrivals(spark, sf_dir).withColumn("_ingested_at", F.col(at))
    rows.repartitionByRange(3, F.desc("timestamp")).write.parquet(f"{root}/in")
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    stream_ingest_windows(source, f"{root}/counts", f"{root}/progress", width=width).awaitTermination()
    return f"{root}/counts"


@query
def stream_gap_alarms(spark, sf_dir):
    return read_gap_alarms(spark, _arrival_windows(spark, sf_dir, "timestamp", "5 minutes"))


@query
def stream_lag_alarms(spark, sf_dir):
    return read_lag_alarms(spark, _arrival_windows(spark, sf_dir, "_ingested_at", "1 hour"), width="1 hour", limit=95.0)


@query
def stream_ingest_volume(spark, sf_dir):
    root = scratch_path(spark, "ingest-stream")
    rows = _arrivals(spark, sf_dir)
    rows.write.parquet(f"{root}/in")
    source = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
    stream_ingest_windows(source, f"{root}/counts", f"{root}/progress", width="1 hour").awaitTermination()
    return read_ingest_windows(spark, f"{root}/counts")
