"""Golden scenarios through landing text, silver and gold."""

import json

import pytest

from tests.fixtures import (
    bronze, context, event, inference, lines, sensor, transition, validation,
)
from tidemill.config import discover_asset_configs
from tidemill.operators.envelope import validate_envelope
from tidemill.operators.gold import (
    asset_health_summary, cloud_egress, detection_performance, edge_autonomy,
    escalation_efficacy, mode_history, mode_trigger_breakdown, sessions_by_state,
)
from tidemill.operators.silver import clean_events, fan_out_assets, quarantine_events, select_valid
from tidemill.operators.monitoring import dead_letter_ids, layer_reconciliation

INFERENCE = "silver_bearing_inference_results"


def tables(spark, events):
    return fan_out_assets(clean_events(bronze(spark, events)), discover_asset_configs())


def test_normal_operation(spark):
    events = [inference("bearing.DE", i + 0.1, "normal", False, "CLOUD_OPTIMISED") for i in range(10)]
    (row,) = detection_performance(tables(spark, events)[INFERENCE]).collect()
    assert (row["n_events"], row["tp"], row["fp"], row["fn"], row["tn"]) == (10, 0, 0, 0, 10)
    assert row["precision"] is None and row["recall"] is None and row["f1"] is None
    assert row["model_version"] == "unversioned"


def test_confusion_matrix(spark):
    plan = [("inner_race", True)] * 80 + [("normal", True)] * 5
    plan += [("ball", False)] * 10 + [("normal", False)] * 5
    events = [
        inference("bearing.DE", i * 0.5, label, anomaly, "CLOUD_OPTIMISED",
                  infer_ms=3.0 + (i % 5) * 0.5, model_version="edge-v1.0-synthetic")
        for i, (label, anomaly) in enumerate(plan)
    ]
    (row,) = detection_performance(tables(spark, events)[INFERENCE]).collect()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (80, 5, 10, 5)
    assert row["precision"] == pytest.approx(0.9411764706)
    assert row["recall"] == pytest.approx(0.8888888889)
    assert row["f1"] == pytest.approx(0.9142857143)
    assert (row["infer_ms_p50"], row["infer_ms_p99"]) == (4.0, 5.0)


def test_escalations(spark):
    plan = [("ball", True, 0.30, True), ("ball", False, 0.33, False),
            ("normal", False, 0.21, False), ("normal", False, 0.36, True)]
    events = []
    for i, (label, edge, confidence, cloud) in enumerate(plan):
        source = inference("d", i, label, edge, "HYBRID", confidence=confidence)
        events += [source, validation(source, edge, cloud)]
    t = tables(spark, events)
    (row,) = escalation_efficacy(t[INFERENCE], t["silver_cloud_validation_results"]).collect()
    assert row.asDict() == {
        "mode": "HYBRID", "edge_confidence_bucket": "low", "n_escalations": 4,
        "agreement_rate": 0.75, "edge_accuracy": 0.75, "cloud_accuracy": 0.5,
        "validation_latency_ms_p50": 12.5, "cloud_accuracy_improvement": -0.25,
    }


def test_switch_latency(spark):
    t = tables(spark, [context("d", 0, True), context("other", 0.4, True),
                       transition("d", 0.5, "CLOUD_OPTIMISED", "EDGE_ONLY", "cpu")])
    (row,) = mode_history(t["silver_orchestrator_mode"], t["silver_context_snapshot"]).collect()
    assert row["mode_switch_latency_s"] == pytest.approx(0.5)
    assert row["time_in_previous_mode_s"] is None


def test_recovery_chain(spark):
    t = tables(spark, [transition("d", 0, "EDGE_AUTONOMOUS", "HYBRID", "recovery"),
                       transition("d", 2, "HYBRID", "CLOUD_OPTIMISED", "recovery"),
                       context("d", 0.2, False)])
    history = mode_history(t["silver_orchestrator_mode"], t["silver_context_snapshot"])
    rows = history.orderBy("transition_at").collect()
    assert [(r["from_mode"], r["to_mode"]) for r in rows] == [
        ("EDGE_AUTONOMOUS", "HYBRID"), ("HYBRID", "CLOUD_OPTIMISED")]
    assert [r["time_in_previous_mode_s"] for r in rows] == [None, 2.0]
    assert [r["mode_switch_latency_s"] for r in rows] == [None, None]
    assert sum(r["n_transitions"] for r in mode_trigger_breakdown(history).collect()) == 2


def test_breach_at_the_same_instant_counts(spark):
    t = tables(spark, [context("d", 5, True), context("d", 6, True),
                       transition("d", 5, "A", "B", "network")])
    (row,) = mode_history(t["silver_orchestrator_mode"], t["silver_context_snapshot"]).collect()
    assert row["mode_switch_latency_s"] == 0.0


def test_outage(spark):
    events = [inference("edge-node-01", 1 + 2 * i, "normal", i == 4, "EDGE_AUTONOMOUS")
              for i in range(8)]
    (row,) = edge_autonomy(tables(spark, events)[INFERENCE]).collect()
    assert (row["n_events_during_outage"], row["n_anomalies_during_outage"]) == (8, 1)
    assert (row["largest_inter_event_gap_s"], row["outage_duration_s"]) == (2.0, 14.0)


def test_gap_reaches_back_across_modes_and_null_mode_is_a_run(spark):
    df = spark.createDataFrame(
        [("1", "d", 0, "A"), ("2", "d", 10, "B"), ("3", "d", 11, None), ("4", "d", 12, None),
         ("5", "d", 15, "B"), ("6", "e", 3, None)],
        "event_id string, device_id string, at int, mode string",
    ).selectExpr("event_id", "device_id", "timestamp_seconds(at) at", "mode")
    got = sessions_by_state(df, "device_id", "at", "mode").orderBy("event_id").collect()
    assert [r["window_id"] for r in got] == [1, 2, 3, 3, 4, 1]
    assert [r["gap_s"] for r in got] == [None, 10.0, 1.0, 1.0, 3.0, None]


def test_hot_device_gives_the_same_gold(spark):
    modes = ["EDGE_AUTONOMOUS", "HYBRID", None, "EDGE_AUTONOMOUS"]
    events = [inference("hot" if i % 4 else "cold", i, "normal", i % 7 == 0, modes[i * i % 11 % 4])
              for i in range(200)]
    flat = tables(spark, events)[INFERENCE]
    plain = sorted(map(str, edge_autonomy(flat).collect()))
    assert plain == sorted(map(str, edge_autonomy(flat, max_rows=20).collect()))
    moves = [transition("hot" if i % 4 else "cold", i, "A", "B", "cpu") for i in range(0, 200, 3)]
    moves += [context("hot" if i % 3 else "cold", i, i % 5 == 0) for i in range(200)]
    t = tables(spark, moves)
    pair = t["silver_orchestrator_mode"], t["silver_context_snapshot"]
    plain = sorted(map(str, mode_history(*pair).collect()))
    assert plain == sorted(map(str, mode_history(*pair, max_rows=20).collect()))


def test_egress_share(spark):
    events = [inference("d", i, "normal", False, "HYBRID" if i < 3 else "EDGE_ONLY",
                        stats={"total": 10 * (i + 1)}) for i in range(5)]
    events.append(inference("e", 1, "normal", False, "HYBRID"))
    got = {(r["device_id"], r["mode"]): r for r in cloud_egress(tables(spark, events)[INFERENCE]).collect()}
    assert got["d", "HYBRID"]["pct_of_processed_events_landed_in_cloud"] == pytest.approx(3 / 50)
    assert got["d", "EDGE_ONLY"]["max_stats_total_in_mode"] == 50
    assert got["e", "HYBRID"]["pct_of_processed_events_landed_in_cloud"] is None


def test_daily_summary(spark):
    events = [event("vehicle", "v", i * 43200, {}, priority=p)
              for i, p in enumerate(["critical", "high", "high", "normal"])]
    rows = asset_health_summary(clean_events(bronze(spark, events))).orderBy("event_date").collect()
    assert [r["total_events"] for r in rows] == [2, 2]
    assert [r["high_priority_event_count"] for r in rows] == [1, 1]
    assert [r["critical_event_count"] for r in rows] == [1, 0]


# -- the three gates ----------------------------------------------------------


def defects():
    base = {f"DQ{i}": sensor(f"DQ{i}", 0, i) for i in range(1, 12)}
    del base["DQ3"]["event_id"]
    base["DQ4"]["unexpected_field"] = 1
    base["DQ5"]["payload"] = "text"
    base["DQ6"]["event_id"] = ""
    base["DQ7"]["timestamp"] = "not-a-real-timestamp"
    base["DQ8"]["asset_type"] = "mystery_sensor"
    del base["DQ9"]["payload"]["features"]["rms"]
    base["DQ10"]["payload"]["features"]["kurtosis"] = "very high"
    base["DQ11"]["timestamp"] = "2026-07-13T12:00:00.000Z"
    return base


EXPECTED = {  # (dead letters, bronze, cleaned, flattened)
    "DQ1": (0, 1, 1, 1), "DQ2": (0, 2, 1, 1), "DQ3": (1, 0, 0, 0), "DQ4": (1, 0, 0, 0),
    "DQ5": (1, 0, 0, 0), "DQ6": (1, 0, 0, 0), "DQ7": (0, 1, 0, 0), "DQ8": (0, 1, 1, 0),
    "DQ9": (0, 1, 1, 1), "DQ10": (0, 1, 1, 1), "DQ11": (0, 1, 1, 1),
}


def test_defects_by_layer(spark):
    events = list(defects().values()) + [defects()["DQ2"]]
    events[-1]["event_id"] = events[1]["event_id"]
    b = bronze(spark, events)
    _, rejects = validate_envelope(lines(spark, events))
    dead = [json.loads(r["raw_body"])["device_id"] for r in rejects.collect()]
    cleaned = clean_events(b)
    flat = fan_out_assets(cleaned, discover_asset_configs())["silver_bearing_sensor_telemetry"]
    count = lambda df: [r["device_id"] for r in df.select("device_id").collect()]
    layers = [dead, count(b), count(cleaned), count(flat)]
    for name, expected in EXPECTED.items():
        assert tuple(layer.count(name) for layer in layers) == expected, name
    nulls = {r["device_id"]: (r["rms"], r["kurtosis"]) for r in flat.collect()}
    assert nulls["DQ9"] == (None, 0.2) and nulls["DQ10"] == (0.1, None)
    (q,) = quarantine_events(b).collect()
    assert q["device_id"] == "DQ7" and q["_quarantine_reason"] == ["null_timestamp"]
    seen = {r["event_id"]: (r["dead"], r["bronze"], r["cleaned"], r["flattened"]) for r in layer_reconciliation(
        {"dead": dead_letter_ids(rejects), "bronze": b, "cleaned": cleaned, "flattened": flat}).collect()}
    ids = {e["device_id"]: e.get("event_id") for e in events}
    for name, expected in EXPECTED.items():
        if name not in ("DQ3", "DQ6"):
            assert seen[ids[name]] == expected, name
    assert seen[None] == (2, 0, 0, 0) and len(seen) == 10  # the two without an id share a row


def test_cleaned_and_quarantine_partition_bronze(spark):
    events = [sensor(f"d{i}", 0, i) for i in range(6)]
    events[0]["event_id"] = "  "
    events[1]["device_id"] = " "
    events[2]["timestamp"] = "2026-13-45"
    events[3]["asset_type"] = "\t "
    b = bronze(spark, events)
    reasons = {r["device_id"].strip(): list(r["_quarantine_reason"]) for r in quarantine_events(b).collect()}
    assert reasons[""] == ["invalid_device_id"] and reasons["d2"] == ["null_timestamp"]
    assert select_valid(b).count() + quarantine_events(b).count() == b.count()


def test_an_invalid_newer_copy_does_not_hide_the_valid_one(spark):
    from pyspark.sql import functions as F

    good, bad = sensor("d", 0, 1), sensor("d", 0, 1)
    bad["event_id"], bad["timestamp"] = good["event_id"], "broken"
    older = bronze(spark, [good])
    newer = bronze(spark, [bad]).withColumn("_ingested_at", F.col("_ingested_at") + F.expr("INTERVAL 1 DAY"))
    assert clean_events(older.unionByName(newer)).count() == 1
