"""Small event builders for the tests."""

import json
import uuid
from datetime import datetime, timedelta, timezone

BASE = datetime(2027, 3, 2, 4, 30, tzinfo=timezone.utc)


def stamp(offset, base=BASE):
    t = base + timedelta(seconds=offset)
    return t.strftime("%Y-%m-%dT%H:%M:%S.") + f"{t.microsecond // 1000:03d}Z"


def event(asset_type, device, offset, payload, priority="normal", event_id=None, **extra):
    return {
        "event_id": event_id or str(uuid.uuid4()),
        "device_id": device,
        "asset_type": asset_type,
        "timestamp": stamp(offset),
        "priority": priority,
        "schema_version": "1.0.0",
        "payload": payload,
        **extra,
    }


def inference(device, offset, label, anomaly, mode, **more):
    payload = {"seq": int(offset * 10), "label": label, "anomaly": anomaly, "anomaly_score": 0.5,
               "infer_ms": 3.0, "mode": mode, **more}
    return event("bearing_inference", device, offset, payload)


def sensor(device, offset, seq, label="normal", file="normal_0.mat", **changes):
    features = {"rms": 0.1, "peak": 0.3, "crest": 3.0, "kurtosis": 0.2, "skew": 0.0,
                "variance": 0.01, "mean_abs": 0.08}
    features.update(changes)
    features = {k: v for k, v in features.items() if v is not None}
    payload = {"seq": seq, "file": file, "label": label, "window_idx": seq, "features": features}
    return event("bearing_sensor", device, offset, payload)


def transition(device, offset, old, new, trigger):
    return event("orchestrator_mode", device, offset,
                 {"from_mode": old, "to_mode": new, "trigger": trigger, "rtt_ms": 900.0,
                  "cpu_pct": 12.0, "edge_confidence": 0.6, "breach_count": 3,
                  "policy_version": "p1"}, priority="high")


def context(device, offset, breach):
    return event("context_snapshot", device, offset,
                 {"rtt_ms": 900.0, "cpu_pct": 12.0, "ram_pct": 40.0, "cloud_reachable": not breach,
                  "is_breach_sample": breach})


def validation(source, edge, cloud):
    return event("cloud_validation", source["device_id"], 30,
                 {"source_event_id": source["event_id"], "edge_anomaly": edge,
                  "cloud_anomaly": cloud, "agrees_with_edge": edge == cloud,
                  "cloud_score": 0.9 if cloud else 0.1, "validation_latency_ms": 12.5,
                  "mode": "HYBRID"})


def lines(spark, events):
    texts = [e if isinstance(e, str) else json.dumps(e, separators=(",", ":")) for e in events]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def bronze(spark, events):
    from pyspark.sql import functions as F

    from tidemill.operators.envelope import validate_envelope

    valid, _ = validate_envelope(lines(spark, events))
    return valid.withColumn("_source_file", F.lit("f")).withColumn(
        "_ingested_at", F.timestamp_seconds(F.lit(1_786_525_200))
    )
