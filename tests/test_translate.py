import json
import uuid

import pytest

from tests.fixtures import lines
from tidemill.operators.envelope import to_body, validate_envelope
from tidemill.operators.tracker import parse_tracker_packets
from tidemill.operators.translate import (
    parse_records, translate_context, translate_inference, translate_mode_transition, translate_sensor,
)

NS = uuid.UUID("6f1b3c2a-6e6a-4b1a-9a7a-2b8f6b8b8a2e")
TS = "2026-08-01T14:32:07.812Z"
SENSOR = {"ts": TS, "seq": 42, "sensor_id": "bearing.DE", "file": "f", "label": "ball", "window_idx": 1}
INFERENCE = {"ts": TS, "seq": 42, "sensor_id": "bearing.DE", "label": "ball", "anomaly": True}
MODE = {"ts": TS, "device_id": "n1", "from_mode": "A", "to_mode": "B", "trigger": "cpu"}
CONTEXT = {"ts": TS, "device_id": "n1", "rtt_ms": 1.5, "breach": True}


def run(spark, translate, *records):
    rows, rejects = translate(parse_records(lines(spark, list(records))))
    return rows.collect(), rejects.collect()


@pytest.mark.parametrize(
    "translate, record, key, device, priority",
    [
        (translate_sensor, SENSOR, f"sensors.bearing:bearing.DE:42:{TS}", "bearing.DE", "high"),
        (translate_sensor, {**SENSOR, "label": "normal"}, f"sensors.bearing:bearing.DE:42:{TS}", "bearing.DE", "normal"),
        (translate_inference, INFERENCE, f"inference.bearing:bearing.DE:42:{TS}", "bearing.DE", "high"),
        (translate_inference, {**INFERENCE, "anomaly": False}, f"inference.bearing:bearing.DE:42:{TS}", "bearing.DE", "normal"),
        (translate_mode_transition, MODE, f"orchestrator.mode:n1:A:B:{TS}", "n1", "high"),
        (translate_context, CONTEXT, f"context.snapshot:n1:{TS}", "n1", "normal"),
    ],
)
def test_envelopes(spark, translate, record, key, device, priority):
    (row,), rejects = run(spark, translate, record)
    assert not rejects
    assert row["event_id"] == str(uuid.uuid5(NS, key))
    assert (row["device_id"], row["priority"], row["timestamp"]) == (device, priority, TS)
    payload = row["payload"].toPython()
    if translate is translate_context:
        assert payload == {**record, "is_breach_sample": True}
    else:
        assert payload == record


def test_context_stamp(spark):
    rows, _ = run(spark, translate_context, {"ts": TS, "device_id": "a"},
                  {"ts": TS, "device_id": "b", "is_breach_sample": True, "breach": False})
    assert [r["payload"].toPython()["is_breach_sample"] for r in rows] == [False, False]


def test_malformed_records_are_set_aside(spark):
    missing = {k: v for k, v in SENSOR.items() if k not in ("label", "seq")}
    rows, rejects = run(spark, translate_sensor, SENSOR, missing, "not json", json.dumps(SENSOR) + " x")
    assert len(rows) == 1
    assert sorted(r["error_reason"] for r in rejects) == ["invalid_json", "invalid_json", "missing:seq,label"]


PACKET = "$$76,865280051234567,AAA,250909,141523,43.6532,N,79.3832,W,55.3,270.1,1,12,1.2,0,0,0000,2*AB"


def test_tracker_position(spark):
    rows, rejects = parse_tracker_packets(lines(spark, [PACKET + "\r"]))
    (row,) = rows.collect()
    assert row["device_id"] == "tracker-865280051234567"
    assert row["timestamp"] == "2025-09-09T14:15:23Z"
    payload = row["payload"].toPython()
    assert (payload["latitude"], payload["longitude"]) == (43.6532, -79.3832)
    assert (payload["speed_kmh"], payload["course_deg"], payload["gps_valid"]) == (102.4, 270.1, True)
    assert rejects.count() == 0
    # what comes out passes the closed envelope, and a repeated packet has the same id
    valid, refused = validate_envelope(to_body(rows))
    assert valid.count() == 1 and refused.count() == 0
    again, _ = parse_tracker_packets(lines(spark, [PACKET]))
    assert again.first()["event_id"] == row["event_id"]


def test_tracker_others(spark):
    bodies = ["", "  ", "$$10,865280051234567,HBT*1", "$$10,x,log*1", "hello",
              PACKET.replace("250909", "251399"), PACKET.replace("43.6532", "4.3.2")]
    rows, rejects = parse_tracker_packets(lines(spark, bodies))
    assert rows.count() == 0
    assert sorted(r["error_reason"] for r in rejects.collect()) == ["bad_number", "bad_time", "unrecognised_format"]
    from pyspark.sql import functions as F

    rows, _ = parse_tracker_packets(lines(spark, bodies), received_at=F.lit("2026-01-01T00:00:00Z"))
    assert [r["timestamp"] for r in rows.collect()] == ["2026-01-01T00:00:00Z"]
