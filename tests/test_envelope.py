import json
import uuid

import pytest
from pyspark.sql import functions as F

from tests.fixtures import lines, sensor
from tidemill.functions.ids import deterministic_event_id
from tidemill.operators.envelope import replay_dead_letters, validate_envelope


def judged(spark, bodies):
    valid, rejects = validate_envelope(lines(spark, bodies))
    return valid.collect(), {r["raw_body"]: r["error_reason"] for r in rejects.collect()}


def changed(**changes):
    e = sensor("d", 0, 1)
    for k, v in changes.items():
        if v is ...:
            del e[k]
        else:
            e[k] = v
    return json.dumps(e, separators=(",", ":"))


@pytest.mark.parametrize(
    "body, reason",
    [
        (changed(event_id=...), "missing:event_id"),
        (changed(event_id="", device_id=...), "empty:event_id;missing:device_id"),
        (changed(unexpected_field=1, other=2), "extra:other,unexpected_field"),
        (changed(payload="text"), "type:payload"),
        (changed(payload=None), "type:payload"),
        (changed(payload=[1]), "type:payload"),
        (changed(priority=None), "type:priority"),
        (changed(event_id=5), "type:event_id"),
        (changed() + " trailing", "invalid_json"),
        (changed() + "," + changed(), "invalid_json"),
        (changed() + "]", "invalid_json"),
        (changed() + "}", "invalid_json"),
        ("{'event_id': 'x'}", "invalid_json"),
        ("not json", "invalid_json"),
        ("", "invalid_json"),
        ("null", "not_an_object"),
        ("[1]", "not_an_object"),
        ('"text"', "not_an_object"),
    ],
)
def test_rejects(spark, body, reason):
    valid, rejects = judged(spark, [body])
    assert valid == [] and rejects == {body: reason}


def test_defaults_only_for_absent_keys(spark):
    valid, rejects = judged(spark, [changed(priority=..., schema_version=..., payload=...)])
    (row,) = valid
    assert not rejects
    assert (row["priority"], row["schema_version"]) == ("normal", "1.0.0")
    assert row["payload"].toPython() == {}


def test_any_payload_passes(spark):
    payload = {"deep": {"list": [1, {"a": None}]}, "ü": "€"}
    valid, _ = judged(spark, [changed(payload=payload)])
    assert valid[0]["payload"].toPython() == payload


def test_valid_and_rejects_partition_the_input(spark):
    bodies = [changed(), changed(), changed(event_id=...), "x", changed() + "x"]
    valid, rejects = validate_envelope(lines(spark, bodies))
    assert valid.count() == 2 and rejects.count() == 3


def test_replay_after_repair(spark):
    _, rejects = validate_envelope(lines(spark, [changed(event_id=...), "x"]))
    fixed = F.regexp_replace("raw_body", r"^\{", '{"event_id":"fixed",')
    valid, still = replay_dead_letters(rejects, fixed)
    assert [r["event_id"] for r in valid.collect()] == ["fixed"]
    assert [r["error_reason"] for r in still.collect()] == ["invalid_json"]


def test_ids_equal_uuid5(spark):
    ns = "6f1b3c2a-6e6a-4b1a-9a7a-2b8f6b8b8a2e"
    keys = [f"subject-{i}-ü€" for i in range(200)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    got = df.select("k", "i", deterministic_event_id(ns, "k", "i").alias("id")).collect()
    assert all(r["id"] == str(uuid.uuid5(uuid.UUID(ns), f"{r['k']}:{r['i']}")) for r in got)
