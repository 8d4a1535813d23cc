import pytest
from pyspark.sql import functions as F

from tests.fixtures import bronze, event, sensor
from tidemill.config import (
    AssetConfigError, discover_asset_configs, load_asset_config, parse_asset_config,
)
from tidemill.operators.silver import clean_events, fan_out_assets, flatten_payload, source_path_exists

GOOD = {"asset_type": "a", "silver_table": "t", "fields": [{"source": "payload.x", "target": "x", "type": "int"}]}


def test_shipped_types():
    names = [c.asset_type for c in discover_asset_configs()]
    assert names == sorted(names) and len(names) == 8
    assert load_asset_config("industrial").fields == ()


@pytest.mark.parametrize(
    "change, message",
    [
        ({"asset_type": ...}, "asset_type"), ({"fields": ...}, "fields"), ({"fields": 3}, "list"),
        ({"fields": [{"source": "payload.x", "type": "int"}]}, "target"),
        ({"fields": ["x"]}, "mapping"),
        ({"fields": [{"source": "payload.x", "target": "x", "type": "decimal"}]}, "decimal"),
        ({"fields": GOOD["fields"] * 2}, "repeated target"),
    ],
)
def test_malformed(change, message):
    document = {k: v for k, v in {**GOOD, **change}.items() if v is not ...}
    with pytest.raises(AssetConfigError, match=message):
        parse_asset_config(document)


def test_documents_that_are_no_mapping(tmp_path):
    for text in ("", "- a", "a: [", "asset_type: a"):
        (tmp_path / "x.yml").write_text(text)
        with pytest.raises(AssetConfigError):
            discover_asset_configs(tmp_path)
    with pytest.raises(AssetConfigError):
        discover_asset_configs(tmp_path / "absent")
    with pytest.raises(AssetConfigError):
        load_asset_config("absent", tmp_path)


def test_null_fields_and_defaults():
    config = parse_asset_config({**GOOD, "fields": None})
    assert config.fields == () and config.primary_key == ("event_id",) and config.deduplicate


def test_a_new_type_needs_only_a_file(spark, tmp_path):
    (tmp_path / "pump.yaml").write_text(
        "asset_type: pump\nsilver_table: silver_pump\nfields:\n"
        "  - {source: payload.a.b, target: b, type: double}\n")
    cleaned = clean_events(bronze(spark, [event("pump", "p", 0, {"a": {"b": "1.5"}}), sensor("d", 0, 1)]))
    tables = fan_out_assets(cleaned, discover_asset_configs(tmp_path))
    assert [r["b"] for r in tables["silver_pump"].collect()] == [1.5]
    with pytest.raises(AssetConfigError):
        fan_out_assets(cleaned, [])


def test_declared_key_is_honoured(spark):
    config = parse_asset_config({**GOOD, "asset_type": "pump", "primary_key": ["device_id", "x"]})
    events = [event("pump", "p", t, {"x": 1}) for t in (0, 5, 3)]
    (row,) = flatten_payload(clean_events(bronze(spark, events)), config).collect()
    assert row["event_id"] == events[1]["event_id"]


def test_struct_payloads(spark):
    df = spark.createDataFrame(
        [("e", "d", "a", "normal", "1", (("5",), "no"))],
        "event_id string, device_id string, asset_type string, priority string, schema_version string, "
        "payload struct<x: struct<y: string>, z: string>").withColumn("timestamp", F.current_timestamp())
    fields = [{"source": f"payload.{p}", "target": t, "type": "int"} for p, t in
              (("x.y", "y"), ("z", "z"), ("gone.deep", "g"))]
    (row,) = flatten_payload(df, parse_asset_config({**GOOD, "fields": fields})).collect()
    assert (row["y"], row["z"], row["g"]) == (5, None, None)
    assert source_path_exists(df.schema, "payload.x.y") and not source_path_exists(df.schema, "payload.z.y")
