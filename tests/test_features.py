import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators.features import (
    assert_one_label_per_file,
    assign_recording_split,
    bearing_ml_features,
    feature_quarantine,
    trend_features,
)
from tidemill.schema import FEATURES, FORBIDDEN_FEATURE_COLUMNS
from tidemill.session import scratch_path

SENSOR = (
    "event_id string, device_id string, timestamp timestamp, source_file string, "
    "ground_truth_label string, seq int, window_idx int, sampling_rate_hz int, "
    "dataset_run_id string, " + ", ".join(f"{c} double" for c in FEATURES)
)


def sensor_rows(spark, files, windows=8, seed=1):
    rng = random.Random(seed)
    rows = []
    for label, names in files.items():
        for name in names:
            for w in range(windows):
                values = [rng.random() for _ in FEATURES]
                rows.append((f"{name}-{w}", "d", None, name, label, w, w, 12000, "r1", *values))
    return spark.createDataFrame(rows, SENSOR)


@pytest.mark.parametrize(
    "label, total, expected",
    [
        ("normal", 1, "T"), ("normal", 2, "TV"), ("normal", 3, "TVE"), ("normal", 4, "TTVE"),
        ("normal", 5, "TTTVE"), ("normal", 10, "TTTTTTVVEE"), ("ball", 1, "V"), ("ball", 2, "VE"),
        ("ball", 3, "VVE"), ("ball", 4, "VVEE"), ("ball", 8, "VVVVEEEE"),
    ],
)
def test_split_policy(spark, label, total, expected):
    files = spark.createDataFrame(
        [(f"{label}_{i:02d}", label) for i in range(total)], "source_file string, ground_truth_label string"
    )
    rows = assign_recording_split(files).orderBy("source_file").collect()
    letters = {"TRAIN": "T", "VALIDATION": "V", "TEST": "E"}
    assert "".join(letters[r["dataset_split"]] for r in rows) == expected


def test_split_is_the_same_for_many_recordings_in_chunks(spark):
    files = spark.range(300).selectExpr(
        "'f' || lpad(id, 4, '0') AS source_file",
        "CASE WHEN id % 3 = 0 THEN 'normal' ELSE 'ball' END AS ground_truth_label",
    )
    plain, chunked = assign_recording_split(files), assign_recording_split(files, max_rows=30)
    assert sorted(plain.collect()) == sorted(chunked.collect())


def test_features_and_quarantine_partition_the_input(spark):
    rows = sensor_rows(spark, {"normal": ["n1", "n2", "n3"], "ball": ["b1", "b2"]})
    rows = rows.withColumn("rms", F.when(F.col("window_idx") != 2, F.col("rms")))
    rows = rows.withColumn("skew", F.when(F.col("event_id") != "n1-2", F.col("skew")))
    table, bad = bearing_ml_features(rows), feature_quarantine(rows)
    assert table.count() + bad.count() == rows.count()
    reasons = {r["event_id"]: r["quarantine_missing_columns"] for r in bad.collect()}
    assert reasons["n1-2"] == "rms,skew" and reasons["b1-2"] == "rms"
    assert not set(table.columns) & set(FORBIDDEN_FEATURE_COLUMNS)
    splits = table.groupBy("source_file").agg(F.count_distinct("dataset_split").alias("n")).collect()
    assert all(r["n"] == 1 for r in splits)
    eligible = table.filter("is_training_eligible").select("ground_truth_label", "dataset_split").distinct()
    assert [tuple(r) for r in eligible.collect()] == [("normal", "TRAIN")]


def test_trends_look_back_only(spark):
    rows = sensor_rows(spark, {"normal": ["a"]}, windows=9)
    before = {r["window_idx"]: r for r in trend_features(rows).collect()}
    changed = rows.withColumn("rms", F.when(F.col("window_idx") == 6, F.lit(99.0)).otherwise(F.col("rms")))
    after = {r["window_idx"]: r for r in trend_features(changed).collect()}
    assert all(before[i]["rms_roll_mean_5"] == after[i]["rms_roll_mean_5"] for i in range(6))
    assert before[6]["rms_roll_mean_5"] != after[6]["rms_roll_mean_5"]
    assert before[0]["rms_roll_std_5"] == 0.0 and before[0]["rms_delta_1"] == 0.0
    assert [before[i]["trend_window_complete"] for i in (3, 4)] == [False, True]


def test_long_recording_in_chunks(spark):
    rows = sensor_rows(spark, {"normal": ["a", "b"]}, windows=60).repartition(7)
    plain = sorted(map(str, trend_features(rows).select("event_id", "rms_roll_mean_5", "window_position",
                                                        "rms_delta_1").collect()))
    cut = sorted(map(str, trend_features(rows, max_rows=9).select("event_id", "rms_roll_mean_5", "window_position",
                                                                  "rms_delta_1").collect()))
    assert plain == cut


def test_one_label_per_file(spark):
    files = spark.createDataFrame([("a", "normal"), ("a", "ball")], "source_file string, ground_truth_label string")
    with pytest.raises(ValueError, match="'a'"):
        assert_one_label_per_file(files)


def test_the_feature_table_counts_its_input_once(spark):
    """Two scans of the input: one for the counts, one for the rows."""
    rows = sensor_rows(spark, {"normal": ["n1", "n2"], "ball": ["b1"]}, windows=8)
    path = f"{scratch_path(spark, 'sensor')}"
    rows.write.parquet(path)
    table = bearing_ml_features(spark.read.parquet(path))
    scans = [line for line in table._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line and path in line]
    assert len(scans) == 1  # the counts were taken while the plan was built, in one further scan
    assert table.count() == 24
