import math

import pytest
from pyspark.sql import functions as F

from tidemill.operators.signal import (
    keep_channel, label_from_prefix, pick_channel, recording_summary, segment_arrays,
    segment_windows, time_domain_features, waveform_features, windows_to_records,
)
from tidemill.operators.translate import translate_sensor

SIZE = 2048


def samples(spark, series):
    arrays = spark.createDataFrame(list(series.items()), "source_file string, signal array<double>")
    return arrays, arrays.select("source_file", F.posexplode("signal").alias("sample_idx", "value"))


@pytest.fixture(scope="module")
def computed(spark):
    spike = [0.0] * SIZE
    spike[7] = 10.0
    series = {
        "constant": [2.0] * SIZE, "spike": spike, "zeros": [0.0] * SIZE,
        "short": [1.0] * 100, "partial": [float(i % 5) for i in range(SIZE * 2 + 9)],
    }
    arrays, long = samples(spark, series)
    by_samples = {(r["source_file"], r["window_idx"]): r for r in time_domain_features(long).collect()}
    cut = waveform_features(segment_arrays(arrays))
    by_arrays = {(r["source_file"], r["window_idx"]): r for r in cut.collect()}
    return by_samples, by_arrays, long


def test_known_windows(computed):
    for got in computed[:2]:
        c = got["constant", 0]
        assert (c["rms"], c["peak"], c["crest"], c["variance"], c["mean_abs"]) == (2, 2, 1, 0, 2)
        assert c["kurtosis"] is None and c["skew"] is None
        assert got["spike", 0]["peak"] == 10 and got["spike", 0]["crest"] > 20
        assert got["zeros", 0]["crest"] == 0
        assert ("short", 0) not in got
        assert {k for k in got if k[0] == "partial"} == {("partial", 0), ("partial", 1)}


def test_both_forms_agree(computed):
    left, right, _ = computed
    assert left.keys() == right.keys()
    for key, row in left.items():
        for name in ("rms", "peak", "crest", "kurtosis", "skew", "variance", "mean_abs"):
            a, b = row[name], right[key][name]
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_windows_keep_sample_order(computed):
    rows = segment_windows(computed[2]).filter("source_file = 'partial' AND window_idx = 1").collect()
    assert rows[0]["waveform"] == [float(i % 5) for i in range(SIZE, 2 * SIZE)]


def test_channel_with_the_highest_number(spark):
    rows = [("a.mat", "X098_DE_time"), ("a.mat", "X099_DE_time"), ("a.mat", "X099_FE_time"),
            ("b.mat", "X105_DE_time"), ("c.mat", "X1_FE_time")]
    variables = spark.createDataFrame(rows, "source_file string, variable string")
    chosen, none = pick_channel(variables)
    assert {(r["source_file"], r["variable"]) for r in chosen.collect()} == {
        ("a.mat", "X099_DE_time"), ("b.mat", "X105_DE_time")}
    assert [r["source_file"] for r in none.collect()] == ["c.mat"]
    assert keep_channel(variables, chosen).count() == 2


def test_labels(spark):
    names = spark.createDataFrame([("normal_1hp.mat",), ("inner_race_0.mat",), ("odd.mat",)], "f string")
    assert [r[0] for r in names.select(label_from_prefix(F.col("f"))).collect()] == [
        "normal", "inner_race", None]


def test_records_are_numbered_over_all_files(spark, computed):
    _, _, long = computed
    features = time_domain_features(long).withColumn("ground_truth_label", F.lit("normal"))
    rows, rejects = translate_sensor(windows_to_records(features, "run", "dev", "2027-03-02 04:30:00"))
    got = rows.select("timestamp", F.expr("try_variant_get(payload, '$.seq', 'int')").alias("seq"),
                      F.expr("try_variant_get(payload, '$.file', 'string')").alias("file"),
                      F.expr("try_variant_get(payload, '$.waveform', 'string')").alias("w")).orderBy("seq").collect()
    assert [r["seq"] for r in got] == [1, 2, 3, 4, 5]
    assert [r["file"] for r in got] == ["constant", "partial", "partial", "spike", "zeros"]
    assert got[0]["timestamp"] == "2027-03-02T04:30:01.000Z" and got[0]["w"] is None
    assert rejects.count() == 0
    with pytest.raises(ValueError):
        windows_to_records(features, "", "dev", "2027-03-02 04:30:00")


def test_summary_levels(spark):
    files = spark.createDataFrame(
        [("a", "normal", "TRAIN", 5000), ("b", "normal", "TEST", 2048), ("c", "ball", "TEST", 100)],
        "source_file string, ground_truth_label string, dataset_split string, n_samples long")
    rows = recording_summary(files).collect()
    totals = {(r["level"], r["ground_truth_label"], r["dataset_split"]): r["n_windows"] for r in rows}
    assert totals["total", None, None] == 3 and totals["label", "normal", None] == 3
    assert totals["label_split", "normal", "TRAIN"] == 2 and len(rows) == 3 + 3 + 2 + 1


def test_an_empty_window_is_quarantined(spark):
    from tidemill.operators.features import feature_validity

    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, []), (3, None)], "id int, waveform array<double>")
    got = {r["id"]: r for r in waveform_features(rows).collect()}
    assert got[1]["peak"] == 2.0 and all(got[i]["rms"] is None and got[i]["crest"] is None for i in (2, 3))
    flagged = feature_validity(waveform_features(rows), ["rms", "crest"])
    assert {r["id"] for r in flagged.filter("is_valid").collect()} == {1}
