import pytest

from tidemill.operators.egress import payload_bytes, projected_egress
from tidemill.operators.monitoring import dead_letter_ids, dlq_volume, ingest_gaps, ingest_lag
from tidemill.operators.gold import detection_performance
from pyspark.sql import functions as F


def at(spark, minutes, extra=None):
    rows = [(m * 60, e) for m, e in zip(minutes, extra or [0] * len(minutes))]
    return spark.createDataFrame(rows, "s int, x int").selectExpr("timestamp_seconds(s) AS at", "x")


def test_gap_alarm_needs_three_empty_windows(spark):
    rows = ingest_gaps(at(spark, [0, 1, 12, 40]), at="at").orderBy("window_start").collect()
    assert [r["n_events"] for r in rows] == [2, 0, 1, 0, 0, 0, 0, 0, 1]
    assert [r["alarm"] for r in rows] == [False] * 5 + [True, True, True, False]


def test_lag_alarm_needs_three_late_windows(spark):
    df = at(spark, [0, 5, 10, 15, 25, 30], [90, 70, 61, 10, 99, 99]).selectExpr(
        "at AS _ingested_at", "at - make_interval(0, 0, 0, 0, 0, 0, x) AS timestamp")
    rows = ingest_lag(df).orderBy("window_start").collect()
    assert [r["max_lag_s"] for r in rows] == [90, 70, 61, 10, 99, 99]
    assert [r["alarm"] for r in rows] == [False, False, True, False, False, False]


def test_dead_letter_volume(spark):
    rows = dlq_volume(at(spark, [0, 1, 7]), at="at").orderBy("window_start").collect()
    assert [(r["n_rejects"], r["alarm"]) for r in rows] == [(2, True), (1, True)]


def test_ids_of_dead_letters_are_read_from_broken_text(spark):
    bodies = {
        '{"event_id":"a-1","device_id":"d"} trailing': "a-1", '{"device_id":"d", "event_id" : "a 2"': "a 2",
        '{"body":"{\\"event_id\\":\\"a-3\\",\\"device_id\\":1}"}': "a-3", '{"event_id":""}': None, '{"event_id":"  "}': None,
        '{"source_event_id":"x"}': None, '{"event_id":7}': None, "": None, None: None, '{"event_id":"é"': "é",
    }
    df = spark.createDataFrame(list(bodies.items()), "raw_body string, want string")
    assert [r.event_id for r in dead_letter_ids(df).collect()] == list(bodies.values())


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_stream_alarms_equal_the_batch_after_late_rows(spark, tmp_path, order):
    from tidemill.streaming.monitors import read_gap_alarms, read_lag_alarms, stream_ingest_windows

    parts = [([0, 1, 12], [90, 99, 70]), ([40, 41], [61, 65]), ([25, 30, 35, 36], [99, 98, 62, 0])]
    source, everything = str(tmp_path / "in"), None
    for n in order:
        rows = at(spark, *parts[n]).selectExpr("at AS _ingested_at", "at - make_interval(0, 0, 0, 0, 0, 0, x) AS timestamp")
        everything = rows if everything is None else everything.unionByName(rows)
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        stream_ingest_windows(stream, str(tmp_path / "t"), str(tmp_path / "p")).awaitTermination()
        table = str(tmp_path / "t")
        gaps = ingest_gaps(everything, at="_ingested_at").orderBy("window_start").collect()
        assert read_gap_alarms(spark, table).orderBy("window_start").collect() == gaps
        lags = ingest_lag(everything).orderBy("window_start").collect()
        assert read_lag_alarms(spark, table).orderBy("window_start").collect() == lags
    assert any(r.alarm for r in lags)


@pytest.fixture(scope="module")
def sized(spark):
    rows = spark.range(10).withColumn("device", F.lit("bearing.DE")).withColumn(
        "waveform", F.transform(F.sequence(F.lit(1), F.lit(2048)), lambda i: F.sin(i) / 20))
    return payload_bytes(rows, ["id", "device"])


def test_waveform_dominates(sized):
    row = sized.first()
    assert row["waveform_share"] > 0.9 and row["overhead_ratio"] > 10 and row["within_limit"]
    assert row["stats_only_bytes"] == len('{"id":0,"device":"bearing.DE"}')


def test_reduction_falls_with_the_rate(sized):
    rates = [0.0, 0.2, 0.6, 1.0]
    got = {r["escalation_rate"]: r for r in projected_egress(sized, rates).collect()}
    reductions = [got[r]["egress_reduction_vs_static"] for r in rates]
    assert reductions == sorted(reductions, reverse=True)
    assert reductions[-1] == pytest.approx(0.0) and reductions[1] >= 0.4 > reductions[2] - 0.01
    assert [got[r]["escalated_events"] for r in rates] == [0, 2, 6, 10]


def test_unknown_outcomes(spark):
    df = spark.createDataFrame(
        [("m", "v", True, None, 1.0), ("m", "v", None, "ball", 2.0), ("m", "v", True, "ball", 3.0)],
        "mode string, model_version string, anomaly boolean, ground_truth_label string, infer_ms double")
    assert detection_performance(df).first()["tn"] == 2
    assert detection_performance(df, null_policy="exclude").first()["n_events"] == 1
