import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.fixtures import lines, sensor
from tidemill.functions.expectations import ExpectationFailed, expect
from tidemill.operators.envelope import validate_envelope
from tidemill.operators.silver import clean_events
from tidemill.sources.landing import (
    bronze_from_landing, read_dead_letters, read_landing, write_dead_letters, write_landing,
)
from tidemill.sources.tables import (
    compact_table, compact_tables, current_version, read_current, read_table, write_gold,
)
from tidemill.streaming.ingest import stream_ingest, stream_to_landing

AT = datetime(2026, 3, 5, 23, 0, tzinfo=timezone.utc)


def test_landing_layout_and_roundtrip(spark, tmp_path):
    events = [sensor(f"d{i}", 0, i) for i in range(3)]
    events[2]["payload"] = {"ü": "€"}
    valid, rejects = validate_envelope(lines(spark, [*events, "broken"]))
    path = str(tmp_path)
    write_landing(valid, path, F.lit(AT))
    write_dead_letters(rejects, path)
    assert os.path.isdir(f"{path}/year=2026/month=03/day=05") and os.path.isdir(f"{path}/_dlq")
    landing = read_landing(spark, path)
    written = [json.loads(r["value"]) for r in landing.collect()]
    by_id = lambda e: e["event_id"]
    assert sorted(written, key=by_id) == sorted(events, key=by_id)
    assert {(r["year"], r["month"], r["day"]) for r in landing.collect()} == {("2026", "03", "05")}
    bronze = bronze_from_landing(landing)
    assert bronze.filter("_source_file IS NULL OR _ingested_at IS NULL").count() == 0
    (dead,) = read_dead_letters(spark, path).collect()
    assert (dead["raw_body"], dead["error_reason"]) == ("broken", "invalid_json")


def test_indented_dead_letters(spark, tmp_path):
    folder = tmp_path / "_dlq" / "year=2026" / "month=01" / "day=01"
    folder.mkdir(parents=True)
    record = {"raw_body": "x", "error_reason": "r", "dlq_timestamp": "2026-01-01T00:00:00+00:00"}
    (folder / "dlq_1.json").write_text(json.dumps(record, indent=2))
    assert read_dead_letters(spark, str(tmp_path), multi_line=True).first()["raw_body"] == "x"


def test_streams_resume_and_equal_the_batch(spark, tmp_path):
    incoming, landing, bronze = (str(tmp_path / n) for n in ("in", "landing", "bronze"))
    events = [sensor(f"d{i}", 0, i) for i in range(6)]

    def run():
        source = spark.readStream.format("text").load(incoming)
        stream_to_landing(source, landing, str(tmp_path / "c1")).awaitTermination()
        stream_ingest(spark, landing, bronze, str(tmp_path / "c2"), 1).awaitTermination()
        return spark.read.parquet(bronze)

    lines(spark, [*events[:3], "junk"]).write.text(incoming)
    assert run().count() == 3
    assert run().count() == 3  # nothing new, nothing read twice
    lines(spark, events[3:]).write.mode("append").text(incoming)
    assert run().count() == 6
    assert read_dead_letters(spark, landing).count() == 1
    # the whole input delivered again: bronze holds copies, silver one of each
    lines(spark, events).write.mode("append").text(incoming)
    again = run()
    assert again.count() == 12 and clean_events(again).count() == 6
    batch = bronze_from_landing(read_landing(spark, landing))
    ids = lambda df: sorted(r["event_id"] for r in df.select("event_id").collect())
    assert ids(batch) == ids(again)


def test_a_failed_write_is_retried_without_loss(spark, tmp_path):
    incoming, landing = str(tmp_path / "in"), str(tmp_path / "landing")
    lines(spark, [sensor("d", 0, 1)]).write.text(incoming)
    source = spark.readStream.format("text").load(incoming)
    (tmp_path / "landing").write_text("a file where the folder should be")
    with pytest.raises(Exception):
        stream_to_landing(source, landing, str(tmp_path / "c")).awaitTermination()
    (tmp_path / "landing").unlink()
    stream_to_landing(source, landing, str(tmp_path / "c")).awaitTermination()
    assert read_landing(spark, landing).count() == 1


def test_published_tables(spark, tmp_path):
    table = str(tmp_path / "t")
    good = spark.range(10).withColumn("x", F.col("id") * 2)
    write_gold(good, table, {"positive": "x >= 0"})
    version = current_version(spark, table)
    with pytest.raises(ExpectationFailed, match="positive"):
        write_gold(good.withColumn("x", F.lit(-1)), table, {"positive": "x >= 0"})
    assert current_version(spark, table) == version and read_current(spark, table).count() == 10
    assert read_table(spark, f"{table}/{version}", ["x"], "id > 7").collect() == [(16,), (18,)]


def test_compaction(spark, tmp_path):
    table = str(tmp_path / "t")
    write_gold(spark.range(1000).repartition(20), table)
    before = len(read_current(spark, table).inputFiles())
    compact_table(spark, table, ["id"])
    after = read_current(spark, table)
    assert (before, len(after.inputFiles())) == (20, 1) and after.count() == 1000
    with pytest.raises(RuntimeError, match="missing"):
        compact_tables(spark, {str(tmp_path / "missing"): ["id"], table: ["id"]})


def test_expectation_actions(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    assert expect(df, {"p": "x > 0"}).count() == 1
    first, second = Observation("first"), Observation("second")
    twice = expect(expect(df, {"p": "x > 0"}, "warn", first), {"q": "x < 0"}, "warn", second)
    assert expect(twice, {"r": "x = 1"}, "warn").count() == 3
    assert first.get == {"p": 2} and second.get == {"q": 2}
    assert expect(df, {"p": "x > -9 OR x IS NULL"}, "fail").count() == 3
    with pytest.raises(Exception, match="expectation broken: p"):
        expect(df, {"p": "x > 0"}, "fail").collect()


def test_monitor_streams_equal_the_batch(spark, tmp_path):
    """The open window counts, and so do rows that come a month late in a second batch."""
    from tidemill.operators.monitoring import dlq_volume
    from tidemill.streaming.monitors import (
        read_dlq_volume, read_ingest_windows, stream_dlq_volume, stream_ingest_windows,
    )

    made = "timestamp_seconds({0} + id * 37) AS at", "timestamp_seconds({0} + id * 37 - id % 90) AS seen"
    first = spark.range(0, 200).selectExpr(*(m.format(2_592_000) for m in made))
    late = spark.range(0, 50).selectExpr(*(m.format(0) for m in made))
    folder = str(tmp_path / "in")
    source = spark.readStream.schema(first.schema).parquet(folder) if first.write.parquet(folder) is None else None
    for rows in (first, first.union(late)):
        stream_dlq_volume(source, str(tmp_path / "dlq"), str(tmp_path / "c1"), "at").awaitTermination()
        stream_ingest_windows(source, str(tmp_path / "in-w"), str(tmp_path / "c2"), "seen", "at").awaitTermination()
        got = sorted(read_dlq_volume(spark, str(tmp_path / "dlq")).collect())
        assert got == sorted(dlq_volume(rows, "at").collect()) and len(got) > 20
        windows = sorted(read_ingest_windows(spark, str(tmp_path / "in-w")).collect())
        assert [r["n_events"] for r in windows] == [r["n_rejects"] for r in got]
        assert max(r["max_lag_s"] for r in windows) <= 89
        if rows is first:
            late.write.mode("append").parquet(folder)


def test_dead_letters_of_a_retried_batch_count_once(spark, tmp_path, monkeypatch):
    """The batch breaks after its dead letters are written and is run again."""
    incoming, landing = str(tmp_path / "in"), str(tmp_path / "landing")
    lines(spark, [sensor("d", 0, 1), "junk"]).coalesce(1).write.text(incoming)
    source = spark.readStream.format("text").load(incoming)

    def broken(*_):
        raise OSError("no room")

    with monkeypatch.context() as m:
        m.setattr("tidemill.streaming.ingest.write_landing", broken)
        with pytest.raises(Exception, match="no room"):
            stream_to_landing(source, landing, str(tmp_path / "c")).awaitTermination()
    assert read_dead_letters(spark, landing).count() == 1
    stream_to_landing(source, landing, str(tmp_path / "c"), {"availableNow": True}).awaitTermination()
    assert read_dead_letters(spark, landing).count() == 1 and read_landing(spark, landing).count() == 1


def test_two_checkpoints_share_a_landing_and_its_counts(spark, tmp_path):
    """Every checkpoint counts from 0, so does one made anew at the path of an old one."""
    import shutil

    from tidemill.streaming.monitors import read_dlq_volume, stream_dlq_volume

    landing, counts = str(tmp_path / "landing"), str(tmp_path / "counts")
    at = spark.range(2).selectExpr("timestamp_seconds(id) AS at")
    at.write.parquet(str(tmp_path / "at"))
    for i, name in enumerate(("c1", "c2", "c2")):
        checkpoint = tmp_path / name
        shutil.rmtree(checkpoint, ignore_errors=True)
        incoming = str(tmp_path / f"in{i}")
        lines(spark, [sensor("d", 0, i), f"junk {i}"]).coalesce(1).write.text(incoming)
        stream_to_landing(spark.readStream.format("text").load(incoming), landing, f"{checkpoint}/land").awaitTermination()
        dead = {r["raw_body"] for r in read_dead_letters(spark, landing).collect()}
        assert dead == {f"junk {j}" for j in range(i + 1)} and read_landing(spark, landing).count() == i + 1
        source = spark.readStream.schema(at.schema).parquet(str(tmp_path / "at"))
        stream_dlq_volume(source, counts, f"{checkpoint}/count", "at").awaitTermination()
        assert [r["n_rejects"] for r in read_dlq_volume(spark, counts).collect()] == [2 * (i + 1)]
