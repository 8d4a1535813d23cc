import random

import pytest

from tidemill.operators.heartbeat import heartbeat_downsample
from tidemill.streaming.heartbeat import read_heartbeats, stream_heartbeat_downsample


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "device_id string, t double, event_id int, breach boolean"
    ).selectExpr("device_id", "timestamp_millis(cast(t * 1000 as long)) AS timestamp", "event_id", "breach")


def simple(rows, interval=30.0):
    kept, last = set(), {}
    for device, t, i, breach in sorted(rows, key=lambda r: (r[1], r[2])):
        if breach or device not in last or t - last[device] >= interval:
            kept.add(i)
            last[device] = t
    return kept


def ids(df):
    return {r["event_id"] for r in df.select("event_id").collect()}


@pytest.mark.parametrize(
    "times, breaches, kept",
    [
        ([0, 1], [], {0}),
        ([0, 10, 40], [], {0, 40}),
        ([0, 10, 35, 64, 65], [35], {0, 35, 65}),
        ([0, 1, 2], [1, 2], {0, 1, 2}),
    ],
)
def test_vectors(spark, times, breaches, kept):
    rows = [("d", float(t), t, t in breaches) for t in times]
    assert ids(heartbeat_downsample(frame(spark, rows))) == kept


@pytest.mark.parametrize("seed, breach_rate", [(1, 0.0), (2, 0.02), (3, 0.3)])
def test_hot_device_in_chunks_equals_the_simple_walk(spark, seed, breach_rate):
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        device = "hot" if i % 3 else rng.choice(["a", None])
        breach = None if rng.random() < 0.1 else rng.random() < breach_rate
        rows.append((device, float(rng.randrange(0, 1500)), i, breach))
    df = frame(spark, rows).repartition(5)
    expected = simple(rows)
    assert ids(heartbeat_downsample(df)) == expected
    assert ids(heartbeat_downsample(df, max_rows=50)) == expected
    assert ids(heartbeat_downsample(df, max_rows=9)) == expected


def stream(spark, root, **options):
    source = spark.readStream.schema(frame(spark, [("x", 0.0, 0, True)]).schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    stream_heartbeat_downsample(source, root, f"{root}/progress", **options).awaitTermination()
    return read_heartbeats(spark, root, tie_type="int")


def test_stream_equals_batch_in_any_order(spark, tmp_path):
    """Rows come in no order of time; the newest device's open end is there too."""
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), float(rng.randrange(0, 3000)), i, rng.random() < 0.05) for i in range(400)]
    rows += [("z", 100_000.0, 1000, False)]
    frame(spark, rows).repartition(3).write.parquet(str(tmp_path / "in"))
    got = stream(spark, str(tmp_path))
    assert ids(got) == simple(rows)
    assert {r.event_id for r in got.filter("not final").collect()} == {1000}


def test_rows_thirty_days_late_are_not_lost(spark, tmp_path):
    rng = random.Random(9)
    day = 86_400.0
    new = [("a", 40 * day + rng.randrange(3000), i, rng.random() < 0.02) for i in range(150)]
    late = [("a", 10 * day + rng.randrange(3000), 1000 + i, False) for i in range(100)] + [("a", 40 * day + 500.5, 2000, True)]
    frame(spark, new).write.parquet(str(tmp_path / "in"))
    assert ids(stream(spark, str(tmp_path))) == simple(new)
    frame(spark, late).write.mode("append").parquet(str(tmp_path / "in"))
    assert ids(stream(spark, str(tmp_path))) == simple(new + late)


def test_a_new_checkpoint_adds_to_a_root(spark, tmp_path, monkeypatch):
    """Three checkpoints, one of which breaks, is overtaken by another and then run again."""
    import tidemill.streaming.heartbeat as module

    rng = random.Random(8)
    rows = [(f"d{rng.randrange(3)}", rng.uniform(0, 900), i, rng.random() < 0.1) for i in range(240)]
    root = str(tmp_path / "root")

    def run(part):
        folder = str(tmp_path / f"in{part}")
        made = frame(spark, rows[part::3])
        made.write.mode("ignore").parquet(folder)
        source = spark.readStream.schema(made.schema).parquet(folder)
        stream_heartbeat_downsample(source, root, str(tmp_path / f"c{part}")).awaitTermination()

    def kept():
        return ids(read_heartbeats(spark, root, tie_type="int"))

    def broken(*_, **__):
        raise OSError("no room")

    run(0)
    with monkeypatch.context() as m:
        m.setattr(module, "heartbeat_downsample", broken)
        with pytest.raises(Exception, match="no room"):
            run(1)
    run(2)
    run(1)
    assert kept() == simple(rows)
    assert read_heartbeats(spark, root, tie_type="int").count() == len(simple(rows))
