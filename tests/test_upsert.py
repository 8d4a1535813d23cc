"""Upserts of a stream: equal to the batch operator, whatever is retried."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators.silver import dedup_latest
from tidemill.streaming import upsert

SCHEMA = "k long, v long, note string"
KEYS, ORDER = ["k"], ["v", "note"]


def rows_of(seed, n=400, keys=60):
    rng = random.Random(seed)
    return [(rng.randrange(keys) if rng.random() > 0.05 else None, rng.randrange(1000), f"n{rng.randrange(9)}") for _ in range(n)]


def stored(spark, table):
    return sorted(map(tuple, upsert.read_upserted(spark, table, spark.createDataFrame([], SCHEMA).schema).collect()), key=repr)


def latest(spark, rows):
    return sorted(map(tuple, dedup_latest(spark.createDataFrame(rows, SCHEMA), KEYS, ORDER).collect()), key=repr)


def files(table):
    return {f"{d}/{n}" for d, _, names in os.walk(table) for n in names if n.endswith(".parquet")}


def put(spark, table, rows, name, buckets=8):
    upsert.upsert_batch(spark.createDataFrame(rows, SCHEMA), table, name, KEYS, ORDER, buckets)


def test_any_order_of_batches_equals_the_batch_operator(spark, tmp_path):
    batches = [rows_of(i) for i in range(4)]
    for order in ((0, 1, 2, 3), (3, 1, 0, 2)):
        table = str(tmp_path / f"t{order[0]}")
        for n in order:
            put(spark, table, batches[n], f"{n}.s.{n}")
        assert stored(spark, table) == latest(spark, sum(batches, []))


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    put(spark, table, rows_of(1), "0.s.0")
    put(spark, table, rows_of(2), "1.s.1")
    before = stored(spark, table)
    for seed, name in ((2, "1.s.1"), (1, "0.s.0")):
        put(spark, table, rows_of(seed), name)
        assert stored(spark, table) == before


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = str(tmp_path / "t")
    put(spark, table, rows_of(1), "0.s.0", 16)
    before = files(table)
    put(spark, table, [(7, 5000, "new")], "1.s.1", 16)
    after = files(table)
    assert len(before - after) == len(after - before) == 1 and len(before) > 10
    put(spark, table, [], "2.s.2", 16)
    assert files(table) == after


@pytest.mark.parametrize("where", ["merged", "half placed"])
def test_a_broken_batch_is_finished_by_its_retry(spark, tmp_path, monkeypatch, where):
    """The driver is lost after the merge, or while buckets are put in place (old ones already gone)."""
    table = str(tmp_path / "t")
    put(spark, table, rows_of(1), "0.s.0")
    real = upsert._folder

    class Broken(Exception):
        pass

    def breaking(session, path):
        if path.endswith("1.s.1"):  # the last step: the pending folder would be removed
            raise Broken
        return real(session, path)

    monkeypatch.setattr(upsert, "_folder", breaking)
    with pytest.raises(Broken):
        put(spark, table, rows_of(2), "1.s.1")
    monkeypatch.setattr(upsert, "_folder", real)
    if where == "half placed":
        for f in sorted(files(table))[:3]:
            os.remove(f)
    put(spark, table, rows_of(2), "1.s.1")
    assert stored(spark, table) == latest(spark, rows_of(1) + rows_of(2))
    assert not files(f"{table}.pending")


def test_stream_with_restart(spark, tmp_path):
    source, table, progress = (str(tmp_path / n) for n in ("in", "t", "p"))
    everything = []
    for n in range(3):
        everything += rows_of(n, 200)
        spark.createDataFrame(rows_of(n, 200), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        upsert.stream_upsert(stream, table, progress, KEYS, ORDER, 8).awaitTermination()
        assert stored(spark, table) == latest(spark, everything)
    one = upsert.read_upserted(spark, table, spark.createDataFrame([], SCHEMA).schema)
    assert one.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def test_large_buckets_are_merged_in_parts(spark, tmp_path):
    """A bucket's rows go to several tasks and files."""
    table, batches = str(tmp_path / "t"), [rows_of(i, 3000, 900) for i in range(3)]
    for n, rows in enumerate(batches):
        upsert.upsert_batch(spark.createDataFrame(rows, SCHEMA), table, f"{n}.s.{n}", KEYS, ORDER, 2, rows_per_part=100)
        assert stored(spark, table) == latest(spark, sum(batches[: n + 1], []))
    sizes = [r.n for r in upsert._stored(spark, table, spark.createDataFrame([], SCHEMA).schema).groupBy(
        F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 8 and max(sizes) < 250
    put(spark, table, [(7, 5000, "new")], "9.s.9", 2)
    assert stored(spark, table) == latest(spark, sum(batches, []) + [(7, 5000, "new")])


def test_moved_files_survive_a_retry(spark, tmp_path, monkeypatch):
    """The driver is lost after some of the files were moved."""
    table = str(tmp_path / "t")
    put(spark, table, rows_of(1), "0.s.0")
    real, moved = upsert._folder, []

    class Stopping:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "rename":
                moved.append(name)
                assert len(moved) < 4, "lost"
            return getattr(self.fs, name)

    monkeypatch.setattr(upsert, "_folder", lambda session, path: (real(session, path)[0], Stopping(real(session, path)[1])))
    with pytest.raises(AssertionError, match="lost"):
        put(spark, table, rows_of(2), "1.s.1")
    monkeypatch.setattr(upsert, "_folder", real)
    assert files(f"{table}.pending")
    put(spark, table, rows_of(2), "1.s.1")
    assert stored(spark, table) == latest(spark, rows_of(1) + rows_of(2))
    assert not files(f"{table}.pending")
