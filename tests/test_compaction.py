"""Clustering along a curve and merging of small files."""

import os
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tidemill.operators.clustering import interleaved, quantiles, rank
from tidemill.sources import tables
from tidemill.sources.tables import POINTER, compact_small_files, compact_table, current_paths, file_sizes, plan_bins, read_current, write_gold


def files_under(path):
    return {f"{d}/{n}": os.path.getsize(f"{d}/{n}") for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def skipped(paths, column, low, high):
    """The part of the row groups that the statistics of a column rule out."""
    out = Counter()
    for path in paths:
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            out[s.max < low or s.min > high] += 1
    return out[True] / out.total()


def test_filters_on_either_column_skip_files(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.range(60_000).select(
        (F.xxhash64("id") % 1000).alias("device"), (F.xxhash64("id", F.lit(1)) % 100_000).alias("at"), "id", F.sha2(F.col("id").cast("string"), 256).alias("fill"))
    write_gold(rows.repartition(8), table)
    total = sum(files_under(current_paths(spark, table)[0]).values())
    compact_table(spark, table, ["device", "at"], total // 40)
    files = files_under(current_paths(spark, table)[0])
    assert 20 < len(files) < 60
    assert skipped(files, "device", 100, 110) > 0.5 and skipped(files, "at", 5_000, 5_500) > 0.5
    assert read_current(spark, table).exceptAll(rows).isEmpty() and read_current(spark, table).count() == 60_000


def test_large_files_are_sorted_in_pieces(spark, tmp_path, monkeypatch):
    """No task sorts a whole file of the target size, and filters still skip row groups of it."""
    sorted_rows = []
    monkeypatch.setattr(tables, "PIECE_ROWS", 5_000)
    real = DataFrame.sortWithinPartitions

    def counting(df, *order):
        sorted_rows.extend(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return real(df, *order)

    monkeypatch.setattr(DataFrame, "sortWithinPartitions", counting)
    table = str(tmp_path / "t")
    rows = spark.range(60_000).select(
        (F.xxhash64("id") % 1000).alias("device"), (F.xxhash64("id", F.lit(1)) % 100_000).alias("at"), "id", F.sha2(F.col("id").cast("string"), 256).alias("fill"))
    write_gold(rows.repartition(8), table)
    total = sum(files_under(current_paths(spark, table)[0]).values())
    spark.conf.set("parquet.block.size", total // 40)
    try:
        compact_table(spark, table, ["device", "at"], total // 3)
    finally:
        spark.conf.unset("parquet.block.size")
    files = files_under(current_paths(spark, table)[0])
    assert len(sorted_rows) >= 12 and max(sorted_rows) < 12_000 and len(files) <= 4
    assert skipped(files, "device", 100, 110) > 0.5 and skipped(files, "at", 5_000, 5_500) > 0.5
    assert read_current(spark, table).exceptAll(rows).isEmpty() and read_current(spark, table).count() == 60_000
    one = str(tmp_path / "one")
    write_gold(rows.repartition(8), one)
    compact_table(spark, one, ["device", "at"])
    assert len(files_under(current_paths(spark, one)[0])) == 1


def test_keys_interleave_bits(spark):
    got = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a long, b long").select(
        "a", "b", interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect()
    for r in got:
        assert r.z == sum(((r.a >> j) & 1) << (2 * j) | ((r.b >> j) & 1) << (2 * j + 1) for j in range(3))
    with pytest.raises(ValueError):
        interleaved([F.lit(0)] * 32, 2)


def test_ranks_count_the_cuts_below(spark):
    values = [None, "", "a", "b", "bb", "z", "é"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "s string, n int")
    cuts = ["a", "b", "c", "z"]
    got = {r.s: r.k for r in df.select("s", rank(F.col("s"), cuts).alias("k")).collect()}
    assert got == {v: 0 if v is None else sum(c <= v for c in cuts) for v in values}
    assert quantiles(df.filter("false"), ["s", "n"]) == {"s": [], "n": []}
    found = quantiles(spark.range(1000).selectExpr("id", "id % 2 AS two", "null AS none"), ["id", "two", "none"], 3)
    assert found == {"id": [125, 250, 375, 500, 625, 750, 875], "two": [0, 1], "none": []}


def test_only_small_files_are_merged(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.range(300_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("fill"), F.lit("x").alias("_bin"))
    write_gold(rows.filter("id < 3000").repartition(200), table)
    (folder,) = current_paths(spark, table)
    for i in range(3):  # three large files beside 200 small ones
        big = str(tmp_path / f"big{i}")
        rows.filter(f"id >= 3000 and id % 3 = {i}").coalesce(1).write.parquet(big)
        (path,) = files_under(big)
        os.rename(path, f"{folder}/{os.path.basename(path)}")
    before = files_under(table)
    large = {p: n for p, n in before.items() if n > 1_000_000}
    assert len(large) == 3 and len(before) == 203
    compact_small_files(spark, table, 2 * min(large.values()))
    after = files_under(table)
    new = set(after) - set(before)
    assert len(new) == 1 and sum(after[p] for p in new) <= sum(n for p, n in before.items() if p not in large)
    used = {r.path.removeprefix("file:") for r in file_sizes(spark, current_paths(spark, table)).collect()}
    assert used == new | set(large)
    assert read_current(spark, table).count() == 300_000 and read_current(spark, table).select("id").distinct().count() == 300_000
    compact_small_files(spark, table, 2 * min(large.values()))  # nothing left to merge
    assert files_under(table) == after
    with open(f"{table}/{POINTER}") as f:
        assert len(f.read().split("\n")) == 4


def test_bins_are_filled_without_overflow():
    files = [(f"f{i}", 10 + i % 37) for i in range(300)] + [("large", 60), ("larger", 500)]
    bins = plan_bins(files, 100)
    sizes = dict(files)
    assert all(sum(sizes[p] for p in b) <= 100 for b in bins) and len(bins) <= 1.3 * sum(n for _, n in files[:300]) / 100
    assert sorted(p for b in bins for p in b) == sorted(f for f, _ in files[:300])
    assert plan_bins([("a", 1)], 100) == [] and plan_bins([], 100) == []
