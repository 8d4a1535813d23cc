"""Parquet tables published by version, and their compaction.

A table is a folder of versions plus a small pointer file naming the current one. A version is
written whole, checked, and only then named; readers never see a half-written or failed one. After
a compaction the pointer also names the large files of older versions that were left as they are.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.expectations import ExpectationFailed, holds
from tidemill.operators.clustering import z_order

POINTER = "CURRENT"
TARGET_FILE_BYTES = 512 * 1024 * 1024
PIECE_BYTES, PIECE_ROWS = 32 * 1024 * 1024, 500_000


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """Scan a Parquet table; projection and filter reach the files."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df if columns is None else df.select(*columns)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _set_pointer(spark: SparkSession, table: str, version: str, kept: Sequence[str] = ()) -> None:
    jvm, _, fs = _file_system(spark, table)
    new = jvm.org.apache.hadoop.fs.Path(f"{table}/{POINTER}.{version}")
    out = fs.create(new, True)
    out.write(bytearray("\n".join([version, *kept]).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    overwrite = spark.sparkContext._gateway.new_array(
        jvm.org.apache.hadoop.fs.Options.Rename, 1
    )
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{table}/{POINTER}"), overwrite)


def current_version(spark: SparkSession, table: str) -> str:
    """The folder that was written last."""
    return spark.read.text(f"{table}/{POINTER}").first()["value"]


def current_paths(spark: SparkSession, table: str) -> list[str]:
    """What the current version is made of: folders and files under ``table``."""
    return [f"{table}/{r['value']}" for r in spark.read.text(f"{table}/{POINTER}").collect() if r["value"]]


def read_current(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(*current_paths(spark, table))


def write_gold(
    df: DataFrame, table: str, expectations: Mapping[str, str] | None = None
) -> DataFrame:
    """Publish ``df`` as the table's new version and return it as read back.

    Violations are counted while the rows are written, not by a second computation; any
    violation leaves the table at its previous version and raises.
    """
    spark = df.sparkSession
    version = f"v{uuid.uuid4().hex}"
    seen = Observation(f"expectations-{version}")
    checked = df
    if expectations:
        counts = [F.count_if(~holds(p)).alias(n) for n, p in expectations.items()]
        checked = df.observe(seen, *counts)
    checked.write.parquet(f"{table}/{version}")
    if expectations:
        broken = {n: c for n, c in seen.get.items() if c}
        if broken:
            raise ExpectationFailed(f"{table} not published: {broken}")
    _set_pointer(spark, table, version)
    return spark.read.parquet(f"{table}/{version}")


def file_sizes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, length) of the data files; only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.select("path", "length")


def plan_bins(files: Sequence[tuple[str, int]], target_bytes: int) -> list[list[str]]:
    """Groups of files of about ``target_bytes`` each: first fit, the largest first. Files of at least
    half of that, and groups of one, are left out."""
    bins: list[tuple[int, list[str]]] = []
    room: list[int] = []
    for path, length in sorted((f for f in files if f[1] * 2 < target_bytes), key=lambda f: (-f[1], f[0])):
        at = next((i for i, left in enumerate(room) if left >= length), None)
        if at is None:
            bins.append((0, []))
            room.append(target_bytes)
            at = len(room) - 1
        bins[at] = bins[at][0] + length, [*bins[at][1], path]
        room[at] -= length
    return [paths for _, paths in bins if len(paths) > 1]


def compact_table(
    spark: SparkSession,
    table: str,
    cluster_by: Sequence[str],
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Rewrite the current version into files of about ``target_bytes``, clustered along a
    space-filling curve through ``cluster_by``, so that a filter on any of these columns skips files
    and row groups. Readers keep the old version until the new one is complete.
    """
    paths = current_paths(spark, table)
    total = file_sizes(spark, paths).agg(F.sum("length")).first()[0] or 0
    n_files = max(1, math.ceil(total / target_bytes))
    rows = spark.read.parquet(*paths)
    order = [z_order(rows, cluster_by).alias("_z"), *cluster_by]
    pieces = math.ceil(max(total / PIECE_BYTES, rows.count() / PIECE_ROWS) / n_files)
    return write_gold(_in_order(rows, n_files, pieces, order), table)


def _in_order(rows: DataFrame, n_files: int, pieces: int, order: Sequence[Column | str]) -> DataFrame:
    """Rows of ``n_files`` tasks, each a range in order. With several pieces a file they are sorted piece
    by piece, in tasks that don't grow with the table or the target; what writes a file takes its pieces
    one after the other, each still in order, whichever comes first."""
    sorted_ = rows.repartitionByRange(n_files * max(1, pieces), *order).sortWithinPartitions(*order)
    if pieces <= 1:
        return sorted_
    file = F.floor(F.spark_partition_id() / F.lit(pieces)).cast("int")
    return sorted_.withColumn("_file", file).repartitionById(n_files, "_file").drop("_file")


def compact_small_files(spark: SparkSession, table: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Merge the files below half of ``target_bytes`` into files of about that size; the others are
    not touched and stay where they are. What is read and written is bounded by the small files.
    Rows of a file stay together, so files keep the time range that their ingestion gave them."""
    files = [(r["path"], r["length"]) for r in file_sizes(spark, current_paths(spark, table)).collect()]
    bins = plan_bins(files, target_bytes)
    if not bins:
        return read_current(spark, table)
    merged = {path: number for number, paths in enumerate(bins) for path in paths}
    # one row for each small file: names and numbers only
    numbers = spark.createDataFrame(list(merged.items()), "_path string, _bin int")
    rows = spark.read.parquet(*merged).select(F.struct("*").alias("row"), F.col("_metadata.file_path").alias("_of"))
    binned = rows.join(F.broadcast(numbers), F.col("_of") == F.col("_path")).repartitionById(len(bins), "_bin").select("row.*")
    version = f"v{uuid.uuid4().hex}"
    binned.write.parquet(f"{table}/{version}")
    root = spark.read.format("binaryFile").load(f"{table}/{POINTER}").select("path").first()["path"].removesuffix(POINTER)
    _set_pointer(spark, table, version, [path.removeprefix(root) for path, _ in files if path not in merged])
    return read_current(spark, table)


def compact_tables(
    spark: SparkSession, tables: Mapping[str, Sequence[str]], target_bytes: int = TARGET_FILE_BYTES
) -> list[str]:
    """Compact every table; one failure does not stop the rest, all are raised at the end."""
    done, failed = [], []
    for table, cluster_by in tables.items():
        try:
            compact_table(spark, table, cluster_by, target_bytes)
            done.append(table)
        except Exception as error:  # noqa: BLE001 - collected and raised below
            failed.append(f"{table}: {error}")
    if failed:
        raise RuntimeError(f"{len(failed)} table(s) not compacted:\n" + "\n".join(failed))
    return done
