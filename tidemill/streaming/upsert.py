"""Latest-wins upserts of a stream: one row for each key, in hash buckets.

A micro-batch reads and rewrites only the buckets its keys fall in, so its cost follows the batch and
the size of a bucket, not the number of earlier batches. Buckets of many rows are merged in parts, one
task and one file each. The merged buckets are written to a folder of the batch first; then the
files are moved to the place of the stored ones. A batch that
broke while it was put in place is put in place again from that folder; one that broke before, or
runs again after it was done, is merged anew, which changes nothing: merging is idempotent and the
order of batches doesn't matter. Streams of one table run one at a time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemill.operators.silver import dedup_latest
from tidemill.streaming.store import AVAILABLE_NOW, batch_name, stream_id

BUCKETS = 256
ROWS_PER_PART = 500_000
_BUCKET, _PART = "_bucket", "_part"
_CLEARED = "_CLEARED"


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _is_there(spark: SparkSession, path: str) -> bool:
    where, fs = _folder(spark, path)
    return fs.exists(where)


def _with_bucket(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(_BUCKET, IntegerType())])


def _stored(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    full = _with_bucket(schema)
    return spark.read.schema(full).parquet(table) if _is_there(spark, table) else spark.createDataFrame([], full)


def _merged(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str], touched: list[int], parts: int) -> DataFrame:
    """One shuffle and one sort serve the choice of rows and the writing by bucket."""
    place = F.array_position(F.array(*[F.lit(b) for b in touched]), F.col(_BUCKET)) - 1
    part = F.pmod(F.shiftright(F.xxhash64(*keys), 32), F.lit(parts))  # bits that the bucket leaves
    both = old.unionByName(new).withColumn(_PART, (place * parts + part).cast("int"))
    dealt = both.repartitionById(len(touched) * parts, _PART)
    return dedup_latest(dealt, [_BUCKET, _PART, *keys], order).drop(_PART)


def _put_in_place(spark: SparkSession, pending: str, table: str) -> None:
    """Moves a batch's files to the table. Its buckets are emptied before the first one comes, and a
    marker tells so: a retry deletes no file that was moved. Files are moved one by one, as the move
    of a folder is not a single step on every file system."""
    where, fs = _folder(spark, pending)
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = [s.getPath().getName() for s in fs.listStatus(where)]
    touched = [name for name in found if name.startswith(f"{_BUCKET}=")]
    if _CLEARED not in found:
        for name in touched:
            fs.delete(path(f"{table}/{name}"), True)
        fs.createNewFile(path(f"{pending}/{_CLEARED}"))
    for name in touched:
        fs.mkdirs(path(f"{table}/{name}"))
        for file in fs.listStatus(path(f"{pending}/{name}")):
            to = path(f"{table}/{name}/{file.getPath().getName()}")
            fs.delete(to, False)  # a copy whose origin is still here
            if not fs.rename(file.getPath(), to):
                raise OSError(f"{file.getPath()} was not moved to {to}")
    fs.delete(where, True)


def upsert_batch(
    batch: DataFrame, table: str, name: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS,
    rows_per_part: int = ROWS_PER_PART,
) -> None:
    """Merges a batch: of the stored and new rows of a key the one with the greatest ``order`` stays."""
    spark, pending = batch.sparkSession, f"{table}.pending/{name}"
    if not _is_there(spark, f"{pending}/_SUCCESS"):
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        new = dedup_latest(batch, keys, order).withColumn(_BUCKET, bucket).persist()
        try:
            found = {r[_BUCKET]: r["n"] for r in new.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
            if not found:
                return
            touched = sorted(found)
            old = _stored(spark, table, batch.schema).filter(F.col(_BUCKET).isin(touched))
            parts = max(1, math.ceil((old.count() + sum(found.values())) / (len(touched) * rows_per_part)))
            merged = _merged(old, new, keys, order, touched, parts)
            merged.write.mode("overwrite").partitionBy(_BUCKET).parquet(pending)
        finally:
            new.unpersist()
    _put_in_place(spark, pending, table)


def stream_upsert(
    rows: DataFrame, table: str, checkpoint: str, keys: Sequence[str], order: Sequence[str],
    buckets: int = BUCKETS, trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keeps in ``table`` what ``dedup_latest`` gives for all rows of a stream so far. The number of
    buckets belongs to the table and must not change."""
    def merge(batch: DataFrame, number: int) -> None:
        name = batch_name(stream_id(batch.sparkSession, checkpoint), number)
        upsert_batch(batch, table, name, keys, order, buckets)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_upserted(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The rows so far; ``schema`` is that of the stream."""
    return _stored(spark, table, schema).drop(_BUCKET)
