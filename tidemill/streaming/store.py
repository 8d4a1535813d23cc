"""Tables that streams keep up to date: one folder per micro-batch, replaced if it is run again.

A batch writes only under its own name, so a retry leaves no second copy, and what is read is
combined over all batches. Nothing waits for a watermark, and no row is too late. Every checkpoint
counts its batches from 0, so a name holds the id of the stream too: a second stream, or one that
starts again with a new checkpoint, adds to a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AVAILABLE_NOW = {"availableNow": True}
_FIRST = "batch=-1"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id in a checkpoint's metadata: it stays when the stream is restarted from there; a new
    checkpoint has another one, at the same path too."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def batch_name(stream: str, number: int, order: int | None = None) -> str:
    """The name of a stream's micro-batch, led by its place among the batches of all streams where
    that matters (``next_order``)."""
    return f"{number if order is None else order}.{stream}.{number}"


def write_batch(df: DataFrame, table: str, batch: str) -> None:
    df.write.mode("overwrite").parquet(f"{table}/batch={batch}")


def read_batches(spark: SparkSession, table: str, schema: str, below: int | None = None) -> DataFrame:
    """All batches' rows with their place as ``batch``; only those placed lower than ``below``."""
    rows = _named(spark, table, schema).withColumn("batch", _place())
    return rows if below is None else rows.filter(f"batch < {below}")


def next_order(spark: SparkSession, table: str, schema: str, stream: str, number: int) -> tuple[int, list[str]]:
    """The place after all batches with rows in ``table``, whichever stream wrote them, and the
    names under which an earlier run of this batch left rows there."""
    own = F.when(F.col("batch").endswith(f".{stream}.{number}"), F.col("batch"))
    found = _named(spark, table, schema).agg(F.max(_place()).alias("last"), F.collect_set(own).alias("own")).first()
    return 1 + (-1 if found["last"] is None else found["last"]), list(found["own"])


def _named(spark: SparkSession, table: str, schema: str) -> DataFrame:
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").parquet(f"{table}/{_FIRST}")
    return spark.read.schema(f"{schema}, batch string").parquet(table)


def _place() -> Column:
    return F.substring_index("batch", ".", 1).cast("long")
