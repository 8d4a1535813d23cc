"""Heartbeat sampling on a stream: the batch operator over what a micro-batch changes.

Three tables are kept, each batch under its own name and place: the rows seen, the rows kept, and for each
device of a batch the time from which the batch chose anew. A device's choices from that time on
depend only on its last kept row before and its rows since, so these are read back, also for rows
that come late; the choices of earlier batches from that time on are void. Batches are placed in the
order in which they run, whichever checkpoint they are of; streams of one root run one at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.heartbeat import heartbeat_downsample
from tidemill.schema import HEARTBEAT_SECONDS
from tidemill.streaming.store import AVAILABLE_NOW, batch_name, next_order, read_batches, stream_id, write_batch

_ROWS = "k string, tie {tie}, at timestamp, breach boolean"
_RESETS = "k string, since timestamp"


def _schema(tie: str) -> str:
    return _ROWS.format(tie=tie)


def _valid(spark: SparkSession, root: str, tie: str, below: int | None = None) -> DataFrame:
    """The kept rows that no later batch has chosen anew."""
    kept = read_batches(spark, f"{root}/kept", _schema(tie), below)
    later = Window.partitionBy("k").orderBy(F.desc("batch")).rowsBetween(Window.unboundedPreceding, -1)
    resets = read_batches(spark, f"{root}/resets", _RESETS, below).select(
        F.col("k").alias("rk"), F.col("batch").alias("rb"), F.min("since").over(later).alias("void_from"))
    joined = kept.join(resets, F.col("k").eqNullSafe(F.col("rk")) & (F.col("batch") == F.col("rb")))
    return joined.filter(F.col("void_from").isNull() | (F.col("at") < F.col("void_from"))).select("k", "tie", "at", "breach")


def stream_heartbeat_downsample(
    df: DataFrame, root: str, checkpoint: str, key: str = "device_id", at: str = "timestamp",
    breach: str = "breach", interval: float = HEARTBEAT_SECONDS, tie: str = "event_id",
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keeps the rows to forward of a stream in tables under ``root``."""
    tie_type = df.schema[tie].dataType.simpleString()

    def choose(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.filter(F.col(at).isNotNull()).select(
            F.col(key).cast("string").alias("k"), F.col(tie).alias("tie"), F.col(at).alias("at"), F.col(breach).alias("breach"))
        stream = stream_id(spark, checkpoint)
        place, broken = next_order(spark, f"{root}/rows", _schema(tie_type), stream, number)
        # What a broken run left is emptied, its rows last: other streams' batches may follow it.
        for old in broken:
            for table, schema in (("kept", _schema(tie_type)), ("resets", _RESETS), ("rows", _schema(tie_type))):
                write_batch(spark.createDataFrame([], schema), f"{root}/{table}", old)
        name = batch_name(stream, number, place)
        write_batch(rows, f"{root}/rows", name)
        seen = read_batches(spark, f"{root}/rows", _schema(tie_type), place + 1)
        new = seen.filter(F.col("batch") == place)
        write_batch(new.groupBy("k").agg(F.min("at").alias("since")), f"{root}/resets", name)
        since = read_batches(spark, f"{root}/resets", _RESETS, place + 1).filter(F.col("batch") == place).select(
            F.col("k").alias("rk"), "since")
        same = F.col("k").eqNullSafe(F.col("rk"))
        again = seen.join(since, same & (F.col("at") >= F.col("since"))).select("k", "tie", "at", "breach", F.lit(False).alias("old"))
        # The last kept row stands as a breach: it is kept whatever comes before.
        last = _valid(spark, root, tie_type, place).join(since, same & (F.col("at") < F.col("since"))).groupBy("k").agg(
            F.max_by(F.struct("tie", "at"), F.struct("at", "tie")).alias("r")).select(
            "k", "r.tie", "r.at", F.lit(True).alias("breach"), F.lit(True).alias("old"))
        kept = heartbeat_downsample(again.unionByName(last), "k", "at", "breach", interval, "tie")
        write_batch(kept.filter(~F.col("old")).select("k", "tie", "at", "breach"), f"{root}/kept", name)

    return df.writeStream.foreachBatch(choose).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_heartbeats(
    spark: SparkSession, root: str, key: str = "device_id", at: str = "timestamp", breach: str = "breach",
    tie: str = "event_id", tie_type: str = "bigint", delay: str = "1 minute",
) -> DataFrame:
    """The rows to forward so far. ``final`` is false at the open end: for rows not yet ``delay``
    older than the newest, which rows that are still on their way may void."""
    newest = read_batches(spark, f"{root}/rows", _schema(tie_type)).agg((F.max("at") - F.expr(f"INTERVAL {delay}")).alias("n"))
    return _valid(spark, root, tie_type).select(
        F.col("k").alias(key), F.col("tie").alias(tie), F.col("at").alias(at), F.col("breach").alias(breach)
    ).withColumn("final", F.col(at) <= newest.scalar())
