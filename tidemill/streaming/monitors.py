"""The dead-letter and ingest counters on streams.

A micro-batch adds its counts per window to a table; reading adds them up. So the open window and
rows that come late count too, and the result equals the batch operator's over all rows so far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions.scores import seconds_between
from tidemill.operators.monitoring import LAG_LIMIT_SECONDS, PERIODS, gaps_of_windows, lags_of_windows
from tidemill.streaming.store import AVAILABLE_NOW, batch_name, read_batches, stream_id, write_batch

_COUNTS = "window_start timestamp, n long, worst double"


def _count_windows(
    rows: DataFrame, table: str, checkpoint: str, at: str, width: str, worst: Column, trigger: dict
) -> StreamingQuery:
    def add(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy(F.window(at, width)).agg(
            F.count(F.lit(1)).alias("n"), F.max(worst).cast("double").alias("worst"))
        write_batch(counts.select(F.col("window.start").alias("window_start"), "n", "worst"), table, batch_name(
            stream_id(batch.sparkSession, checkpoint), number))

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _total(spark: SparkSession, table: str) -> DataFrame:
    return read_batches(spark, table, _COUNTS).groupBy("window_start").agg(
        F.sum("n").alias("n"), F.max("worst").alias("worst"))


def stream_dlq_volume(
    rejects: DataFrame, table: str, checkpoint: str, at: str = "dlq_timestamp", width: str = "5 minutes",
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keeps the rejects per window in ``table``."""
    return _count_windows(rejects, table, checkpoint, at, width, F.lit(None), trigger)


def read_dlq_volume(spark: SparkSession, table: str) -> DataFrame:
    """Rejects per window so far, as the batch operator gives them."""
    return _total(spark, table).select("window_start", F.col("n").alias("n_rejects"), (F.col("n") > 0).alias("alarm"))


def stream_ingest_windows(
    bronze: DataFrame, table: str, checkpoint: str, event_at: str = "timestamp", ingested_at: str = "_ingested_at",
    width: str = "5 minutes", trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keeps the rows and the largest lag per ingestion window in ``table``, from which the alarms are read."""
    lag = seconds_between(F.col(event_at), F.col(ingested_at))
    return _count_windows(bronze, table, checkpoint, ingested_at, width, lag, trigger)


def read_ingest_windows(spark: SparkSession, table: str) -> DataFrame:
    return _total(spark, table).select("window_start", F.col("n").alias("n_events"), F.col("worst").alias("max_lag_s"))


def read_gap_alarms(spark: SparkSession, table: str, width: str = "5 minutes", periods: int = PERIODS) -> DataFrame:
    """Every window from the first to the last with its count; the alarm is on where it and the windows
    before it, ``periods`` in all, are empty. A late row that fills one silences them."""
    return gaps_of_windows(_total(spark, table).select("window_start", F.col("n").alias("n_events")), width, periods)


def read_lag_alarms(
    spark: SparkSession, table: str, width: str = "5 minutes", limit: float = LAG_LIMIT_SECONDS, periods: int = PERIODS
) -> DataFrame:
    """The largest lag of each window; the alarm needs ``periods`` adjacent ones above the limit."""
    return lags_of_windows(_total(spark, table).select("window_start", F.col("worst").alias("max_lag_s")), width, limit, periods)
