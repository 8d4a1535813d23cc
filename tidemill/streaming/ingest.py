"""Landing and bronze as streams. The engine commits a batch only after its files are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.envelope import annotate_envelope, reject_rows, valid_rows
from tidemill.sources.landing import bronze_from_landing, read_landing, write_dead_letters, write_landing
from tidemill.streaming.store import AVAILABLE_NOW, batch_name, stream_id


def _land(batch: DataFrame, name: str, landing: str) -> None:
    """Valid rows to the landing, the others to the dead letters of this batch.

    A batch that is run again appends the same events again, with the same ids, of which Silver
    keeps one each; its dead letters, which have no id, replace those of the first run.
    """
    annotated = annotate_envelope(batch.select("value")).persist()
    try:
        write_dead_letters(reject_rows(annotated), landing, batch=name)
        write_landing(valid_rows(annotated), landing)
    finally:
        annotated.unpersist()


def stream_to_landing(
    lines: DataFrame, landing: str, checkpoint: str, trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Validate a stream of raw lines (column ``value``) into a landing tree, which several streams
    may share."""
    def land(batch: DataFrame, number: int) -> None:
        _land(batch, batch_name(stream_id(batch.sparkSession, checkpoint), number), landing)

    return (
        lines.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """New landing files to the append-only bronze table; a restart resumes after the last
    committed batch and the file sink ignores the leftovers of a broken one."""
    rows = bronze_from_landing(
        read_landing(spark, landing, streaming=True, max_files_per_trigger=max_files_per_trigger)
    )
    return (
        rows.writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
