"""The landing tree: JSON lines by ingestion date, with dead letters beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.envelope import annotate_envelope, to_body, valid_rows
from tidemill.schema import LINE_HASH

DATE_PARTITIONS = ("year", "month", "day")
DEAD_LETTER_FOLDER = "_dlq"
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _dated(df: DataFrame, at: Column) -> DataFrame:
    return (
        df.withColumn("year", F.date_format(at, "yyyy"))
        .withColumn("month", F.date_format(at, "MM"))
        .withColumn("day", F.date_format(at, "dd"))
    )


def read_landing(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Raw lines with ``_source_file`` and ``_ingested_at`` from the file's own metadata.

    Folders starting with ``_`` are not read, which leaves the dead letters out. The date
    folders come back as partition columns, so a date filter prunes files.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("text").schema("value string, year string, month string, day string")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        "value",
        *DATE_PARTITIONS,
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_ingested_at"),
    )


def bronze_from_landing(landing: DataFrame) -> DataFrame:
    """Raw lines to bronze rows: envelope columns (payload as VARIANT) plus file metadata."""
    annotated = annotate_envelope(landing.drop(*DATE_PARTITIONS).withColumn(LINE_HASH, F.xxhash64("value")))
    return valid_rows(annotated).drop("value")


def write_landing(events: DataFrame, path: str, at: Column | None = None) -> None:
    """Append envelope rows as compact JSON lines under the *ingestion* date."""
    ingested = F.current_timestamp() if at is None else at
    _dated(to_body(events), ingested).write.mode("append").partitionBy(*DATE_PARTITIONS).text(path)


def write_dead_letters(rejects: DataFrame, path: str, batch: str | None = None) -> None:
    """Append (raw_body, error_reason, dlq_timestamp) to the landing's dead-letter folder; with the
    name of a stream's ``batch`` (``store.batch_name``: no other stream's batch has it), to a folder
    of its own, which a second run replaces."""
    folder = f"{path}/{DEAD_LETTER_FOLDER}" + ("" if batch is None else f"/batch={batch}")
    _dated(rejects, F.col("dlq_timestamp")).write.mode("append" if batch is None else "overwrite").partitionBy(
        *DATE_PARTITIONS
    ).option("timestampFormat", MICROSECONDS).json(folder)


def read_dead_letters(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Dead letters of a landing tree; ``multi_line`` for indented one-record files."""
    return (
        spark.read.schema("raw_body string, error_reason string, dlq_timestamp timestamp")
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)  # with and without a batch's folder
        .json(f"{path}/{DEAD_LETTER_FOLDER}")
        .select("raw_body", "error_reason", "dlq_timestamp")
    )
