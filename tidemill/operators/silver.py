"""Silver tables: clean, quarantine, deduplicate, flatten by configuration."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tidemill.config import AssetConfig, AssetConfigError
from tidemill.functions.expectations import broken_names, expect
from tidemill.schema import FLAT_ENVELOPE, LINE_HASH

# One set of predicates decides both what is cleaned and what is quarantined.
CLEAN_PREDICATES: dict[str, str] = {
    "invalid_event_id": "event_id IS NOT NULL AND trim(event_id) <> ''",
    "invalid_device_id": "device_id IS NOT NULL AND trim(device_id) <> ''",
    "invalid_asset_type": "asset_type IS NOT NULL AND trim(asset_type) <> ''",
    "null_timestamp": "try_to_timestamp(timestamp) IS NOT NULL",
}


def select_valid(bronze: DataFrame) -> DataFrame:
    """Rows that pass every check, with the event time parsed; duplicates still in."""
    return expect(bronze, CLEAN_PREDICATES).select(
        "event_id",
        "device_id",
        "asset_type",
        "schema_version",
        "priority",
        "payload",
        F.try_to_timestamp("timestamp").alias("timestamp"),
        "_source_file",
        "_ingested_at",
        *([LINE_HASH] if LINE_HASH in bronze.columns else []),
    )


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Keep the row with the greatest ``order`` values per key.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the
    shuffle, so a key with many copies moves only one row per task. List enough order columns
    to break ties, or the choice among equal rows is open.
    """
    latest_first = [
        F.desc_nulls_last(c) if isinstance(c, str) else c.desc_nulls_last() for c in order
    ]
    spec = Window.partitionBy(*keys).orderBy(*latest_first)
    return df.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


def clean_events(bronze: DataFrame) -> DataFrame:
    """Valid events, the newest copy of each id (invalid copies never hide a valid one).

    Copies of the same time and file are told apart by the hash of their line, taken when it was
    parsed; for bronze rows without one it is worked out from the columns."""
    valid = select_valid(bronze)
    tie = F.col(LINE_HASH) if LINE_HASH in valid.columns else F.xxhash64(
        "device_id", "asset_type", "timestamp", "priority", "schema_version", F.to_json("payload"))
    return dedup_latest(valid, ["event_id"], [F.col("_ingested_at"), F.col("_source_file"), tie]).drop(LINE_HASH)


def quarantine_events(bronze: DataFrame) -> DataFrame:
    """The exact complement of ``select_valid``, with the names of the failed checks."""
    return bronze.withColumn("_quarantine_reason", broken_names(CLEAN_PREDICATES)).filter(
        F.size("_quarantine_reason") > 0
    )


def source_path_exists(schema: StructType, path: str) -> bool:
    """Whether a dotted path resolves through nested structs."""
    current: DataType = schema
    for step in path.split("."):
        if not isinstance(current, StructType) or step not in current.fieldNames():
            return False
        current = current[step].dataType
    return True


def _from_variant(path: str, spark_type: str) -> Column:
    root, _, rest = path.partition(".")
    if not rest:
        return F.expr(f"try_cast(`{root}` AS {spark_type})")
    steps = "".join(f"[\"{s}\"]" for s in rest.split("."))
    return F.expr(f"try_variant_get(`{root}`, '${steps}', '{spark_type}')")


def _from_struct(schema: StructType, path: str, spark_type: str) -> Column:
    if not source_path_exists(schema, path):
        return F.lit(None).cast(spark_type)
    return F.col(path).try_cast(spark_type)


def flatten_payload(cleaned: DataFrame, config: AssetConfig) -> DataFrame:
    """Envelope columns plus every configured path in its declared type.

    A path that is absent, null or not castable gives a typed NULL; no row ever fails.
    ``payload`` may be VARIANT (each field is looked up per row) or a struct.
    """
    schema = cleaned.schema
    structured = isinstance(schema["payload"].dataType, StructType)
    fields = [
        (_from_struct(schema, f.source, f.spark_type) if structured
         else _from_variant(f.source, f.spark_type)).alias(f.target)
        for f in config.fields
    ]
    ordering = [c for c in ("_ingested_at", "_source_file") if c in cleaned.columns]
    rows = cleaned.filter(F.col("asset_type") == config.asset_type)
    # Cleaned events are already unique by event_id; other declared keys need their own pass.
    if config.deduplicate and config.primary_key != ("event_id",):
        flat = rows.select(*FLAT_ENVELOPE, *fields, *ordering)
        newest = [F.col(c) for c in (*ordering, "timestamp", "event_id")]
        return dedup_latest(flat, config.primary_key, newest).drop(*ordering)
    return rows.select(*FLAT_ENVELOPE, *fields)


def fan_out_assets(cleaned: DataFrame, configs: Iterable[AssetConfig]) -> dict[str, DataFrame]:
    """One lazy flattened table per configuration, keyed by table name."""
    tables = {c.silver_table: flatten_payload(cleaned, c) for c in configs}
    if not tables:
        raise AssetConfigError("no asset type configuration given")
    return tables
