"""Session settings and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Correctness settings every job needs; sizing stays with the cluster's own configuration.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """Session builder; keyword ``conf`` entries use ``__`` for the dots of a setting's name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **ADAPTIVE_CONF}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship_package(builder.getOrCreate())


def apply_semantics(spark: SparkSession) -> SparkSession:
    """Prepare a session made elsewhere: pin the settings the results depend on and give the
    Python workers this package."""
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send the package to the executors (once per application), for the functions that run in
    Python workers."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        target = f"{tempfile.mkdtemp(prefix='spark-')}/{package.name}"
        archive = shutil.make_archive(target, "zip", package.parent, package.name)
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that all of them share")
    # Only a local session without the setting (a test) gets a folder of its own.
    local = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


_SCRATCH: list[tuple[str, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark.sparkContext.applicationId, path))
    return path


def discard_scratch(spark: SparkSession) -> int:
    """Delete the application's tables under the shared folder, whose results are then no longer
    readable: the last step of a job. Returns their number."""
    mine = [path for owner, path in _SCRATCH if owner == spark.sparkContext.applicationId]
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    for path in mine:
        where = hadoop.Path(path)
        where.getFileSystem(conf).delete(where, True)
    _SCRATCH[:] = [entry for entry in _SCRATCH if entry[1] not in mine]
    return len(mine)


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read that: later plans see one fixed
    copy, with its lineage cut, and columnar scans of it. (``checkpoint`` would compute the
    rows twice, once to count and once to write.)"""
    spark = df.sparkSession
    path = scratch_path(spark, "stable")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
