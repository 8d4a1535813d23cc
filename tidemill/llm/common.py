"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tidemill.session import stable

#: A word: anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def one_row_each(df: DataFrame) -> DataFrame:
    """(row, own, mark): of the rows equal in doc_id and text one, the same in every run; ``own`` is the
    id and ``mark`` a hash of the text."""
    plain = [F.to_json(c) if isinstance(df.schema[c].dataType, (ArrayType, MapType, StructType)) else F.col(c) for c in df.columns]
    rows = df.select(F.struct("*").alias("row"), F.col("doc_id").alias("own"), F.xxhash64("text").alias("mark"), F.xxhash64(*plain).alias("_h"))
    return rows.groupBy("own", "mark").agg(F.min_by("row", "_h").alias("row")).select("row", "own", "mark")


@contextmanager
def _freed_shuffles(spark: SparkSession):
    """Spark deletes the shuffle files of what is run inside as soon as it has ended."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def settled(df: DataFrame) -> DataFrame:
    """``stable``: one written copy in the shared folder, read again; the shuffle files behind
    it are freed at once, so that a chain of steps needs the disk of one step only."""
    with _freed_shuffles(df.sparkSession):
        return stable(df)


def settled_if_any(df: DataFrame) -> DataFrame | None:
    """``settled``, or None if there are no rows. They are counted while they are written (a task that
    runs twice may count twice, which none at all never does)."""
    seen = Observation()
    out = settled(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return out if seen.get["n"] else None


def cell_counts(df: DataFrame, cells_of: Callable[[Iterator[pd.DataFrame]], Iterator[np.ndarray]], cells: int, segments: int = 256) -> np.ndarray:
    """How often ``cells_of`` names each of ``cells`` cells in all of ``df``, up to 65,535.

    Each task counts into an array and passes on the segments with counts; they are added up segment
    by segment as they stream in, so a task holds two arrays whatever the number of tasks."""
    most = 65_535

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch = np.zeros(cells, dtype=np.uint16)
        for found in cells_of(frames):
            at, n = np.unique(found, return_counts=True)
            sketch[at] = np.minimum(sketch[at] + n, most)
        parts = sketch.reshape(segments, -1)
        used = np.flatnonzero(parts.any(axis=1))
        yield pd.DataFrame({"segment": used.astype(np.int32), "counts": [zlib.compress(parts[i].tobytes(), 1) for i in used]})

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for f in frames:
            for i, packed in zip(f["segment"], f["counts"]):
                more = np.frombuffer(zlib.decompress(packed), np.uint16)
                total[i] = np.minimum(total[i].astype(np.int64) + more, most).astype(np.uint16) if i in total else more
        yield pd.DataFrame({"segment": np.array(list(total), np.int32), "counts": [zlib.compress(x.tobytes(), 1) for x in total.values()]})

    kind = "segment int, counts binary"
    out = np.zeros((segments, cells // segments), dtype=np.uint16)
    for row in df.mapInPandas(count, kind).repartition("segment").mapInPandas(fold, kind).collect():
        out[row["segment"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint16)
    return out.ravel()
