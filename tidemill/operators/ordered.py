"""Ordered computations inside keyed groups that stay parallel when one key is hot.

A plain window sends a whole key to one task. Here the rows of each key that exceeds
``max_rows`` are range-partitioned on (key, order), so that one key spans many chunks:

* fixed frames (``lag``, the last k rows) get the k rows before each chunk copied into it;
* running values (sum, max, last) are computed inside each chunk and combined with the
  value carried in from the chunks before, found on one small row per chunk.

Only the first key of a chunk can have begun in an earlier chunk, so the carried table has
at most one row per chunk: that is the size bound behind broadcasting it.
Keys below the limit keep the plain one-shuffle window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemill.session import stable

MAX_ROWS_PER_TASK = 4_000_000
MAX_HOT_KEYS = 10_000

_CHUNK = "_chunk"
_HALO = "_halo"


def _renamed(names: Sequence[str]) -> list[Column]:
    return [F.col(n).alias(f"_of_{n}") for n in names]


def _matches(names: Sequence[str]) -> Column:
    """Null-safe equality of columns with their copies made by ``_renamed``."""
    pairs = (F.col(n).eqNullSafe(F.col(f"_of_{n}")) for n in names)
    return reduce(lambda a, b: a & b, pairs)


def split_hot_rows(
    df: DataFrame, keys: Sequence[str], max_rows: int, sizes: DataFrame | None = None
) -> tuple[DataFrame | None, DataFrame | None, int]:
    """(rows of ordinary keys, rows of keys above ``max_rows``, number of hot rows).

    Runs one aggregation of the key columns, or of ``sizes``, the rows (keys, _n) of a count that
    the caller has already. At most ``MAX_HOT_KEYS`` keys reach the driver; with more than that
    the whole input takes the hot way.
    """
    if sizes is None:
        sizes = df.select(*keys, F.lit(1).alias("_n"))
    sizes = sizes.groupBy(*keys).agg(F.sum("_n").alias("_n"))
    hot = sizes.filter(F.col("_n") > max_rows).limit(MAX_HOT_KEYS + 1).collect()
    if not hot:
        return df, None, 0
    if not keys or len(hot) > MAX_HOT_KEYS:
        # without keys the one row found holds the number of all rows
        total = hot[0]["_n"] if not keys else df.count()
        return None, df, total
    schema = df.select(*keys).schema
    found = df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], schema)
    found = F.broadcast(found.select(*_renamed(keys)))
    condition = _matches(keys)
    return (
        df.join(found, condition, "left_anti"),
        df.join(found, condition, "left_semi"),
        sum(r["_n"] for r in hot),
    )


@dataclass(frozen=True)
class OrderedRuns:
    """Rows grouped by ``keys`` and totally ordered (ascending) by ``order`` inside a group."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunked: bool

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        max_rows: int = MAX_ROWS_PER_TASK,
        sizes: DataFrame | None = None,
    ) -> OrderedRuns:
        cold, hot, n_hot = split_hot_rows(df, keys, max_rows, sizes)
        if hot is None:
            return cls(df, tuple(keys), tuple(order), False)
        n_chunks = max(2, math.ceil(n_hot / max_rows))
        hot = stable(
            hot.repartitionByRange(n_chunks, *keys, *order).withColumn(
                _CHUNK, F.spark_partition_id()
            )
        )
        both = hot if cold is None else cold.withColumn(_CHUNK, F.lit(-1)).unionByName(hot)
        return cls(both, tuple(keys), tuple(order), True)

    @property
    def _parts(self) -> list[str]:
        return [*self.keys, _CHUNK] if self.chunked else list(self.keys)

    def _with(self, df: DataFrame) -> OrderedRuns:
        return OrderedRuns(df, self.keys, self.order, self.chunked)

    def window(self) -> WindowSpec:
        """Partition and order of the rows that share one task."""
        return Window.partitionBy(*self._parts).orderBy(*self.order)

    def frame(self, lookback: int, **columns: Callable[[WindowSpec], Column]) -> OrderedRuns:
        """Add columns that look at no more than ``lookback`` rows before the current one."""
        source = self._with_halo(lookback) if self.chunked else self.df
        spec = self.window()
        out = source.select("*", *[make(spec).alias(name) for name, make in columns.items()])
        if self.chunked:
            out = out.filter(~F.col(_HALO)).drop(_HALO)
        return self._with(out)

    def _with_halo(self, k: int) -> DataFrame:
        names = self.df.columns
        newest_first = Window.partitionBy(*self._parts).orderBy(
            *[F.desc_nulls_last(c) for c in self.order]
        )
        tails = (
            self.df.filter(F.col(_CHUNK) >= 0)
            .withColumn("_back", F.row_number().over(newest_first))
            .filter(F.col("_back") <= k)
            .groupBy(*self._parts)
            .agg(
                F.sort_array(
                    F.collect_list(F.struct((-F.col("_back")).alias("_at"), *names))
                ).alias("_tail")
            )
        )
        # Every chunk row is non-empty, so the k chunks before hold the k rows before.
        chunks_before = (
            Window.partitionBy(*self.keys).orderBy(_CHUNK).rowsBetween(-k, Window.currentRow - 1)
        )
        received = (
            tails.select(
                F.col(_CHUNK).alias("_to"),
                F.flatten(F.collect_list("_tail").over(chunks_before)).alias("_rows"),
            )
            .select("_to", F.expr(f"slice(_rows, greatest(size(_rows) - {k - 1}, 1), {k})").alias("_rows"))
            .select("_to", F.explode("_rows").alias("_row"))
            .select(*[F.col(f"_row.{n}").alias(n) if n != _CHUNK else F.col("_to").alias(n)
                      for n in names])
        )
        return self.df.withColumn(_HALO, F.lit(False)).unionByName(
            received.withColumn(_HALO, F.lit(True))
        )

    def running(self, **columns: tuple[str, Column]) -> OrderedRuns:
        """Add values accumulated from the first row of the key up to the current one.

        Each column is (kind, expression) with kind ``sum``, ``max`` or ``last`` (the latest
        non-null value).
        """
        so_far = self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = self.df.select(
            *self.df.columns,
            *[_accumulate(kind, c).over(so_far).alias(n) for n, (kind, c) in columns.items()],
        )
        if not self.chunked:
            return self._with(out)

        before = (
            Window.partitionBy(*self.keys)
            .orderBy(_CHUNK)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
        )
        per_chunk = (
            self.df.filter(F.col(_CHUNK) >= 0)
            .groupBy(*self._parts)
            .agg(*[self._chunk_value(kind, c).alias(n) for n, (kind, c) in columns.items()])
        )
        carried = per_chunk.select(
            *_renamed(self._parts),
            *[
                _accumulate(kind, F.col(n)).over(before).alias(f"_in_{n}")
                for n, (kind, _) in columns.items()
            ],
        )
        some = reduce(lambda a, b: a | b, (F.col(f"_in_{n}").isNotNull() for n in columns))
        joined = out.join(F.broadcast(carried.filter(some)), _matches(self._parts), "left")
        return self._with(
            joined.select(
                *self.df.columns,
                *[
                    _combine(kind, F.col(f"_in_{n}"), F.col(n)).alias(n)
                    for n, (kind, _) in columns.items()
                ],
            )
        )

    def _chunk_value(self, kind: str, c: Column) -> Column:
        if kind == "last":
            return F.max_by(c, F.when(c.isNotNull(), F.struct(*self.order)))
        return _accumulate(kind, c)

    def rows(self) -> DataFrame:
        return self.df.drop(_CHUNK) if self.chunked else self.df


def _accumulate(kind: str, c: Column) -> Column:
    if kind == "sum":
        return F.sum(c)
    if kind == "max":
        return F.max(c)
    if kind == "last":
        return F.last(c, ignorenulls=True)
    raise ValueError(f"unknown running kind {kind!r}")


def _combine(kind: str, carried: Column, inside: Column) -> Column:
    if kind == "sum":
        return F.when(carried.isNull(), inside).otherwise(carried + F.coalesce(inside, F.lit(0)))
    if kind == "max":
        return F.greatest(carried, inside)
    return F.coalesce(inside, carried)
