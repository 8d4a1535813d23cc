"""Exact order statistics: of one column by narrowing histograms, of many groups by running counts.

Of one column, each round counts the rows of an interval in ``BINS`` even bins; the bin that holds the wanted rank is the
next interval, from its least to its greatest value. Once an interval has few rows they are sorted.
A round is one aggregation with partial counts before the shuffle, and the driver sees a
histogram, or at most ``FEW`` values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordered import MAX_ROWS_PER_TASK, OrderedRuns

BINS, FEW = 4096, 10_000


def value_of_rank(df: DataFrame, column: str, k: int, bins: int = BINS, few: int = FEW) -> float | None:
    """The k-th smallest value (from 1) of a numeric column; null and not-a-number values take no part.
    None if there are fewer."""
    x = F.col(column).cast("double")
    rows = df.select(x.alias("x")).filter("x IS NOT NULL AND NOT isnan(x)")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    if not 1 <= k <= total["n"]:
        return None
    n, low, high, below = total["n"], total["low"], total["high"], 0
    while low < high:
        part = rows.filter((F.col("x") >= F.lit(low)) & (F.col("x") <= F.lit(high)))
        if n <= few:
            return sorted(r["x"] for r in part.collect())[k - below - 1]
        width = high / bins - low / bins  # of the parts, so that it does not overflow
        place = F.least(F.floor((F.col("x") / F.lit(width)) - F.lit(low / width)), F.lit(bins - 1)) if width > 0 and math.isfinite(low / width) else F.col("x")
        found = part.groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("low").collect()
        for r in found:
            if k <= below + r["n"]:
                n, low, high = r["n"], r["low"], r["high"]
                break
            below += r["n"]
    return low


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """The smallest value that at least ``share`` of the column's values don't exceed."""
    n = df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count()
    return value_of_rank(df, column, max(1, math.ceil(round(share * n, 9))))


def grouped_quantiles(
    counted: DataFrame, keys: Sequence[str], column: str, shares: Mapping[str, float], count: str,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Per group, and for each name in ``shares``, the smallest value that at least that share of the
    group's values don't exceed; null values take no part. ``counted`` has a row for each group and
    value with its number in ``count`` and is read three times. A group of more than ``max_rows``
    values spans many tasks."""
    known = F.when(F.col(column).isNotNull(), F.col(count)).otherwise(F.lit(0))
    of = [F.col(k).alias(f"_of_{k}") for k in keys]
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    all_ = counted.groupBy(*of).agg(F.sum(known).alias("_all"))
    upto = OrderedRuns.of(counted.select(*keys, column, count), keys, [column], max_rows).running(_upto=("sum", known)).rows()
    # a decimal product: a share of a count is often no double
    wanted = {name: F.ceil(F.col("_all").cast("decimal(19,0)") * F.lit(Decimal(str(q)))) for name, q in shares.items()}
    return upto.join(all_, same).groupBy(*keys).agg(
        *[F.min(F.when(F.col("_upto") >= F.greatest(k, F.lit(1)), F.col(column))).alias(name) for name, k in wanted.items()])
