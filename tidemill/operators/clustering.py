"""Space-filling-curve keys: rows near in every clustering column get near keys.

A column's rank is the number of its sampled quantiles at or below the value, found by a balanced tree
of comparisons; the bits of the ranks are interleaved. Everything is one native expression, and the
table of quantiles holds ``2 ** bits`` values a column whatever the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
SAMPLED = 20_000


def quantiles(df: DataFrame, columns: Sequence[str], bits: int = BITS, sampled: int = SAMPLED) -> dict[str, list]:
    """Up to ``2 ** bits - 1`` values that part a bounded sample of each column evenly. It only shapes
    the clusters: any values give right results."""
    rows = df.select(*columns)
    total = rows.count()
    part = rows if total <= sampled else rows.sample(sampled / total, seed=17)
    found = part.limit(2 * sampled).collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in found if r[c] is not None)
        cuts = (values[i * len(values) // 2**bits] for i in range(1, 2**bits)) if values else ()
        out[c] = sorted(set(cuts))
    return out


def rank(value: Column, cuts: Sequence) -> Column:
    """How many of the sorted ``cuts`` are at or below the value; 0 for null."""
    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(tree(0, len(cuts))).cast("long")


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """Bit j of the i-th rank becomes bit j * len(ranks) + i."""
    if bits * len(ranks) > 62:
        raise ValueError(f"{len(ranks)} columns of {bits} bits don't fit a key of 62")
    total = F.lit(0).cast("long")
    for i, r in enumerate(ranks):
        for j in range(bits):
            bit = F.shiftright(r, j).bitwiseAND(F.lit(1).cast("long"))
            total = total.bitwiseOR(F.shiftleft(bit, j * len(ranks) + i))
    return total


def z_order(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The key of each row of ``df`` along the curve through ``columns``."""
    bits = min(bits, 62 // len(columns))
    cuts = quantiles(df, columns, bits)
    return interleaved([rank(F.col(c), cuts[c]) for c in columns], bits)
