"""Mixing sources to target weights along a time-varying curriculum, native.

1. Sizes per source are aggregated; a source's target is its weight's part of the wanted total,
   but at most ``cap`` times its size, the excess being shared again by weight (water filling).
2. In a source, documents follow each other in the order of a hash of their id. The words before a
   document come from a two-level prefix sum (over hash ranges, then inside a range), so that no
   task holds a source. Whole passes are taken first; the last one stops at the target.
3. Each source has a weight schedule over the training time 0..1: a piecewise linear intensity.
   Its integral is the cumulative demand; inverting that at the middle word of a document gives the
   training position of each time the document is taken. Results are range-sorted by position.

Defined cases: null text or text without words has size 0 and is never taken; null source is a
source of its own, ordered last; null ids and repeated rows are rows like others (rows equal in id
and size are interchangeable); an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import WORD, one_row_each, settled, word_count

WEIGHTS = (3.0, 1.0, 2.0)
#: Intensity at given times for the 1st, 2nd, 3rd, 4th ... source, repeating; only the shape counts.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (0.5, 0.5), (1.0, 2.5)),
    ((0.0, 1.0), (1.0, 1.0)),
)
ROWS_PER_RANGE = 4_096
_KEY_BITS = 60


def inverse_demand(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of a piecewise linear intensity reaches ``share`` of its
    total. Intensities must not be negative and must have a positive integral."""
    areas = [(v0 + v1) / 2 * (t1 - t0) for (t0, v0), (t1, v1) in zip(knots, knots[1:])]
    if min(v for _, v in knots) < 0 or sum(areas) <= 0 or knots[0][0] != 0 or knots[-1][0] != 1:
        raise ValueError("a schedule runs from time 0 to 1, without negative intensity, not all zero")
    wanted, done, time = share * F.lit(sum(areas)), 0.0, None
    for ((t0, v0), (t1, v1)), area in zip(zip(knots, knots[1:]), areas):
        # v0 x + slope/2 x^2 = need, in the form that stays exact when the slope is 0
        need = F.greatest(wanted - F.lit(done), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(v0 * v0) + F.lit(2 * (v1 - v0) / (t1 - t0)) * need, F.lit(0.0)))
        at = F.lit(t0) + F.coalesce(F.try_divide(F.lit(2.0) * need, F.lit(v0) + root), F.lit(0.0))
        at = F.least(at, F.lit(t1))
        time = at if time is None else F.when(wanted > F.lit(done), at).otherwise(time)
        done += area
    return time


def _scheduled(share: Column, which: Column, schedules) -> Column:
    out = None
    for i, knots in enumerate(schedules):
        t = inverse_demand(share, knots)
        out = F.when(which == i, t) if out is None else out.when(which == i, t)
    return out


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
    schedules: int = len(SCHEDULES),
) -> DataFrame:
    """From (source, source_size): the target of each source, its schedule's number and its rank.

    One row per source, so the windows over all of them are small.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sizes.withColumn("_rank", rank).withColumn(
        "_w", F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    ).withColumn("_cap", F.lit(cap) * F.col("source_size"))
    by_need = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_rank"))
    full = ranked.withColumn(
        "_level",
        (F.lit(share) * F.sum("source_size").over(everything)
         - (F.sum("_cap").over(by_need.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cap")))
        / F.sum("_w").over(by_need.rowsBetween(0, Window.unboundedFollowing)),
    ).withColumn("_order", F.row_number().over(by_need))
    open_ = F.col("_level") <= F.col("_cap") / F.col("_w")
    level = F.min_by(F.when(open_, F.col("_level")), F.when(open_, F.col("_order"))).over(everything)
    return full.select(
        "source", "source_size",
        F.least(F.col("_cap"), F.coalesce(level * F.col("_w"), F.col("_cap"))).alias("target"),
        (F.col("_rank") % schedules).cast("int").alias("_schedule"),
    )


def plan_mix(
    docs: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
    schedules=SCHEDULES, seed: str = "mix", keep: Sequence[Column] = (),
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, ``passes`` (an array of
    (position, words, whole) for each time it is taken) and the ``keep`` columns."""
    kept = [f"_keep{i}" for i in range(len(keep))]
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"))), 1, 15), 16, 10)
    base = settled(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("_n"), key.cast("long").alias("_key"),
        *(c.alias(k) for c, k in zip(keep, kept)),
    ).withColumn("size", F.coalesce("_n", F.lit(0).cast("long"))).drop("_n"))
    bits = max(0, math.ceil(math.log2(max(1, base.count()) / ROWS_PER_RANGE)))
    base = base.withColumn("_range", F.shiftright("_key", _KEY_BITS - min(bits, 40)))
    ranges = base.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    targets = source_targets(
        ranges.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, cap, len(schedules))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    t = targets.withColumnRenamed("source", "_s")
    offsets = offsets.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_s"), F.col("_range").alias("_r"), "_offset", "source_size", "target", "_schedule")
    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = base.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    rows = rows.withColumn("_before", F.col("_offset") + F.col("_inside"))
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("long")
    rows = rows.withColumn("_whole", whole).withColumn(
        "_rest", F.round(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long")
    ).withColumn("_extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before"))))
    total = (F.col("_whole") * F.col("source_size") + F.col("_rest")).cast("double")

    def at(start: Column, words: Column, is_whole: Column) -> Column:
        middle = F.coalesce(F.try_divide(start + words / F.lit(2.0), total), F.lit(0.0))
        return F.struct(_scheduled(middle, F.col("_schedule"), schedules).alias("position"),
                        words.alias("words"), is_whole.alias("whole"))

    passes = [
        F.when((F.col("_whole") > p) & (F.col("size") > 0),
               at(F.lit(p) * F.col("source_size") + F.col("_before"), F.col("size"), F.lit(True)))
        for p in range(math.ceil(cap))
    ] + [F.when(F.col("_extra") > 0, at(F.col("_whole") * F.col("source_size") + F.col("_before"),
                                       F.col("_extra"), F.col("_extra") * 2 >= F.col("size")))]
    return rows.select(
        "doc_id", "size", "source_size", "target",
        (F.col("_whole") * F.col("size") + F.col("_extra")).alias("taken"),
        F.array_compact(F.array(*passes)).alias("passes"), *kept,
    )


def by_position(df: DataFrame, position: str, *ties: str) -> DataFrame:
    """Range-sort: partitions follow each other in ``position``, nulls last."""
    order = [F.col(position).asc_nulls_last(), *ties]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The plan of every document, range-sorted by its first training position."""
    plan = plan_mix(docs, **options).withColumn("position", F.get("passes", F.lit(0))["position"])
    return by_position(plan, "position", "doc_id")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mix trains on them: a row for each whole pass, range-sorted by
    training position. Where a source's last pass ends inside a document, the document is taken
    if at least half of it belongs to the mix. Rows equal in id and text count as copies."""
    mark = F.xxhash64(F.col("text"))
    plan = plan_mix(docs, keep=[mark], **options).groupBy("doc_id", "_keep0").agg(
        F.flatten(F.collect_list(F.filter("passes", lambda p: p["whole"]))).alias("passes"))
    plan = plan.filter(F.size("passes") > 0).select(F.col("doc_id").alias("id"), F.col("_keep0").alias("of"), "passes.position")
    joined = one_row_each(docs).join(plan, F.col("own").eqNullSafe(F.col("id")) & F.col("mark").eqNullSafe(F.col("of")))
    taken = joined.select("row", F.col("own"), F.explode("position").alias("position"))
    return by_position(taken, "position", "own").select("row.*")


def oracle(weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: str = "mix") -> str:
    """doc_id, size, source_size, target and taken in the SQL of an embedded database."""
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{seed}|' || doc_id), 1, 15))::BIGINT AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, (ARRAY[{", ".join(f"{w:g}::DOUBLE" for w in weights)}])[
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank, {cap:g}::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, row_number() OVER (ORDER BY cap / w, rank) AS o,
        ({share:g}::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER (ORDER BY cap / w, rank) - cap))
        / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, source_size, least(cap, coalesce(min_by(level, o) FILTER (level <= cap / w) OVER () * w, cap)) AS target FROM l),
c AS (SELECT d.*, source_size, target,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, round(target - whole * source_size)::BIGINT - before)))::BIGINT AS taken
FROM c"""
