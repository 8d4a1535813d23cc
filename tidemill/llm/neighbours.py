"""Approximate nearest neighbours by inner product with a forest of hash prefixes.

Each tree labels every vector with a string of ``BITS`` bits, the sides of random hyperplanes (a
coordinate is added that makes all vectors equally long, so that angles rank as inner products do).
A tree's sorted labels are kept as cells (leading bits), which are dealt to tasks in bounded blocks.

A query descends all trees to its longest prefixes and ascends them synchronously: the level is the
longest prefix length at which the trees together hold ``min_candidates`` entries, or ``min_share``
of the vectors if that is more; all entries under that prefix in all trees are candidates. Counts per
prefix give the level before any candidate is touched. Candidates are scored block against block.

Equal vectors are one entry, carried with as many of their least ids as a result can show, so a vector
that a third of the rows share costs no more than another, and its neighbours are still exact.

``min_share`` sets recall on vectors without clusters, whose neighbours are hardly nearer than the
rest; where vectors are clustered, 0 and a number in ``min_candidates`` keep a query's work constant.

Defined cases: vectors that are null, zero, hold null or non-finite components, have another number
of components than most, or have a null id take no part; repeated rows count once; ties go to the
smaller id; with fewer candidates than asked for all are returned; an empty table has no result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemill.llm.common import settled

TREES, BITS = 16, 24
COUNTED = 12  # prefixes of up to so many bits are counted
MIN_CANDIDATES, MIN_SHARE = 32_768, 0.75
CELL_ROWS, QUERY_ROWS = 4096, 512
MARGIN = 12  # entries beyond those asked for that are scored again exactly


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists(v, lambda x: x != 0)).distinct()
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["n"] if sizes else 0))


def _norm2(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def hyperplanes(components: int, trees: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(components + 1, trees * bits))


def _labelled(rows: DataFrame, components: int, longest2: float, is_query: bool, dtype: str, trees: int, bits: int, seed: int) -> DataFrame:
    """(id, v) → id, vec (bytes), labels (one number of ``bits`` bits for each tree)."""
    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes = hyperplanes(components, trees, bits, seed)
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for f in frames:
            if not len(f):
                continue
            x = np.array(f["v"].tolist(), dtype=dtype).reshape(-1, components)
            wide = x.astype(np.float64)
            last = np.zeros(len(x)) if is_query else np.sqrt(np.maximum(0.0, longest2 - (wide * wide).sum(1)))
            sides = np.column_stack([wide, last]) @ planes > 0
            labels = sides.reshape(len(x), trees, bits) @ weights
            yield pd.DataFrame({"id": f["id"], "vec": [r.tobytes() for r in x], "labels": list(labels)})

    return rows.mapInPandas(label, "id long, vec binary, labels array<long>")


def best_of(scores: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` largest finite scores, ties to smaller ids."""
    finite = np.flatnonzero(scores > -np.inf)
    if len(finite) > keep:
        least = np.partition(scores[finite], len(finite) - keep)[len(finite) - keep]
        finite = finite[scores[finite] >= least]
    return finite[np.lexsort((ids[finite], -scores[finite]))][:keep]


def nearest(
    vectors: DataFrame, is_query: Column, *, k: int = 20, trees: int = TREES, bits: int = BITS,
    min_candidates: int = MIN_CANDIDATES, min_share: float = MIN_SHARE, seed: int = 20,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each query row (``is_query`` over vec_id)
    among all other rows of (vec_id, embedding)."""
    dtype = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "<f8"
    rows = settled(usable(vectors))
    first = Window.partitionBy("v").orderBy("vec_id")
    copies = rows.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k + 1)
    entries = settled(copies.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("id", F.get("ids", F.lit(0))))
    queries = settled(rows.filter(is_query).join(entries.select("v", "id"), "v").select(F.col("vec_id").alias("query_id"), "id"))
    facts = entries.agg(F.count(F.lit(1)).alias("n"), F.max(_norm2(F.col("v"))).alias("longest"), F.max(F.size("v")).alias("size")).first()
    n, longest, size = facts["n"], facts["longest"] or 0.0, facts["size"] or 1
    index = settled(_labelled(entries.select("id", "v"), size, longest, False, dtype, trees, bits, seed))
    asked = entries.join(queries.select("id").distinct(), "id", "left_semi").select("id", "v")
    asked = settled(_labelled(asked, size, longest, True, dtype, trees, bits, seed))

    # Counts of entries under each prefix, and from them each query's level.
    counted = min(COUNTED, bits)
    leaves = index.select(F.posexplode("labels").alias("tree", "label")).groupBy(
        "tree", F.shiftright("label", bits - counted).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    depths = F.explode(F.sequence(F.lit(0), F.lit(counted))).alias("depth")
    counts = settled(leaves.select("tree", "prefix", "n", depths).groupBy(
        "tree", "depth", F.expr(f"shiftright(prefix, {counted} - depth)").alias("prefix")).agg(F.sum("n").alias("n")))
    paths = asked.select("id", F.posexplode("labels").alias("tree", "label")).select("id", "tree", "label", depths).withColumn(
        "prefix", F.expr(f"shiftright(label, {bits} - depth)"))
    wanted = max(min_candidates, math.ceil(min_share * n))
    levels = paths.join(counts, ["tree", "depth", "prefix"], "left").groupBy("id", "depth").agg(F.sum("n").alias("n")).groupBy(
        "id").agg(F.coalesce(F.max(F.when(F.col("n") >= wanted, F.col("depth"))), F.lit(0)).alias("level"))

    # Cells of about CELL_ROWS entries; large ones in several blocks, and so the queries in a cell.
    depth = min(counted, max(0, round(math.log2(max(1, n) / CELL_ROWS))))
    placed = index.select("id", "vec", F.posexplode("labels").alias("tree", "label")).withColumn(
        "cell", F.shiftright("label", bits - depth))
    sizes = counts.filter(F.col("depth") == depth).select("tree", F.col("prefix").alias("cell"), F.ceil(F.col("n") / CELL_ROWS).alias("parts"))
    blocks = placed.join(sizes, ["tree", "cell"]).groupBy("tree", "cell", F.pmod(F.xxhash64("id"), "parts").alias("block")).agg(
        F.collect_list(F.struct("id", "label", "vec")).alias("e"))
    blocks = blocks.select("tree", "cell", *(F.col(f"e.{c}").alias(f"c_{c}") for c in ("id", "label", "vec")))
    # A query whose level is above the cells' depth goes to all cells under its prefix.
    asked = asked.join(levels, "id").select("id", "vec", "level", F.posexplode("labels").alias("tree", "label")).filter(
        (F.col("level") > 0) | (F.col("tree") == 0))
    under, spread = f"shiftright(label, {bits} - level)", f"greatest({depth} - level, 0)"
    asked = asked.withColumn("cell", F.explode(F.when(
        F.col("level") >= depth, F.array(F.shiftright("label", bits - depth))).otherwise(F.sequence(
            F.expr(f"shiftleft({under}, {spread})"), F.expr(f"shiftleft({under} + 1, {spread}) - 1")))))
    loads = asked.groupBy("tree", "cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("parts"))
    askers = asked.join(loads, ["tree", "cell"]).groupBy("tree", "cell", F.pmod(F.xxhash64("id"), "parts").alias("part")).agg(
        F.collect_list(F.struct("id", "label", "vec", "level")).alias("e"))
    askers = askers.select("tree", "cell", *(F.col(f"e.{c}").alias(f"q_{c}") for c in ("id", "label", "vec", "level")))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                c_id, c_label = np.asarray(r.c_id), np.asarray(r.c_label)
                c = np.frombuffer(b"".join(r.c_vec), dtype).reshape(len(c_id), -1).astype(np.float64)
                q = np.frombuffer(b"".join(r.q_vec), dtype).reshape(len(r.q_id), -1).astype(np.float64)
                scores = q @ c.T
                out = []
                for i, (label, level) in enumerate(zip(r.q_label, r.q_level)):
                    s = scores[i]
                    if level > depth:
                        s = np.where((c_label ^ label) >> (bits - level) == 0, s, -np.inf)
                    best = best_of(s, c_id, k + 1 + MARGIN)
                    out.append(pd.DataFrame({"query": r.q_id[i], "id": c_id[best], "score": s[best]}))
                yield pd.concat(out)

    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", vectors.sparkSession.conf
    before = conf.get(key)
    conf.set(key, "4")  # a row holds two blocks
    try:
        found = settled(askers.join(blocks, ["tree", "cell"]).drop("tree", "cell").mapInPandas(score, "query long, id long, score double"))
    finally:
        conf.set(key, before)
    found = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    top = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    found = found.withColumn("_r", F.row_number().over(top)).filter(F.col("_r") <= k + 1 + MARGIN).select("query", "id")

    # Exact scores of what is left, on the original vectors, and the copies behind each entry.
    mine = entries.select(F.col("id").alias("query"), F.col("v").alias("q"))
    pairs = found.join(entries, "id").join(mine, "query")
    dot = F.aggregate(F.zip_with("q", "v", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x)
    pairs = pairs.select("query", dot.alias("score"), F.explode("ids").alias("vec_id"))
    ranked = pairs.withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).filter(
        F.col("_r") <= k + 1)
    others = queries.join(ranked, F.col("query") == queries["id"]).filter(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("_r"))
    return others.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def oracle(k: int = 20) -> str:
    """Brute force in the SQL of an embedded database: what the forest gives where all entries are
    candidates, as on small tables."""
    return f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        list_sum(list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2])) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
