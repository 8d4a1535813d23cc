"""Isolation forest as Spark jobs: sample, grow one tree per group, score by partition.

After Liu, Ting & Zhou, "Isolation Forest", ICDM 2008. The data stays distributed: a tree sees
``max_samples`` rows only, so growing is one bounded group per tree, and scoring broadcasts
the trees (at most 2 * max_samples nodes each).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.schema import EDGE_TREES, FEATURES, FOREST_SEED, MIN_TRAINING_ROWS
from tidemill.operators.rank import exact_quantile
from tidemill.session import stable

NODE_SCHEMA = (
    "tree int, node int, feature int, split double, left int, right int, size int, depth int"
)
DEFAULT_SAMPLES = 256
#: Nodes that are broadcast at once; larger forests are scored in several parts.
MAX_NODES = 2_000_000
EULER_GAMMA = 0.5772156649015329


@dataclass(frozen=True)
class Forest:
    nodes: DataFrame
    features: tuple[str, ...]
    max_samples: int
    offset: float


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Average path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    m = np.where(big, n, 3.0)
    return np.where(big, 2.0 * (np.log(m - 1.0) + EULER_GAMMA) - 2.0 * (m - 1.0) / m, out)


def grow_tree(x: np.ndarray, height: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (node, feature, split, left, right, size, depth) of one random tree."""
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, None)]
    while todo:
        rows, depth, link = todo.pop()
        me = len(nodes)
        if link is not None:
            nodes[link[0]][link[1]] = me
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= height or len(rows) <= 1 or len(open_features) == 0:
            nodes.append([me, -1, 0.0, -1, -1, len(rows), depth])
            continue
        feature = int(rng.choice(open_features))
        split = float(rng.uniform(low[feature], high[feature]))
        goes_left = x[rows, feature] <= split
        if goes_left.all():  # the draw hit the upper end
            split = float(low[feature])
            goes_left = x[rows, feature] <= split
        nodes.append([me, feature, split, -1, -1, len(rows), depth])
        todo.append((rows[~goes_left], depth + 1, (me, 4)))
        todo.append((rows[goes_left], depth + 1, (me, 3)))
    return [tuple(n) for n in nodes]


def tree_samples(
    train: DataFrame, key: str, trees: int, psi: int, seed: int, n: int, columns: Sequence[str] = ()
) -> DataFrame:
    """(tree, _r, key, columns...): ``psi`` of the ``n`` rows for each tree, or all if there are fewer.

    Every tree orders the rows by a hash of its own number and the row key and takes the first, so
    each draws its own subset, whatever the size of the table and its partitioning. A row reaches
    a tree's sort only if its hash is below a cut that leaves about twice the rows wanted.
    """
    cut = min(1.0, (2 * psi + 64) / max(n, 1))

    def draw(tree: Column) -> Column:
        text = F.concat_ws("|", F.lit(str(seed)), tree.cast("string"), F.col(key).cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")

    drawn = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < F.lit(int(cut * 2**60)))
    rows = train.select(key, *columns, F.explode(drawn).alias("tree"))
    order = Window.partitionBy("tree").orderBy(draw(F.col("tree")), key, *columns)
    return rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= psi)


def fit_isolation_forest(
    train: DataFrame,
    key: str = "event_id",
    features: Sequence[str] = FEATURES,
    n_trees: int = EDGE_TREES,
    max_samples: int | float | str = "auto",
    seed: int = FOREST_SEED,
    contamination: float | str = "auto",
) -> Forest:
    """Fit on ``train`` (rows with a NULL feature are left out).

    ``max_samples`` is a count, a fraction of the rows, or ``auto`` (at most 256). A tree is grown
    in one task, so with a fraction that task grows with the table.
    ``contamination`` is ``auto`` or the share of training rows to call anomalous.
    """
    features = tuple(features)
    usable = train.dropna(subset=list(features))
    n = usable.count()
    if n < MIN_TRAINING_ROWS:
        raise ValueError(f"{n} training rows; at least {MIN_TRAINING_ROWS} are needed")
    if max_samples == "auto":
        psi = min(DEFAULT_SAMPLES, n)
    elif isinstance(max_samples, float):
        psi = max(2, min(n, int(max_samples * n)))
    else:
        psi = min(int(max_samples), n)
    height = math.ceil(math.log2(max(psi, 2)))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        rows = group.sort_values("_r")[list(features)].to_numpy(dtype=float)
        nodes = grow_tree(rows, height, np.random.default_rng([seed, tree]))
        return pd.DataFrame(
            [(tree, *node) for node in nodes],
            columns=["tree", "node", "feature", "split", "left", "right", "size", "depth"],
        )

    samples = tree_samples(usable, key, n_trees, psi, seed, n, features)
    # An explicit number of partitions: the samples are small, and merging them would grow all
    # trees in one task.
    tasks = min(n_trees, train.sparkSession.sparkContext.defaultParallelism)
    dealt = samples.select(F.col("tree").cast("int").alias("tree"), "_r", *features).repartition(
        tasks, "tree"
    )
    nodes = stable(dealt.groupBy("tree").applyInPandas(grow, NODE_SCHEMA))
    forest = Forest(nodes, features, psi, -0.5)
    if contamination == "auto":
        return forest
    raw = stable(usable.select((score_isolation_forest(forest) + F.lit(forest.offset)).alias("s")))
    offset = exact_quantile(raw, "s", float(contamination))
    return Forest(nodes, features, psi, offset)


def _parts(nodes: DataFrame, max_nodes: int) -> list[list[int]]:
    """Trees in groups of at most ``max_nodes`` nodes, or of one tree."""
    parts, room = [], 0
    for r in nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).orderBy("tree").collect():
        if not parts or r["n"] > room:
            parts.append([])
            room = max_nodes
        parts[-1].append(r["tree"])
        room -= r["n"]
    return parts


def _path_sum(nodes: DataFrame, features: Sequence[str]) -> Column:
    """Sum of a row's path lengths in the trees of ``nodes``, which are broadcast."""
    table = nodes.orderBy("tree", "node").toPandas()
    trees = [
        (
            t["feature"].to_numpy(),
            t["split"].to_numpy(),
            t["left"].to_numpy(),
            t["right"].to_numpy(),
            (t["depth"] + mean_path(t["size"])).to_numpy(),
            int(t["depth"].max()),
        )
        for _, t in table.groupby("tree")
    ]
    shared = nodes.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def lengths(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        grown = shared.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for feature, split, left, right, length, depth in grown:
                at = np.zeros(len(x), dtype=np.int64)
                for _ in range(depth):
                    f = feature[at]
                    inner = f >= 0
                    value = x[rows, np.where(inner, f, 0)]
                    step = np.where(value <= split[at], left[at], right[at])
                    at = np.where(inner, step, at)
                total += length[at]
            yield pd.Series(np.where(np.isnan(x).any(axis=1), np.nan, total))

    return lengths(*[F.col(c).cast("double") for c in features])


def score_isolation_forest(forest: Forest, max_nodes: int = MAX_NODES) -> Column:
    """Decision value of each row (higher = normal, below 0 = anomalous); NULL if a feature is.

    Nodes come to the driver to be broadcast, ``max_nodes`` at a time: a forest of more is scored
    in several parts, whose path lengths are added.
    """
    parts = _parts(forest.nodes, max_nodes)
    trees = sum(map(len, parts))
    total = None
    for part in parts:
        one = _path_sum(forest.nodes.filter(F.col("tree").isin(part)), forest.features)
        total = one if total is None else total + one
    depth = total / F.lit(trees * float(mean_path(forest.max_samples)))
    return F.nanvl(-F.pow(F.lit(2.0), -depth) - F.lit(float(forest.offset)), F.lit(None))


def save_forest(forest: Forest, path: str) -> None:
    forest.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    spark = forest.nodes.sparkSession
    spark.createDataFrame(
        [(list(forest.features), forest.max_samples, float(forest.offset))],
        "features array<string>, max_samples int, offset double",
    ).write.mode("overwrite").parquet(f"{path}/parameters")


def load_forest(spark: SparkSession, path: str) -> Forest:
    p = spark.read.parquet(f"{path}/parameters").first()
    nodes = spark.read.parquet(f"{path}/nodes")
    return Forest(nodes, tuple(p["features"]), p["max_samples"], p["offset"])
