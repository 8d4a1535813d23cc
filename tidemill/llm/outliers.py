"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

A text's statistics (one pass over the whole text) are transformed to a short vector. For each
language and source the minimum covariance determinant is estimated: bounded samples of the group
give starting estimates (random subsets of p + 1 rows, concentrated); concentration steps over all
rows of the group then refine each start; the start with the smallest determinant wins and is
reweighted. Rows far from their group by Mahalanobis distance are rejected.

Concentration steps are aggregations: distances, a histogram of them to find the h nearest rows, and
sums of products. A group of any size is split over all tasks and combined before the shuffle.
Languages and sources with few rows are pooled by language, then altogether; where even that has
fewer than ``min_rows``, nothing is rejected beyond the base rules.

Statistics that are the same for most texts make such a covariance singular. It is then regularised as in
the minimum regularised covariance determinant: mixed with a diagonal target by the least part that
brings the condition number (in units of the target) down to ``CONDITION``; a covariance that is
well-conditioned stays as it is. The target is the table's own scale of departures: the mean
square distance from the median of those rows that differ from it.

Defined cases: null or empty text has no words and fails the base rules; null language or source is
a value of its own; null ids and repeated rows count as rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import settled

# What parts words, symbols and limits of the base rules.
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

#: The transformed vector.
STATISTICS = ("word_length", "symbols", "dup_lines", "repeats", "capitals")
CONDITION = 50.0
COVERED = 0.75  # the part of a group that the estimate is made from
CUTOFF = 0.99999  # of the chi-square distribution
SAMPLE_ROWS, STARTS, MIN_ROWS, STEPS = 500, 3, 60, 6
_BINS = 200  # of the histogram of distances, for each factor e
_FINE, _MOST = 1000, 20  # bins for each unit of a statistic, and where they end
_P = len(STATISTICS)
_X = [f"_x{i}" for i in range(_P)]
_UPPER = [(i, j) for i in range(_P) for j in range(i, _P)]


def repeated_words(ids: np.ndarray, n: int = WINDOW) -> int:
    """Words inside windows of ``n`` words that occur at least twice."""
    if len(ids) <= n:
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(ids, n)
    # windows are told apart by two independent hashes of 64 bits
    factors = np.random.default_rng(5).integers(1, 2**62, size=(2, n), dtype=np.int64) | 1
    first, second = (windows * factors[0]).sum(1), (windows * factors[1]).sum(1)
    order = np.lexsort((second, first))
    same = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    found = order[np.r_[same, False] | np.r_[False, same]]
    step = np.zeros(len(ids) + 1, dtype=np.int64)
    step[found] += 1  # each window starts at one place, so no index repeats
    step[found + n] -= 1
    return int((np.cumsum(step)[:-1] > 0).sum())


def statistics_of(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at just the six blanks
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    lines = Counter(line for line in text.split("\n") if line.strip(BLANKS))
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            lines.total() - len(lines), repeated_words(ids), sum(map(str.isupper, text)))


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the statistics of each text; only the text goes through Python."""
    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_capitals long")
    def measure(texts: pd.Series) -> pd.DataFrame:
        rows = [statistics_of(t) for t in texts]
        return pd.DataFrame(np.array(rows, dtype=np.int64).reshape(-1, 6), columns=[
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals"])

    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    return docs.select("doc_id", "lang", "source", lines.alias("_lines"), measure("text").alias("_s")).select(
        "doc_id", "lang", "source", "_lines", "_s.*")


def _vector() -> list[Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return [
        F.log(chars / words), F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / F.greatest("_lines", F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words), F.col("n_capitals") / chars,
    ]


def chi_square(q: float, p: int = _P) -> float:
    """Quantile of the chi-square distribution (cube root approximation)."""
    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(q) * math.sqrt(2 / (9 * p))) ** 3


def regularised(cov: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``cov`` mixed with as little of the diagonal ``target`` as its condition needs."""
    scale = np.sqrt(np.outer(target, target))
    values = np.linalg.eigvalsh(cov / scale)
    excess = values[-1] - CONDITION * max(values[0], 0.0)
    if values[-1] <= 0:
        return np.diag(target)
    part = max(0.0, excess / (CONDITION - 1 + excess))
    return (1 - part) * cov + part * np.diag(target)


def departures(rows: DataFrame) -> np.ndarray:
    """For each statistic of ``rows`` the mean square distance from its median of the rows that aren't
    there (1 where none is away)."""
    each = rows.select(F.posexplode(F.array(*_X)).alias("i", "x"))
    place = F.least(F.floor(F.col("x") * _FINE), F.lit(_FINE * _MOST)).cast("int")
    bins = each.groupBy("i", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    w = Window.partitionBy("i")
    bins = bins.withColumn("_half", F.sum("n").over(w.orderBy("bin")) * 2 >= F.sum("n").over(w))
    bins = bins.withColumn("m", F.min(F.when(F.col("_half"), F.col("bin"))).over(w) / F.lit(float(_FINE)))
    away = bins.filter(F.col("bin") != F.col("m") * _FINE).groupBy("i").agg(
        F.sum(F.col("q") - 2 * F.col("m") * F.col("s") + F.col("m") * F.col("m") * F.col("n")).alias("d"), F.sum("n").alias("n"))
    out = np.ones(_P)
    for r in away.collect():
        out[r["i"]] = max(r["d"] / r["n"], 1e-12)
    return out


def starting_estimates(x: np.ndarray, target: np.ndarray, starts: int = STARTS, trials: int = 60, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """The best estimates from random subsets of p + 1 rows, each concentrated on ``x``."""
    rng, n = np.random.default_rng(seed), len(x)
    h = max(_P + 1, math.ceil(COVERED * n))

    def concentrated(mean, cov, steps):
        for _ in range(steps):
            gap = x - mean
            near = np.argsort(np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap), kind="stable")[:h]
            mean, cov = x[near].mean(0), regularised(np.cov(x[near].T, bias=True), target)
        return np.linalg.det(cov), mean, cov

    found = []
    for _ in range(trials):
        some = x[rng.choice(n, _P + 1, replace=False)]
        found.append(concentrated(some.mean(0), regularised(np.cov(some.T, bias=True), target), 2))
    found.sort(key=lambda f: f[0])
    return [concentrated(f[1], f[2], 10)[1:] for f in found[:starts]]


def _shaped(frame: pd.DataFrame, target: np.ndarray) -> list[tuple]:
    """Rows (group, start, mean, precision, log determinant) from sums of products."""
    out = []
    for r in frame.itertuples(index=False):
        mean = np.array([getattr(r, f"s{i}") for i in range(_P)]) / r.n
        cov = np.zeros((_P, _P))
        for i, j in _UPPER:
            cov[i, j] = cov[j, i] = getattr(r, f"s{i}_{j}") / r.n - mean[i] * mean[j]
        cov = regularised(cov, target)
        out.append((r.group, int(r.start), mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
    return out


_ESTIMATE = "group string, start int, mean array<double>, precision array<double>, logdet double"
_COLUMNS = ["group", "start", "mean", "precision", "logdet"]


def _distance() -> Column:
    gap = [F.col(x) - F.get("mean", F.lit(i)) for i, x in enumerate(_X)]
    total = None
    for i, j in _UPPER:
        term = gap[i] * gap[j] * F.get("precision", F.lit(i * _P + j)) * F.lit(1.0 if i == j else 2.0)
        total = term if total is None else total + term
    return F.greatest(total, F.lit(0.0))


def _bin(d: Column) -> Column:
    return F.floor(F.log(d + F.lit(1e-9)) * _BINS).cast("int")


def _distances(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    return rows.join(estimates.withColumnRenamed("group", "_g"), F.col("_group") == F.col("_g")).withColumn("_d", _distance())


def _limits(measured: DataFrame, part: float) -> DataFrame:
    """For each group and start, the histogram bin up to which ``part`` of the rows lie."""
    bins = measured.groupBy("_g", "start", _bin(F.col("_d")).alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_g", "start")
    run = F.sum("_n").over(w.orderBy("_bin"))
    return bins.withColumn("_upto", run).withColumn("_all", F.sum("_n").over(w)).filter(
        F.col("_upto") >= F.ceil(F.col("_all") * part)).groupBy("_g", "start").agg(F.min("_bin").alias("_limit"))


def _moments(near: DataFrame, target: np.ndarray) -> DataFrame:
    sums = near.groupBy(F.col("_g").alias("group"), "start").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)),
        *(F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"s{i}_{j}") for i, j in _UPPER))

    def shape(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(_shaped(frame, target), columns=_COLUMNS)

    return sums.mapInPandas(shape, _ESTIMATE)


def _within_limit(measured: DataFrame, part: float) -> DataFrame:
    limits = _limits(measured, part).select(F.col("_g").alias("_lg"), F.col("start").alias("_ls"), "_limit")
    return measured.join(limits, (F.col("_g") == F.col("_lg")) & (F.col("start") == F.col("_ls"))).filter(
        _bin(F.col("_d")) <= F.col("_limit"))


def grouped(rows: DataFrame, min_rows: int) -> DataFrame:
    """Adds ``_group``: language and source, or a pool of small ones; null if even that is small."""
    def named(label, *parts):
        return F.to_json(F.array(F.lit(label), *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)))

    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_n"))
    by_lang = F.sum(F.when(F.col("_n") < min_rows, F.col("_n"))).over(Window.partitionBy("lang"))
    sizes = sizes.withColumn("_l", by_lang)
    rest = F.sum(F.when((F.col("_n") < min_rows) & (F.col("_l") < min_rows), F.col("_n"))).over(Window.partitionBy())
    sizes = sizes.withColumn("_r", rest).select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"),
        F.when(F.col("_n") >= min_rows, named("s", F.col("lang"), F.col("source")))
        .when(F.col("_l") >= min_rows, named("l", F.col("lang")))
        .when(F.col("_r") >= min_rows, named("r")).alias("_group"))
    return rows.join(sizes, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
                     ).drop("_lang", "_source")


def mcd_estimates(rows: DataFrame, target: np.ndarray, steps: int = STEPS) -> DataFrame:
    """The reweighted estimate of each group of ``rows`` (_group, the vector and _key, an order
    that does not depend on the vector)."""
    first = Window.partitionBy("_group").orderBy("_key", *_X)
    sample = rows.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= SAMPLE_ROWS)

    def begin(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x = frame.sort_values(["_rank"])[_X].to_numpy()
        return pd.DataFrame([(key[0], i, mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1]))
                             for i, (mean, cov) in enumerate(starting_estimates(x, target))], columns=_COLUMNS)

    estimates = settled(sample.select("_group", "_rank", *_X).groupBy("_group").applyInPandas(begin, _ESTIMATE))
    for _ in range(steps):
        estimates = settled(_moments(_within_limit(_distances(rows, estimates), COVERED), target))
    best = estimates.groupBy("group").agg(F.min_by(F.struct(*_COLUMNS[1:]), F.struct("logdet", "start")).alias("e")).select("group", "e.*")
    # the covariance of the nearest rows is too small; its scale is set at the median distance
    measured = _distances(rows, settled(best))
    middle = _limits(measured, 0.5).select(F.col("_g").alias("_mg"), F.exp(F.col("_limit") / F.lit(float(_BINS))).alias("_middle"))
    scale = F.greatest(F.lit(1.0), F.col("_middle") / F.lit(chi_square(0.5)))
    inner = measured.join(middle, F.col("_g") == F.col("_mg")).filter(F.col("_d") / scale <= F.lit(chi_square(0.975)))
    return settled(_moments(inner, target))


def filter_documents(docs: DataFrame, *, min_rows: int = MIN_ROWS, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics, ``distance``, ``base_failed`` and ``kept`` for each document (doc_id, text, lang, source)."""
    key = F.xxhash64(F.col("doc_id").cast("string"))
    rows = with_statistics(docs)
    rows = settled(rows.select("*", key.alias("_key"), *(v.alias(x) for v, x in zip(_vector(), _X))))
    rows = settled(grouped(rows, min_rows))
    base = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    target = departures(rows.filter(~base))
    estimates = mcd_estimates(rows.filter(F.col("_group").isNotNull()).select("_group", "_key", *_X), target)
    final = rows.join(estimates, F.col("_group") == F.col("group"), "left")
    distance = F.sqrt(_distance())
    return final.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        distance.alias("distance"), base.alias("base_failed"),
        (~base & F.coalesce(distance <= math.sqrt(chi_square(cutoff)), F.lit(True))).alias("kept"))
