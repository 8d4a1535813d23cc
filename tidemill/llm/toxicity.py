"""Toxicity by a counterfactually regularised classifier.

A logistic model over the presence of words and word beginnings. Each labelled text gets counterfactual
texts: a mentioned identity term is swapped for the others of its group; a text without any is
given one, and a second one of the same group in its place. Next to the usual loss the fit
minimises ``penalty * (score - counterfactual score)^2``, so that neither which group is mentioned
nor that one is moves the score more than the labels call for. Identity terms are features as whole
words only, so nothing learnt from other words that begin alike reaches them.

The model is fitted on at most ``max_rows`` labelled rows, those with the smallest hashes of their
id, with one text for each id (the least, if texts share an id); features and weights are at most ``max_features``, which also bounds what is sent to the tasks.
Scoring reads whole texts where they are, without a shuffle.

Defined cases: null or empty text is scored as a text without words; null ids, repeated rows and
other columns don't matter; a document with several labels counts as toxic if one says so; null
labels are left out; without labels of both kinds every score is 0 (below 1e-200).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import settled

#: Groups of terms that may stand for one another in a counterfactual text.
IDENTITY = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "atheists"), ("muslim", "christian", "jewish", "hindu", "atheist"),
    ("gay", "straight", "lesbian", "transgender"), ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "natives", "refugees", "citizens"),
    ("frauen", "männer", "mädchen", "jungen"), ("muslime", "christen", "juden"), ("ausländer", "inländer"),
    ("femmes", "hommes", "filles", "garçons"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres", "chicas", "chicos"), ("musulmanes", "cristianos", "judíos"),
)
BEGINNINGS = (4, 5, 6)
MAX_ROWS = 20_000
MAX_FEATURES = 4096
#: Least likelihood ratio statistic of a feature (chance exceeds it once in 100,000 features).
LEAST_G = 20.0
#: How many times more often it must stand in toxic texts; common words of longer texts don't.
LEAST_RATIO = 3.0
THRESHOLD = 0.7
_WORD = re.compile(r"\w+")
_MEMO = 400_000


def features_of(word: str, terms: frozenset[str] = frozenset()) -> list[str]:
    if word in terms:
        return ["=" + word]
    return ["=" + word, *("^" + word[:n] for n in BEGINNINGS if len(word) >= n)]


@dataclass
class Model:
    """Weights by feature; picklable, at most ``max_features`` entries."""

    bias: float
    weights: dict[str, float]
    terms: frozenset[str] = frozenset()
    _known: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def active(self, words: set[str]) -> set[str]:
        found: set[str] = set()
        known, weights = self._known, self.weights
        for w in words:
            hit = known.get(w)
            if hit is None:
                if len(known) > _MEMO:
                    known.clear()
                hit = known[w] = tuple(f for f in features_of(w, self.terms) if f in weights)
            if hit:
                found.update(hit)
        return found

    def score(self, text: str | None) -> float:
        z = self.bias
        if text:
            z += math.fsum(self.weights[f] for f in self.active(set(_WORD.findall(text.lower()))))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def counterfactuals(text: str, words: set[str], groups: Sequence[Sequence[str]] = IDENTITY) -> list[tuple[str, str, str]]:
    """What to compare a text with: (added to it on one side; taken from it and added to it on the
    other), '' for nothing. A text that mentions no term is given one by its own hash."""
    found = [("", t, o) for g in groups for t in g if t in words for o in g if o != t]
    if found or not groups:
        return found
    number = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    group = groups[number % len(groups)]
    first = number // len(groups) % len(group)
    second = (first + 1 + number // (len(groups) * len(group)) % max(1, len(group) - 1)) % len(group)
    return [(group[first], "", group[second]), ("", "", group[first])]


def fit_logistic(
    rows: list[list[int]], labels: np.ndarray, pairs: np.ndarray, size: int,
    penalty: float, ridge: float = 1e-5, steps: int = 800, rate: float = 0.2,
) -> tuple[float, np.ndarray]:
    """Full-batch fit. ``rows``: active features of each text; ``pairs``: (row, feature added on one
    side, features taken and added on the other), -1 for none. Both classes weigh the same."""
    at, n = np.repeat(np.arange(len(rows)), [len(x) for x in rows]), len(rows)
    col = np.array([i for x in rows for i in x], dtype=np.int64)
    of, one, taken, other = np.asarray(pairs, dtype=np.int64).reshape(-1, 4).T
    y = labels.astype(float)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    w, b = np.zeros(size + 1), 0.0  # the last one, -1, stays 0
    m, v = np.zeros(size + 2), np.zeros(size + 2)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    for step in range(1, steps + 1):
        z = b + np.bincount(at, w[col], n)
        d = weight * (sigmoid(z) - y)
        if len(of):
            p1, p2 = sigmoid(z[of] + w[one]), sigmoid(z[of] - w[taken] + w[other])
            gap = 2 * penalty * (p1 - p2) / len(of)
            d1, d2 = gap * p1 * (1 - p1), -gap * p2 * (1 - p2)
            d = d + np.bincount(of, d1 + d2, n)
        grad = np.bincount(col, d[at], size + 1) + ridge * w
        if len(of):
            np.add.at(grad, one, d1)
            np.add.at(grad, taken, -d2)
            np.add.at(grad, other, d2)
        grad[-1] = 0
        g = np.append(grad, d.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return float(b), w[:-1]


def train(
    docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
    penalty: float = 1.0, groups: Sequence[Sequence[str]] = IDENTITY,
) -> Model:
    """Fit on ``labels`` (doc_id, toxic) and the texts of ``docs`` (doc_id, text)."""
    chosen = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    ).orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(max_rows)
    sample = settled(chosen)
    # At most max_rows small rows, so only their texts move. An id that repeats has one text, the least:
    # the rows of the fit, which go to the driver, are bounded by the sample.
    texts = docs.select("doc_id", "text").dropna(subset=["doc_id"]).join(F.broadcast(sample), "doc_id").groupBy(
        "doc_id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text"))
    texts = settled(texts.select("toxic", F.coalesce("text", F.lit("")).alias("text")))
    terms = frozenset(t for g in groups for t in g)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(frame["text"], frame["toxic"]):
                words = set(_WORD.findall(text.lower()))
                for f in {f for w in words for f in features_of(w, terms)}:
                    seen.setdefault(f, [0, 0])[toxic] += 1
            yield pd.DataFrame({"feature": seen.keys(), "clean": [x[0] for x in seen.values()],
                                "bad": [x[1] for x in seen.values()]})

    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model(-1000.0, {})
    counts = texts.mapInPandas(counted, "feature string, clean long, bad long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    # Only what toxic texts hold significantly more often: chance words of a small sample are many.
    n = totals[0] + totals[1]
    def part(count: Column, rows: Column, base: int) -> Column:
        return F.when(count > 0, count * F.log(count * n / (rows * base))).otherwise(0.0)

    held = F.col("bad") + F.col("clean")
    telling = 2 * (part(F.col("bad"), held, totals[1]) + part(F.col("clean"), held, totals[0])
                   + part(totals[1] - F.col("bad"), n - held, totals[1]) + part(totals[0] - F.col("clean"), n - held, totals[0]))
    own = ["=" + t for t in sorted(terms)]
    more_often = F.col("bad") * totals[0] > F.col("clean") * totals[1] * LEAST_RATIO
    best = [r["feature"] for r in counts.filter(more_often).withColumn("_g", telling).filter(F.col("_g") >= LEAST_G)
            .orderBy(F.desc("_g"), "feature").limit(max(0, max_features - len(own))).collect()]
    names = sorted({*best, *own})
    number = {f: i for i, f in enumerate(names)}
    blank = Model(0.0, dict.fromkeys(names, 0.0), terms)

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, toxic in zip(frame["text"], frame["toxic"]):
                words = set(_WORD.findall(text.lower()))
                pairs = [[number["=" + t] if t and (t in words) == (i == 1) else -1 for i, t in enumerate(c)]
                         for c in counterfactuals(text, words, groups)]  # what is there can't be added, nor else be taken
                out.append((int(toxic), sorted(number[f] for f in blank.active(words)), [i for p in pairs for i in p]))
            yield pd.DataFrame(out, columns=["toxic", "row", "pairs"])

    # at most max_rows rows, each with at most three numbers for each pair of terms of a group
    rows = texts.mapInPandas(encoded, "toxic int, row array<int>, pairs array<int>").toPandas()
    each = [np.asarray(p, dtype=np.int64).reshape(-1, 3) for p in rows["pairs"]]
    pairs = np.column_stack([np.repeat(np.arange(len(each)), [len(p) for p in each]), np.concatenate(each)])
    bias, w = fit_logistic([list(x) for x in rows["row"]], rows["toxic"].to_numpy(), pairs, len(names), penalty)
    return Model(bias, {f: float(w[i]) for f, i in number.items() if w[i]}, terms)


def scored(model: Model, text: Column) -> Column:
    """The score column; only the text goes through Python, in Arrow batches."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(text)


def held_out(doc_id: Column) -> Column:
    """The third of the ids whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1, F.lit(False))


def document_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for all ``docs``, learnt from the rows not held out."""
    model = train(docs, labels.filter(~held_out(F.col("doc_id"))), **options)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(model, F.col("text")).alias("score")
                       ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
