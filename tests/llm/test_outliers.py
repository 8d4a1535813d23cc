"""The covariance estimate decides: against an estimate in memory and on planted outliers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_documents import by_id
from tidemill.llm import outliers, queries
from tidemill.llm.common import table

NAMES = ["_group", "_key", *outliers._X]


def regular(cov, target, condition=50.0):
    """The least mixture with the target that is well-conditioned, by bisection."""
    def number(part):
        values = np.linalg.eigvalsh(((1 - part) * cov + part * np.diag(target)) / np.sqrt(np.outer(target, target)))
        return values[-1] / max(values[0], 1e-300)

    if number(0.0) <= condition:
        return cov
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if number(middle) > condition else (low, middle)
    return (1 - high) * cov + high * np.diag(target)


def estimate(x, target, seed=0, trials=80):
    """Minimum regularised covariance determinant of all rows in memory, reweighted."""
    rng, h, best = np.random.default_rng(seed), math.ceil(outliers.COVERED * len(x)), None
    for _ in range(trials):
        near = rng.choice(len(x), 6, replace=False)
        for _ in range(12):
            mean, cov = x[near].mean(0), regular(np.cov(x[near].T, bias=True), target)
            gap = x - mean
            near = np.argsort(np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap), kind="stable")[:h]
        mean, cov = x[near].mean(0), regular(np.cov(x[near].T, bias=True), target)
        if best is None or np.linalg.det(cov) < best[0]:
            best = np.linalg.det(cov), mean, cov
    _, mean, cov = best
    gap = x - mean
    d2 = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)
    inner = x[d2 / max(1.0, np.median(d2) / outliers.chi_square(0.5)) <= outliers.chi_square(0.975)]
    return inner.mean(0), regular(np.cov(inner.T, bias=True), target)


def target_of(x):
    out = []
    for c in x.T:
        middle = np.floor(np.sort(c)[(len(c) - 1) // 2] * outliers._FINE) / outliers._FINE
        away = c[np.floor(c * outliers._FINE) != np.floor(middle * outliers._FINE + 0.5)]
        out.append(((away - middle) ** 2).mean() if len(away) else 1.0)
    return np.array(out)


def vectors(docs):
    rows = outliers.with_statistics(docs)
    return rows.select("doc_id", "lang", "source", "n_words", "n_repeat_words", *(v.alias(x) for v, x in zip(outliers._vector(), outliers._X))).collect()


def kept_in_memory(docs, min_rows=outliers.MIN_ROWS):
    """doc_id -> squared distance over the limit, for rows that pass the base rules."""
    rows = vectors(docs)
    x = np.array([[r[c] for c in outliers._X] for r in rows])
    base = np.array([r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words for r in rows])
    target = target_of(x[~base])
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault((r.lang, r.source), []).append(i)
    by_lang = {}
    for (lang, _), members in groups.items():
        if len(members) < min_rows:
            by_lang.setdefault(lang, []).extend(members)
    pools = [m for m in groups.values() if len(m) >= min_rows] + [m for m in by_lang.values() if len(m) >= min_rows]
    rest = [i for m in by_lang.values() if len(m) < min_rows for i in m]
    if len(rest) >= min_rows:
        pools.append(rest)
    out = {r.doc_id: None if b else 0.0 for r, b in zip(rows, base)}
    for members in pools:
        mean, cov = estimate(x[members], target)
        gap = x[members] - mean
        for i, d in zip(members, np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)):
            if not base[i]:
                out[rows[i].doc_id] = d / outliers.chi_square(outliers.CUTOFF)
    return out


def agree(got, want):
    """All decisions equal, but for rows right at the limit."""
    assert set(got) == set(want)
    for i, part in want.items():
        if part is None:
            assert not got[i][0]
        elif abs(part - 1) > 0.15:
            assert got[i][0] == (part < 1), (i, part)


def test_kept_equals_an_estimate_in_memory(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    want = kept_in_memory(docs)
    agree(by_id(queries.op7_quality_outliers(spark, sf_dir).collect(), "kept"), want)
    assert any(v is not None and v > 1 for v in want.values())


def planted(spark):
    """Words of two alphabets: the longer the words, the fewer capitals; two texts break only that rule."""
    rng = np.random.default_rng(8)

    def text(size, capitals, words=120):
        return " ".join("".join("X" if rng.random() < capitals else "x" for _ in range(max(1, round(rng.normal(size, 0.6))))) + str(i) for i in range(words))

    rows = []
    for i in range(400):
        size = rng.uniform(3, 9)
        rows.append((i, text(size, 0.02 + 0.06 * (9 - size)), "en", "a"))
    rows += [(900, text(3.4, 0.05), "en", "a"), (901, text(8.6, 0.28), "en", "a"), (902, text(6, 0.2) + " #$%&" * 300, "en", "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_a_combination_is_an_outlier(spark):
    docs = planted(spark)
    got = by_id(outliers.filter_documents(docs).collect(), "kept")
    assert not got[900][0] and not got[901][0] and not got[902][0]
    assert sum(k for k, in got.values()) >= 0.98 * 400
    rows = {r.doc_id: np.array([r[c] for c in outliers._X]) for r in vectors(docs)}
    clean = np.array([rows[i] for i in range(400)])
    for i in (900, 901):  # each statistic alone lies inside
        assert (rows[i] >= clean.min(0) - 1e-9).all() and (rows[i] <= clean.max(0) + 1e-9).all()
    agree(got, kept_in_memory(docs))


def test_estimates_have_a_shape_of_their_own(spark, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.1"), "documents")
    rows = outliers.with_statistics(docs).select("*", F.xxhash64("doc_id").alias("_key"), *(v.alias(x) for v, x in zip(outliers._vector(), outliers._X)))
    rows = outliers.grouped(rows, outliers.MIN_ROWS).filter("_group is not null")
    target = outliers.departures(rows)
    estimates = outliers.mcd_estimates(rows.select("_group", "_key", *outliers._X), target).collect()
    telling = 0
    for r in estimates:
        cov = np.linalg.inv(np.array(r.precision).reshape(5, 5)) / np.sqrt(np.outer(target, target))
        telling += np.abs(cov - np.diag(np.diag(cov))).max() > 0.001 and np.ptp(np.diag(cov)) > 0.01
    assert telling > 0.5 * len(estimates) > 20


def test_outliers_do_not_shift_the_estimate(spark):
    """A quarter of the rows lies far away; the estimate is that of the others, and they are kept."""
    rng = np.random.default_rng(2)
    rows = [(0.1 + 0.02 * a, 0.0, 0.05 * abs(b), 0.0, 0.02) for a, b in rng.normal(size=(900, 2))]
    rows += [(0.9, 1.5, 0.9, 0.9, 0.6)] * 250
    data = spark.createDataFrame([("g", i, *map(float, r)) for i, r in enumerate(rows)], NAMES)
    got = outliers.mcd_estimates(data, outliers.departures(data)).collect()
    assert len(got) == 1
    assert np.allclose(got[0].mean, np.mean(rows[:900], axis=0), atol=0.02)
    gap = np.array(rows) - got[0].mean
    d2 = np.einsum("ij,jk,ik->i", gap, np.array(got[0].precision).reshape(5, 5), gap)
    limit = outliers.chi_square(outliers.CUTOFF)
    assert (d2[:900] < limit).all() and (d2[900:] > limit).all()


def test_estimates_agree_with_concentration_in_memory(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 5)) @ np.diag([0.3, 0.2, 0.4, 0.3, 0.1]) @ (np.eye(5) + 0.4 * np.eye(5, k=1)) + 3
    x[:100] += 4
    rows = spark.createDataFrame([("g", i, *map(float, r)) for i, r in enumerate(x)], NAMES)
    target = outliers.departures(rows)
    assert np.allclose(target, target_of(x), rtol=0.02)
    got = outliers.mcd_estimates(rows, target).first()
    mean, cov = estimate(x, target, trials=60)
    assert np.allclose(got.mean, mean, atol=0.02)
    assert np.allclose(np.linalg.inv(np.array(got.precision).reshape(5, 5)), cov, rtol=0.1, atol=0.005)


@pytest.mark.parametrize("diagonal", [(1, 1, 1, 1, 1), (1, 0, 0, 0, 1e-9), (0, 0, 0, 0, 0), (4, 1, 0.2, 0.1, 0.01)])
def test_regularised_is_the_least_mixture(diagonal):
    cov, target = np.diag(np.array(diagonal, float)), np.array([1.0, 2.0, 0.5, 1.0, 1.0])
    got = outliers.regularised(cov, target)
    want = regular(cov, target) if any(diagonal) else np.diag(target)
    assert np.allclose(got, want, atol=1e-9)


def test_statistics_of_edges():
    assert brute.statistics("")[:5] == outliers.statistics_of("")[:5]
