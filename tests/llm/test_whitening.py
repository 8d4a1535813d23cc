"""Whitening against a dense eigensolver and exact whole-number sums."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n long, component int, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def valid(rows, size):
    return [(i, v) for i, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]


def compare(got, rows, size, components=32):
    """``got`` (a row for each vector and component) against brute force over ``rows``."""
    kept = valid(rows, size)
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    gap = np.array([[n * c - s for c, s in zip(row, sums)] for row in x], dtype=object)
    deviation = [sum(int(g) ** 2 for g in row) for row in gap]
    centred = (gap / n).astype(float)
    cov = centred.T @ centred / n
    e, vectors = np.linalg.eigh(cov)
    e, vectors = e[::-1], vectors[:, ::-1]
    k = min(components, size)
    assert len(got) == n * k
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    for c, rs in by.items():
        assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in rs) == sorted((i is None, i or 0, d) for (i, _), d in zip(kept, deviation))
        assert {r.n for r in rs} == {n}
        if e[c - 1] > 1e-9 * max(e):
            assert all(r.explained == pytest.approx(e[c - 1] / e.sum(), rel=1e-9) for r in rs)
            own = np.sort([r.whitened for r in rs])
            want = centred @ vectors[:, c - 1] / np.sqrt(e[c - 1])
            assert np.allclose(own, np.sort(want), atol=1e-7) or np.allclose(own, np.sort(-want), atol=1e-7)
        else:
            assert all(r.whitened is None for r in rs)
    assert len({r.identity_error for r in got}) == 1
    return e


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = queries.op12_whitening(spark, sf_dir).collect()
    compare(got, rows, 64)
    assert got[0].identity_error < 1e-10


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 40 or None, rng.standard_normal(6).tolist()) for i in range(60)]
    rows += [(1, None), (2, []), (3, [1.0, None, 0, 0, 0, 0]), (4, [float("nan")] * 6), (5, [float("inf"), 0, 0, 0, 0, 0]),
             (6, [1.0, 2.0]), (700, [3.4e38] * 6), (8, rows[0][1]), (8, rows[0][1])]
    rows = [(i, v if v is None else [c if c is None or not math.isfinite(c) else float(np.float32(c)) for c in v]) for i, v in rows]
    got = whitening.by_component(whitening.whitened(frame(spark, rows).repartition(7))).collect()
    compare(got, [r for r in rows if r[0] != 700], 6)
    assert whitening.by_component(whitening.whitened(frame(spark, []))).count() == 0
    assert whitening.by_component(whitening.whitened(frame(spark, [(1, None)]))).count() == 0


def test_without_variance(spark):
    one = whitening.by_component(whitening.whitened(frame(spark, [(1, [0.5, 0.25])]))).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = [(i, [float(i), 7.0, 2.0 * i]) for i in range(9)]  # one direction only
    got = whitening.by_component(whitening.whitened(frame(spark, flat))).collect()
    assert {(r.component, round(r.explained, 9), r.whitened is None) for r in got} == {(1, 1.0, False), (2, 0.0, True), (3, 0.0, True)}


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(i) * 2.0**40, 2.0**45 - i * 2.0**30]) for i in range(12)]
    got = whitening.whitened(frame(spark, rows)).orderBy("vec_id").collect()
    x = [[64 * int(c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    assert [int(r.deviation) for r in got] == [sum((12 * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    wide = whitening.by_component(whitening.whitened(frame(spark, rows))).collect()
    assert all(r.deviation is None or r.deviation < 2**63 for r in wide)


def test_triangles_of_many_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    docs = spark.read.parquet(f"{sf_dir}/embeddings.parquet").repartition(11)
    model = whitening.fit(docs)
    assert whitening.identity_error(docs, model) < 1e-10
    again = whitening.fit(docs.withColumn("k", F.lit(1)).coalesce(1))
    assert np.allclose(model.values, again.values, rtol=1e-12) and model.sums == again.sums


def spectra():
    rng = np.random.default_rng(5)

    def turned(values):
        q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
        return np.linalg.qr(np.diag(values) @ q, mode="r")

    return {
        "random": np.triu(rng.standard_normal((64, 64))), "graded": turned([2.0**-i for i in range(40)]), "steep": turned([0.1**i for i in range(16)]),
        "clusters": turned([1.0] * 10 + [1 + 1e-9] * 10 + [3.0] * 5 + [1e-5] * 5), "near": turned([1 + 1e-12 * i for i in range(30)]),
        "all equal": np.eye(9), "zero": np.zeros((4, 4)), "singular": turned([4.0, 2.0, 1.0, 0.0, 0.0]), "one": np.array([[3.0]]),
        "glued": np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1),
    }


@pytest.mark.parametrize("name", spectra())
def test_solver(name):
    r = spectra()[name]
    values, vectors = whitening.principal(r, 1)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    most = max(want.max(), 1e-300)
    assert np.abs(np.sqrt(values) - np.sqrt(want)).max() <= 1e-12 * np.sqrt(most)
    assert np.abs(vectors.T @ vectors - np.eye(len(r))).max() < 1e-13
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max() <= 1e-12 * most


def test_small_singular_values_are_accurate():
    """A bidiagonal matrix has its small singular values to relative accuracy."""
    diagonal, above = np.array([1.0, 1e-5, 1e-10, 1e-15]), np.array([1.0, 1.0, 1.0])
    got = whitening.singular_values_squared(diagonal, above)
    product = math.prod(float(v) for v in got)
    assert product == pytest.approx(1e-60, rel=1e-10)


def test_whole_numbers_parts_lengths():
    column = pa.array([[0.5, 1.0], None, [], [0.25], [None, 1.0], [-0.01, 2.0]], pa.list_(pa.float64()))
    got = {size: (at.tolist(), x.tolist()) for size, at, x in whitening.whole_numbers(column)}
    assert got == {1: ([3], [[1_000_016]]), 2: ([0, 5], [[1_000_032, 1_000_064], [999_999, 1_000_128]])}
