"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers x = floor(64 c) + 1000000, so that the number of vectors n and the sums S
are exact and n x - S is a centred row without rounding (times n).

1. Blockwise QR: each task reduces its centred rows to one upper triangle, block by block; triangles
   of ``FAN_IN`` tasks at a time are stacked and reduced again until one, R, is left.
2. R / sqrt(n) is made bidiagonal by Householder reflections from both sides.
3. dqds gives the singular values, small ones to the same relative accuracy as large ones: shifts
   from the trailing corner are tried, a Newton bound below the least value is the safe shift.
4. The right singular vectors come from twisted factorisations of B'B - s I, joined where the twist's
   pivot is least. Values closer than ``CLUSTER`` are taken together: their vectors are iterated on
   and kept orthogonal to each other.
5. Rows are projected where they are. The covariance of what comes out is summed up in a last pass.

What the driver sees is d x d numbers, whatever the number of rows.

Defined cases: vectors that are null or empty or hold a null or non-finite entry (or one whose x is no
long) are left out; so are those of another length than most (the longer on a tie), which have no
covariance with the rest. Ids may be null and rows repeat: each counts. A direction without variance
has null ``whitened`` values and explains 0 (null if no direction has any). An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import settled

FACTOR, OFFSET = 64, 1_000_000
COMPONENTS = 32
FAN_IN = 32
CLUSTER = 1e-3
EPS = float(np.finfo(np.float64).eps)
_SAFE = 2**62
_SCHEMA = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


# --- dense kernels, on d x d numbers ---------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of B = U' r V, by Householder reflections."""
    b, d = r.astype(np.float64).copy(), len(r)
    v = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        norm = np.linalg.norm(x)
        if norm == 0:
            return x, 0.0
        w = x / norm
        w[0] += np.copysign(1.0, w[0])
        return w, 2.0 / float(w @ w)

    for k in range(d):
        w, scale = reflector(b[k:, k].copy())
        b[k:, k:] -= scale * np.outer(w, w @ b[k:, k:])
        if k < d - 2:
            w, scale = reflector(b[k, k + 1:].copy())
            b[k:, k + 1:] -= scale * np.outer(b[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= scale * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(b).copy(), np.diag(b, 1).copy(), v


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transformation; None if the shift is beyond the least value."""
    out_q, out_e, d = [], [], q[0] - shift
    for i, x in enumerate(e):
        if d < 0:
            return None
        total = d + x
        out_q.append(total)
        t = q[i + 1] / total if total > 0 else 0.0
        out_e.append(x * t)
        d = (d * t if total > 0 else q[i + 1]) - shift
    if d < 0:
        return None
    return [*out_q, d], out_e


def _below_least(q: list[float], e: list[float]) -> float:
    """Newton's bound below the least value: one over the trace of the inverse."""
    w, inverse = 1.0, 0.0
    for i, x in enumerate(q):
        if x <= 0:
            return 0.0
        inverse += w / x
        w = 1 + (e[i] / x) * w if i < len(e) else w
    return (1 - 1e-12) / inverse if np.isfinite(inverse) else 0.0


def _shifts(q: list[float], e: list[float], newton: float) -> list[float]:
    """Shifts to try, the last two being safe."""
    last, before = q[-1] + e[-1], q[-2] + (e[-2] if len(e) > 1 else 0.0)
    off, gap = q[-2] * e[-1], (before - last) / 2
    root = gap + float(np.hypot(gap, np.sqrt(off)))
    corner = last - (off / root if root > 0 else float(np.sqrt(off)))
    near = corner - float(np.sqrt(off))
    return [s for s in (corner * (1 - 4 * EPS), near) if s > newton] + [newton, 0.0]


def singular_values_squared(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The eigenvalues of B'B, falling, by dqds with deflation and splitting."""
    tiny = (100 * EPS) ** 2
    found: list[float] = []
    work = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while work:
        q, e, sigma = work.pop()
        sweeps = 0
        while len(q) > 1:
            if max(q) + max(e) <= 2 * EPS * sigma:  # a cluster that rounding does not part
                break
            newton = _below_least(q, e)
            if e[-1] <= tiny * (sigma + max(newton, min(q[-1], q[-2]))):
                found.append(sigma + q.pop())
                e.pop()
                sweeps = 0
                continue
            cut = next((i for i in range(len(e) - 2, -1, -1) if e[i] <= tiny * (sigma + newton)), None)
            if cut is not None:
                work.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1] and sweeps % 40 == 0:  # the same values from the other end: the small end goes last
                q, e = q[::-1], e[::-1]
            for shift in _shifts(q, e, newton):
                done = _step(q, e, shift)
                if done is not None:
                    q, e = done
                    sigma += shift
                    break
            sweeps += 1
            if sweeps > 1000:
                raise ArithmeticError("dqds does not converge")
        found += [sigma + x for x in q]
    return np.sort(np.array(found))[::-1]


def _twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, float]:  # noqa: E741
    """Solves along the twist: the vector and the twist's pivot, its residual."""
    n, floor = len(d), EPS * EPS * float(np.abs(d).max())
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(max(0, n - 1)), np.empty(max(0, n - 1))
    s[0], p[-1] = -value, d[-1] - value
    for i in range(n - 1):
        pivot = s[i] + d[i]
        pivot = pivot if abs(pivot) > floor else -floor
        down[i] = d[i] * l[i] / pivot
        s[i + 1] = down[i] * l[i] * s[i] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * l[i] * l[i] + p[i + 1]
        pivot = pivot if abs(pivot) > floor else -floor
        t = d[i] / pivot
        up[i] = l[i] * t
        p[i] = p[i + 1] * t - value
    gamma = s + p + value
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z, float(gamma[r])


def _solved(d: np.ndarray, l: np.ndarray, value: float, rhs: np.ndarray) -> np.ndarray:  # noqa: E741
    """(B'B - value) x = rhs, by the factorisation from the top."""
    n, floor = len(d), EPS * float(np.abs(d).max())
    pivots, down, s = np.empty(n), np.empty(max(0, n - 1)), -value
    y = rhs.copy()
    for i in range(n):
        pivots[i] = s + d[i]
        if abs(pivots[i]) < floor:
            pivots[i] = -floor
        if i < n - 1:
            down[i] = d[i] * l[i] / pivots[i]
            s = down[i] * l[i] * s - value
            y[i + 1] -= down[i] * y[i]
    y /= pivots
    for i in range(n - 2, -1, -1):
        y[i] -= down[i] * y[i + 1]
    return y


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of B'B for its eigenvalues ``values`` (falling)."""
    n = len(diagonal)
    out = np.zeros((n, len(values)))
    scale = float(np.sqrt(values.max(initial=0.0)))
    if scale == 0:
        return np.eye(n)[:, :len(values)]
    least = EPS * EPS * scale
    a = np.where(np.abs(diagonal) > least, diagonal, least)
    d, l = a * a, above / a[:-1]  # noqa: E741
    rng = np.random.default_rng(12)
    edges = [0, *(j for j in range(1, len(values)) if values[j - 1] - values[j] > CLUSTER * values[j - 1]), len(values)]
    missing: list[int] = []
    for start, end in zip(edges, edges[1:]):
        found: list[int] = []
        for j in range(start, end):
            z = _apart(_one(d, l, float(values[j])), out[:, found])
            for _ in range(2):  # too near to those before: from a start that is orthogonal to them
                if z is None and found:
                    begin = _apart(rng.standard_normal(n), out[:, found])
                    z = _apart(_solved(d, l, float(values[j]), begin), out[:, found])
            if z is None:
                missing.append(j)
            else:
                out[:, j] = z
                found.append(j)
    # one orthogonal base: what is missing lies in what the others leave
    there = [j for j in range(len(values)) if j not in set(missing)]
    base, r = np.linalg.qr(np.hstack([out[:, there], rng.standard_normal((n, len(missing)))]))
    base *= np.where(np.diag(r) < 0, -1.0, 1.0)
    out[:, there], rest = base[:, :len(there)], base[:, len(there):]
    b = np.diag(diagonal) + np.diag(above, 1)
    if missing:
        out[:, missing] = rest @ np.linalg.svd(b @ rest)[2].T
    for start, end in zip(edges, edges[1:]):
        if end - start > 1:  # turned inside the cluster so that each belongs to its value
            group = out[:, start:end]
            out[:, start:end] = group @ np.linalg.svd(b @ group)[2].T
    return out


def _one(d: np.ndarray, l: np.ndarray, value: float) -> np.ndarray:  # noqa: E741
    """The vector of a value by a twisted factorisation, with Rayleigh's correction."""
    z, residual = _twisted(d, l, value)
    for _ in range(2):
        norm = float(z @ z)
        if not np.isfinite(norm) or abs(residual) <= 4 * EPS * value * np.sqrt(norm):
            break
        value += residual / norm
        z, residual = _twisted(d, l, value)
    return z


def _apart(z: np.ndarray, others: np.ndarray) -> np.ndarray | None:
    """``z`` made orthogonal to ``others``, of length 1; None if little is left of it."""
    norm = float(np.linalg.norm(z))
    if not np.isfinite(norm) or norm == 0:
        return None
    z = z / norm
    for _ in range(2):
        z = z - others @ (others.T @ z)
    norm = float(np.linalg.norm(z))
    return z / norm if norm > 0.1 else None


def principal(r: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of r'r / n. Values that rounding
    cannot tell from 0 are 0."""
    diagonal, above, v = bidiagonal(r / np.sqrt(n))
    values = singular_values_squared(diagonal, above)
    vectors = v @ right_vectors(diagonal, above, values)
    values = np.where(values <= (8 * len(r) * EPS) ** 2 * values.max(initial=0.0), 0.0, values)
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * np.where(sign == 0, 1.0, sign)


# --- rows ------------------------------------------------------------------------------------


def whole_numbers(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places of rows, x) for each length of the valid vectors of a batch."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == size)
        c = entries[starts[at][:, None] + np.arange(size)]
        with np.errstate(invalid="ignore", over="ignore"):
            x = np.floor(FACTOR * c)
            ok = (np.abs(x) < 2.0**62).all(axis=1)  # not a number compares as false
        if ok.any():
            yield int(size), at[ok], x[ok].astype(np.int64) + OFFSET


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: as 64-bit numbers where they suffice."""
    if n * max(1, int(np.abs(x).max(initial=0))) < _SAFE and max(map(abs, sums), default=0) < _SAFE:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


@dataclass(frozen=True)
class Whitening:
    """What a fit leaves: the number and sums of the vectors, eigenvalues (falling) and directions."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    def projected(self, gaps: np.ndarray, components: int) -> np.ndarray:
        """Whitened rows; 0 in directions without variance."""
        e = self.values[:components]
        scale = np.where(e > 0, 1 / np.sqrt(np.where(e > 0, e, 1)), 0.0)
        return (gaps / self.n).astype(np.float64) @ (self.vectors[:, :components] * scale)


def _vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def _totals(rows: DataFrame) -> tuple[int, list[int]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = defaultdict(int), {}
        for batch in batches:
            for size, at, x in whole_numbers(batch.column(0)):
                n[size] += len(at)
                small = np.abs(x).max() < 2**40
                total = x.sum(0).astype(object) if small else x.astype(object).sum(0)
                sums[size] = sums[size] + total if size in sums else total
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64()), pa.array([[str(t) for t in sums[s]] for s in n], pa.list_(pa.string()))],
                names=["size", "n", "sums"])

    parts = settled(rows.select("embedding").mapInArrow(add, "size long, n long, sums array<string>"))
    most = parts.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return 0, []
    each = parts.filter(F.col("size") == most["size"]).select(F.posexplode("sums").alias("at", "s"))
    totals = each.groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()
    return most["n"], [int(t["s"]) for t in totals]


def _triangle(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows."""
    d = len(sums)

    def packed(r: np.ndarray, number: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int64()), "r": pa.array([r.ravel().tobytes()], pa.binary())})

    def reduced(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        r = None
        for block in blocks:
            r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
        return r

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for size, _, x in whole_numbers(batch.column(0)):
                if size == d:
                    gaps = (centred(x, n, sums) / n).astype(np.float64)
                    yield np.vstack([gaps, np.zeros((max(0, d - len(gaps)), d))])  # so that R is square

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = reduced(rows_of(batches))
        if r is not None:
            yield packed(r, TaskContext.get().partitionId())

    def again(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        r = reduced(np.frombuffer(b, np.float64).reshape(d, d) for b in group["r"])
        return pd.DataFrame({"number": [key[0]], "r": [r.ravel().tobytes()]})

    kind = "number long, r binary"
    triangles = settled(rows.select("embedding").mapInArrow(first, kind))
    while triangles.agg(F.max("number")).first()[0] > 0:  # numbered by partition, so FAN_IN at most come together
        group = F.floor(F.col("number") / FAN_IN).alias("number")
        triangles = settled(triangles.groupBy(group).applyInPandas(again, kind))
    return np.frombuffer(triangles.first()["r"], np.float64).reshape(d, d)


def fit(embeddings: DataFrame) -> Whitening:
    """The whitening of (vec_id, embedding)."""
    rows = _vectors(embeddings)
    n, sums = _totals(rows)
    if not n:
        return Whitening(0, [], np.empty(0), np.empty((0, 0)))
    return Whitening(n, sums, *principal(_triangle(rows, n, sums), n))


def identity_error(embeddings: DataFrame, model: Whitening, components: int = COMPONENTS) -> float | None:
    """The largest entry of the whitened rows' covariance minus the identity (directions with variance)."""
    used = np.flatnonzero(model.values[:components] > 0)
    if not len(used):
        return None
    d = len(model.sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(used), len(used)))
        for batch in batches:
            for size, _, x in whole_numbers(batch.column(0)):
                if size == d:
                    w = model.projected(centred(x, model.n, model.sums), components)[:, used]
                    total += w.T @ w
        yield pa.RecordBatch.from_pydict({"products": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    parts = _vectors(embeddings).select("embedding").mapInArrow(add, "products array<double>")
    sums = parts.select(F.posexplode("products").alias("at", "p")).groupBy("at").agg(F.sum("p").alias("p")).orderBy("at").collect()
    cov = np.array([s["p"] for s in sums]).reshape(len(used), len(used)) / model.n
    return float(np.abs(cov - np.eye(len(used))).max())


def whitened(embeddings: DataFrame, *, components: int = COMPONENTS, model: Whitening | None = None) -> DataFrame:
    """A row for each valid vector: vec_id, n, deviation (the exact squared distance of n x from S),
    and for each component its ``whitened`` value and ``explained`` part of the variance, with the
    fit's ``identity_error``."""
    model = model or fit(embeddings)
    if not model.n:
        return embeddings.sparkSession.createDataFrame([], _SCHEMA)
    error, d = identity_error(embeddings, model, components), len(model.sums)
    values = model.values[:components]
    trace = float(model.values.sum())
    explained = [float(e) / trace for e in values] if trace > 0 else [None] * len(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, x in whole_numbers(batch.column(1)):
                if size != d:
                    continue
                gaps = centred(x, model.n, model.sums)
                most = int(np.abs(gaps).max(initial=0))
                if most * most * d < _SAFE:
                    deviation = pa.array((gaps.astype(np.int64) ** 2).sum(1)).cast(pa.decimal128(38, 0))
                else:
                    deviation = pa.array([_decimal(v) for v in (gaps.astype(object) ** 2).sum(1)], pa.decimal128(38, 0))
                w = model.projected(gaps, components)
                flat = pa.array(w.ravel(), mask=np.tile(values == 0, len(w)))
                count = len(w)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at)), pa.array(np.full(count, model.n)), deviation,
                    pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * len(values), pa.int32()), flat),
                    pa.array([explained] * count, pa.list_(pa.float64())), pa.array([error] * count, pa.float64()),
                ], names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return _vectors(embeddings).mapInArrow(project, _SCHEMA)


def _decimal(value: int):
    from decimal import Decimal

    return Decimal(value) if abs(value) < 10**38 else None


def by_component(rows: DataFrame) -> DataFrame:
    """A row for each vector and component; ``deviation`` as a long, null where it is none."""
    each = rows.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "explained", "identity_error",
                       F.posexplode("whitened").alias("_at", "_w"))
    return each.select("vec_id", (F.col("_at") + 1).alias("component"), "n", "deviation", F.col("_w").alias("whitened"),
                       F.get("explained", F.col("_at")).alias("explained"), "identity_error")
