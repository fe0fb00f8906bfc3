"""Embedding whitening by spectrum slicing.

x = floor(64 * c) + 1000000 are whole numbers, so the sums S and the count n
are exact, and every row is centred as (n * x - S) / n before anything is
multiplied. Each partition gives the scatter about its own mean; partitions
are added up by (i, j) with the term between their means. Only the d x d
covariance reaches the driver.

There the leading eigenvalues are sliced: the inertia of V - s I, read from
its pivoted LDL' factors, counts the eigenvalues above s, and bisection on s
closes in on the k-th until the count shows it alone in its interval. Rayleigh
quotient iteration from inside the interval converges cubically; its value is
taken only if counts on both sides of it number it k. Eigenvalues that can't
be told apart at rounding (a repeated eigenvalue) are taken as a group, whose
vectors are kept orthogonal to one another.

Nulls and edge cases: null vectors and vectors with a null, NaN or infinite
entry are left out. Vectors of another length are a fit list of their own.
Repeated rows and null ids are rows like others. Components whose eigenvalue
is zero at rounding (rank below the dimension, a single row) can't be scaled
to variance one and aren't returned. A deviation beyond a 64-bit whole number
is null. An empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C

SCALE, SHIFT = 64, 1_000_000
MOST = 32
BLOCK = 1 << 21          # entries of a block of rows that is worked on at a time
EPS = np.finfo(float).eps


# -------------------------------------------------------------- LDL' inertia and eigenpairs

def inertia(a: np.ndarray) -> tuple[int, int]:
    """(positive, negative) eigenvalues of a symmetric matrix, from LDL' with pivots of 1 or 2 rows (Bunch-Kaufman)."""
    a = a.copy()
    n, k, plus, minus = len(a), 0, 0, 0
    alpha = (1 + 17 ** 0.5) / 8

    def swap(p: int, q: int) -> None:
        if p != q:
            a[[p, q], k:] = a[[q, p], k:]
            a[k:, [p, q]] = a[k:, [q, p]]

    while k < n:
        two = False
        if k + 1 < n:
            col = np.abs(a[k + 1:, k])
            r = k + 1 + int(np.argmax(col))
            lam = col[r - k - 1]
            if lam > 0 and abs(a[k, k]) < alpha * lam:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                sigma = row.max()
                if abs(a[k, k]) * sigma < alpha * lam * lam:
                    if abs(a[r, r]) >= alpha * sigma:
                        swap(k, r)
                    else:
                        two = True
                        swap(k + 1, r)
        if two:                                  # its determinant is negative: one of each sign
            d, l = a[k:k + 2, k:k + 2].copy(), a[k + 2:, k:k + 2].copy()
            a[k + 2:, k + 2:] -= l @ np.linalg.solve(d, l.T)
            plus, minus, k = plus + 1, minus + 1, k + 2
        else:
            d, l = a[k, k], a[k + 1:, k].copy()
            if d != 0:
                a[k + 1:, k + 1:] -= np.outer(l, l / d)
            plus, minus, k = plus + (d > 0), minus + (d < 0), k + 1
    return plus, minus


def above(v: np.ndarray, s: float) -> int:
    """How many eigenvalues of v are above s."""
    return inertia(v - s * np.eye(len(v)))[0]


def _rayleigh(v: np.ndarray, shift: float, apart: np.ndarray, tol: float, seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from ``shift``, orthogonal to the rows of ``apart``."""
    d = len(v)
    x = np.random.default_rng(seed).standard_normal(d)
    value = shift
    best = (np.inf, shift, x / np.linalg.norm(x))
    for step in range(40):
        m = v - value * np.eye(d)
        try:
            x = np.linalg.solve(m, x)
        except np.linalg.LinAlgError:            # the shift is an eigenvalue: next to it the solution grows along its vector
            x = np.linalg.solve(m + tol * np.eye(d), x)
        x /= np.abs(x).max()
        for _ in range(2):
            x = x - apart.T @ (apart @ x)
        x /= np.linalg.norm(x)
        if step == 0:
            continue                             # a second step with the isolating shift first
        value = float(x @ (v @ x))
        left = float(np.abs(v @ x - value * x).max())
        if left < best[0] / 2:
            best = (left, value, x)
        elif step > 3:
            break
    return best[1], best[2]


def leading(v: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues, falling, and their unit vectors as rows; those that are zero at rounding left out."""
    d = len(v)
    norm = float(np.abs(v).sum(1).max()) if d else 0.0
    tol = 8 * d * EPS * norm
    if norm == 0:
        return np.zeros(0), np.zeros((0, d))
    counts: dict[float, int] = {}

    def count(s: float) -> int:
        if s not in counts:
            counts[s] = above(v, s)
        return counts[s]

    values: list[float] = []
    vectors = np.zeros((0, d))
    for k in range(1, min(most, count(tol)) + 1):
        # the tightest known bounds: count(lo) >= k > count(hi)
        lo = max((s for s, c in counts.items() if c >= k))
        hi = min((s for s, c in counts.items() if c < k), default=norm * 1.01)
        while True:
            while hi - lo > tol and not (count(lo) == k and count(hi) == k - 1):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if count(mid) >= k else (lo, mid)
            # neighbours that rounding can't tell from this one are kept apart by hand
            near = vectors[[i for i, e in enumerate(values) if e - hi <= 64 * tol]] if values else vectors
            value, x = _rayleigh(v, (lo + hi) / 2, near, tol, k)
            # certified: k eigenvalues above value - tol, fewer than k above value + tol
            if lo - 2 * tol <= value <= hi + 2 * tol and count(value - 2 * tol) >= k > count(value + 2 * tol):
                break
            if hi - lo <= tol:
                raise ArithmeticError(f"eigenvalue {k} could not be isolated")
            mid = (lo + hi) / 2                  # it went to a neighbour: start nearer
            lo, hi = (mid, hi) if count(mid) >= k else (lo, mid)
        values.append(value)
        vectors = np.vstack([vectors, x])
    return np.array(values), vectors


# -------------------------------------------------------------- rows

def _rows(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    e = F.col(embedding).cast("array<double>")
    ok = F.col("e").isNotNull() & ~F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), e.alias("e")).filter(ok)
            .select("vec_id", F.size("e").cast("long").alias("d"), "e"))


def _whole(batch: pa.RecordBatch):
    """Of a batch, by vector length and in blocks: (length, rows, x as whole numbers)."""
    d = batch.column(batch.schema.get_field_index("d")).to_numpy()
    e = batch.column(batch.schema.get_field_index("e"))
    off, flat = e.offsets.to_numpy(), e.values.to_numpy(zero_copy_only=False)
    for size in np.unique(d):
        rows = np.flatnonzero(d == size)
        step = max(1, BLOCK // max(1, size))
        for lo in range(0, len(rows), step):
            at = rows[lo:lo + step]
            c = flat[off[at][:, None] + np.arange(size)]
            yield int(size), at, np.floor(SCALE * c).astype(np.int64) + SHIFT


_SUMS = "d long, i int, n long, s long"


def _sums(batches):
    total: dict[int, list] = {}
    for batch in batches:
        for d, at, x in _whole(batch):
            t = total.setdefault(d, [0, np.zeros(d, np.int64)])
            t[0] += len(at)
            t[1] += x.sum(0)
    for d, (n, s) in total.items():
        yield C.out_batch(C.arrow(_SUMS), d=np.full(d, d), i=np.arange(d, dtype=np.int32), n=np.full(d, n), s=s)


@dataclass
class Fit:
    """Of one vector length: rows, sums, eigenvalues (falling), components as rows, trace of the covariance."""

    n: int
    s: np.ndarray
    values: np.ndarray = None
    vectors: np.ndarray = None
    trace: float = 0.0
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.s) / float(self.n)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors.T / np.sqrt(self.values)


_SCATTER = "d long, i int, j int, n long, scatter double, mi double, mj double"


def _scatter(fits, project: bool):
    """Rows of centred or whitened vectors -> scatter of a partition about its own mean, with that mean."""
    def run(batches):
        total: dict[int, list] = {}
        for batch in batches:
            for d, at, x in _whole(batch):
                y = fits.value[d].whitened(x) if project else fits.value[d].centred(x)
                n, mean = len(y), y.mean(0)
                y = y - mean
                t = total.setdefault(d, [0, np.zeros(y.shape[1]), np.zeros((y.shape[1],) * 2)])
                step = mean - t[1]
                t[2] += y.T @ y + np.outer(step, step) * (t[0] * n / (t[0] + n))
                t[1] = t[1] + step * (n / (t[0] + n))
                t[0] += n
        for d, (n, mean, m) in total.items():
            i, j = np.triu_indices(len(mean))
            yield C.out_batch(C.arrow(_SCATTER), d=np.full(len(i), d), i=i.astype(np.int32), j=j.astype(np.int32),
                              n=np.full(len(i), n), scatter=m[i, j], mi=mean[i], mj=mean[j])
    return run


def _covariance(rows: DataFrame, fits, project: bool) -> dict[int, np.ndarray]:
    """Covariance (divisor n) of each vector length; one number an entry reaches the driver."""
    part = rows.mapInArrow(_scatter(fits, project), C.struct(_SCATTER))
    n = F.sum("n")
    entry = (F.sum(F.col("scatter") + F.col("n") * F.col("mi") * F.col("mj"))
             - F.sum(F.col("n") * F.col("mi")) * F.sum(F.col("n") * F.col("mj")) / n) / n
    out: dict[int, np.ndarray] = {}
    for r in part.groupBy("d", "i", "j").agg(entry.alias("v")).collect():
        f = fits.value[r.d]
        k = len(f.values) if project else r.d
        v = out.setdefault(r.d, np.zeros((k, k)))
        v[r.i, r.j] = v[r.j, r.i] = r.v
    return out


_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def _deviation(f: Fit, x: np.ndarray) -> pa.Array:
    """Sum of (n x - S)^2, exact; null beyond a 64-bit whole number."""
    c = f.n * x - f.s
    size = (c.astype(float) ** 2).sum(1)
    if len(size) and size.max() > 2.0 ** 62:     # near the limit: whole numbers of any size
        exact = [sum(int(a) ** 2 for a in row) for row in c.tolist()]
        return pa.array([v if v < 2 ** 63 else None for v in exact], pa.int64())
    return pa.array((c * c).sum(1))


def _emit(fits):
    schema = C.arrow(_OUT)

    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            for d, at, x in _whole(batch):
                f = fits.value[d]
                k = len(f.values)
                if not k:
                    continue
                m = len(at)
                take = pa.array(np.repeat(np.arange(m), k))
                yield C.out_batch(
                    schema, vec_id=ids.take(pa.array(at)).take(take),
                    component=np.tile(np.arange(1, k + 1, dtype=np.int32), m), n=np.full(m * k, f.n),
                    deviation=_deviation(f, x).take(take), whitened=f.whitened(x).ravel(),
                    explained=np.tile(f.values / f.trace, m), identity_error=np.full(m * k, f.error))
    return run


def fit(rows: DataFrame, most: int = MOST) -> dict[int, Fit]:
    """The components of each vector length, from all its rows."""
    sc = rows.sparkSession.sparkContext
    fits: dict[int, Fit] = {}
    for r in (rows.filter("d > 0").mapInArrow(_sums, C.struct(_SUMS)).groupBy("d", "i")
              .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()):
        fits.setdefault(r.d, Fit(r.n, np.zeros(r.d, np.int64))).s[r.i] = r.s
    for d, v in _covariance(rows.filter("d > 0"), sc.broadcast(fits), False).items():
        fits[d].values, fits[d].vectors = leading(v, most)
        fits[d].trace = float(np.trace(v))
    for d, v in _covariance(rows.filter("d > 0"), sc.broadcast(fits), True).items():
        fits[d].error = float(np.abs(v - np.eye(len(v))).max(initial=0.0))
    return fits


def whiten(vectors: DataFrame, most: int = MOST, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row a vector and component: whitened coordinate, explained share, deviation and the fit's error."""
    rows = _rows(vectors, vec_id, embedding)
    fits = rows.sparkSession.sparkContext.broadcast(fit(rows, most))
    return rows.filter("d > 0").mapInArrow(_emit(fits), C.struct(_OUT))


def op13_spectrum_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of embeddings on the 32 leading components."""
    return whiten(C.table(spark, sf_dir, "embeddings"))
