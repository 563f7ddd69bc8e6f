"""Operator 13, embedding whitening by FEAST contour integration.

Method: vectors become exact integers x = floor(64 * c) + 1000000. Workers sum them, then the products of what is left after an
integer centre near the mean is taken off, so the covariance comes from exact sums. Its eigenpairs are found interval by
interval: inertia counts (negative pivots of the factors of the shifted, tridiagonal matrix) say how many eigenvalues
lie below a point, and cut the upper end of the spectrum into intervals of few. In each, a quadrature over a circle around it
of complex shifted solves filters a block of vectors, Rayleigh-Ritz extracts eigenpairs from what the filter leaves, and
this repeats until the residuals are at rounding level; the interval must then hold as many as its inertia counts
say. A last Rayleigh-Ritz step over all intervals makes the components orthonormal. Only the matrix of the covariance (the
square of the vector length) is held by the driver; rows are read and projected by the workers.

Results for each row that is left and each component: vec_id, component (1 for the largest eigenvalue), n, deviation (exact; null where
it exceeds a long), whitened, explained, identity_error (measured on the whitened values of all rows).

Rows whose vector is null or holds null or non-finite entries go, and so do those with an entry beyond 2**53 / 64, which has no exact
integer. Vectors of different lengths are apart: each length is fitted by itself (its own n and identity_error). A direction in which the vectors don't
vary (its eigenvalue is zero to rounding; one row, or equal rows) cannot be whitened: its whitened is null, its explained 0, and it is
left out of identity_error, which is 0 if there is no other. Empty vectors give no rows. A null or repeated id is kept as it is. An empty table
gives an empty one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import prepare, table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**53
#: Eigenvalues that an interval should hold at most, and points of the quadrature on the upper half of its circle.
PER_INTERVAL = 12
NODES = 8
#: Widths, relative to the matrix: no interval is cut further, and no cut lies closer to an eigenvalue.
NARROW, CLEAR = 1e-6, 1e-7
TURNS = 30
#: Eigenvalues at most this share of the largest are zero.
ZERO = 1e-12
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of the symmetric v (Householder)."""
    a = v.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        w = p - (x @ p) * x
        rest -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, a[k + 1, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


class Inertia:
    """Counts of eigenvalues below a point."""

    def __init__(self, v: np.ndarray) -> None:
        self.diagonal, off = tridiagonal(v)
        self.squares = np.concatenate([[0.0], off**2])
        self.tiny = np.finfo(float).eps * max(np.abs(v).max(), 1e-300)

    def below(self, points: np.ndarray) -> np.ndarray:
        """For each point the negative pivots of the shifted matrix, which by inertia are its eigenvalues below the point."""
        points = np.atleast_1d(np.asarray(points, float))
        pivot, count = np.ones(len(points)), np.zeros(len(points), np.int64)
        for d, s in zip(self.diagonal, self.squares, strict=True):
            pivot = d - points - s / pivot
            pivot = np.where(np.abs(pivot) < self.tiny, -self.tiny, pivot)
            count += pivot < 0
        return count


def intervals(inertia: Inertia, lo: float, hi: float, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in between) from the top down, until they hold `wanted`. Cuts keep clear of eigenvalues where they can."""
    size = max(abs(lo), abs(hi))
    n_lo, n_hi = (int(c) for c in inertia.below([lo, hi]))
    todo, out, have = [(lo, hi, n_lo, n_hi)], [], 0
    while todo and have < wanted:
        a, b, below, above = todo.pop()
        if above == below:
            continue
        if above - below <= PER_INTERVAL or b - a <= NARROW * size:
            out.append((a, b, above - below))
            have += above - below
            continue
        cuts = a + (b - a) * np.array([0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65])
        counts = inertia.below(np.concatenate([cuts - CLEAR * size, cuts, cuts + CLEAR * size])).reshape(3, -1)
        best = int(np.argmax(counts[0] == counts[2]))
        todo += [(a, cuts[best], below, int(counts[1, best])), (cuts[best], b, int(counts[1, best]), above)]
    return out


def _solve(v: np.ndarray, lo: float, hi: float, count: int, block: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The eigenpairs in the interval, or None if the block of vectors did not give as many as counted."""
    d = len(v)
    x, weight = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (x + 1)
    middle, radius = (lo + hi) / 2, (hi - lo) / 2
    shift = radius * np.exp(1j * angle)
    y = np.random.default_rng(0).standard_normal((d, block))
    size = np.abs(v).max()
    best, since = np.inf, 0
    for _ in range(TURNS):
        # The filter: half of the circle is enough, as the other half gives the conjugate.
        q = np.zeros((d, block))
        for z, w in zip(shift, weight, strict=True):
            q += np.real(0.5 * w * z * np.linalg.solve((middle + z) * np.eye(d) - v, y))
        u, _ = np.linalg.qr(q)
        values, s = np.linalg.eigh(u.T @ v @ u)
        y = u @ s
        inside = (values >= lo) & (values < hi)
        if inside.sum() == count:
            worst = np.abs(v @ y[:, inside] - y[:, inside] * values[inside]).max() / size
            since = 0 if worst < 0.5 * best else since + 1
            best = min(best, worst)
            if worst < 4 * np.finfo(float).eps or (worst < 1e-12 and since >= 2):
                return values[inside], y[:, inside]
    return (values[inside], y[:, inside]) if best < 1e-10 and inside.sum() == count else None


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns (largest entry positive)."""
    d = len(v)
    wanted = min(wanted, d)
    reach = np.abs(v).sum(axis=1).max()
    if reach == 0:
        return np.zeros(wanted), np.eye(d)[:, :wanted]
    inertia = Inertia(v)
    ends = -reach * (1 + 1e-6), reach * (1 + 1e-6)
    found = []
    for lo, hi, count in intervals(inertia, *ends, wanted):
        # As wide a block as the eigenvalues that the filter lets through: those near the interval too.
        near = inertia.below([lo - (hi - lo) / 2, hi + (hi - lo) / 2])
        block, pairs = min(d, int(near[1] - near[0]) + 4), None
        while pairs is None:
            pairs = _solve(v, lo, hi, count, block)
            if pairs is None and block == d:
                raise ArithmeticError(f"{count} eigenvalues lie in ({lo}, {hi}), but not as many were found")
            block = min(d, 2 * block)
        found.append(pairs)
    q, _ = np.linalg.qr(np.hstack([x for _, x in found]))
    values, s = np.linalg.eigh(q.T @ v @ q)
    values, vectors = values[::-1][:wanted], (q @ s)[:, ::-1][:, :wanted]
    lead = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[lead, np.arange(wanted)])


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def _sums(dim: int):
    """Rows and exact sums per dimension of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            x = _integers(batch.column("v"), dim)
            n += len(x)
            total += x.sum(axis=0, dtype=object) if len(x) and np.abs(x).max() > 2**62 // len(x) else x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)), pa.array(np.full(dim, n))], names=["k", "s", "n"])

    return run


def _products(dim: int, rows_of):
    """Sums of the columns of rows_of(batch), and of their products, of each partition: k < 0 for the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            y = rows_of(batch)
            first += y.sum(axis=0)
            second += y.T @ y
        k = np.concatenate([-1 - np.arange(dim), np.arange(dim * dim)])
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.concatenate([first, second.ravel()]))], names=["k", "x"])

    return run


def _moments(rows: DataFrame, dim: int, n: int, rows_of) -> tuple[np.ndarray, np.ndarray]:
    """Mean and second moments over all rows."""
    got = {r["k"]: r["x"] / n for r in rows.mapInArrow(_products(dim, rows_of), "k long, x double").groupBy("k").agg(F.sum("x").alias("x")).collect()}
    return np.array([got[-1 - i] for i in range(dim)]), np.array([got[i] for i in range(dim * dim)]).reshape(dim, dim)


class Fit:
    """The components of all vectors of one length."""

    def __init__(self, rows: DataFrame, dim: int, components: int) -> None:
        sums = {r["k"]: (int(r["s"]), int(r["n"])) for r in rows.mapInArrow(_sums(dim), "k int, s decimal(38,0), n long").groupBy("k").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
        self.dim, self.n = dim, sums[0][1]
        self.sums = [sums[k][0] for k in range(dim)]
        # Whole numbers near the mean: what they leave is small and exact, and so are the sums of its products.
        centre = np.array([round(s / self.n) for s in self.sums], np.int64)
        rest = np.array([(s - self.n * int(c)) / self.n for s, c in zip(self.sums, centre, strict=True)])
        _, second = _moments(rows, dim, self.n, lambda batch: (_integers(batch.column("v"), dim) - centre).astype(float))
        v = second - np.outer(rest, rest)
        self.covariance = (v + v.T) / 2
        self.values, self.axes = leading(self.covariance, components)
        trace = np.trace(self.covariance)
        self.real = self.values > ZERO * max(self.values[0], 0.0)
        self.explained = np.where(self.real, self.values / trace if trace > 0 else 0.0, 0.0)

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - S, and where needed as Python integers: long sums could wrap."""
        big = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums))) >= 2**61
        d = x.astype(object) * self.n - np.array(self.sums, object) if big else x * self.n - np.array(self.sums, np.int64)
        return d, np.array(d, float)

    def whitened(self, d: np.ndarray) -> np.ndarray:
        return (d / self.n) @ self.axes[:, self.real] / np.sqrt(self.values[self.real])

    def measure(self, rows: DataFrame) -> float:
        """The largest entry of the covariance of the whitened values less the identity, over all rows."""
        k = int(self.real.sum())
        if not k:
            return 0.0
        mean, second = _moments(rows, k, self.n, lambda batch: self.whitened(self.deviations(_integers(batch.column("v"), self.dim))[1]))
        return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())

    def rows(self, error: float):
        k = len(self.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m = batch.num_rows
                exact, d = self.deviations(_integers(batch.column("v"), self.dim))
                if exact.dtype != object and (d**2).sum(axis=1).max(initial=0.0) > 2.0**62:
                    exact = exact.astype(object)
                squares = (exact**2).sum(axis=1)
                squares = pa.array([int(s) if s < 2**63 else None for s in squares.tolist()], pa.int64()) if exact.dtype == object else pa.array(squares)
                white = np.full((m, k), np.nan)
                white[:, self.real] = self.whitened(d)
                each = pa.array(np.repeat(np.arange(m), k))
                columns = [batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, self.n)), squares.take(each), pa.array(white.ravel(), from_pandas=True), pa.array(np.tile(self.explained, m)), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUT.split(", ")])

        return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each usable row and each of its leading components."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * SCALE < LARGEST))
    rows = rows.where(F.coalesce(fine, F.lit(False)) & (F.size("v") > 0))
    out = None
    for length in sorted(r["d"] for r in rows.groupBy(F.size("v").alias("d")).count().collect()):
        own = rows.where(F.size("v") == length)
        fit = Fit(own, length, components)
        one = own.mapInArrow(fit.rows(fit.measure(own)), OUT)
        out = one if out is None else out.unionAll(one)
    return spark.createDataFrame([], OUT) if out is None else out.withColumnRenamed("vec_id", id_col)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
