"""Whitening of embeddings.

The centred scatter of the distinct vectors is summed by Spark's tasks into one
row per dimension.  On that small matrix a Cholesky factorisation with diagonal
pivoting gives a triangular factor, and one-sided Jacobi rotations make the
factor's columns orthogonal: if ``P C P' = L L'`` and ``L V = U S`` with
orthonormal ``U``, the squared column norms ``S^2`` are the eigenvalues of the
covariance ``C`` and the columns of ``P' U`` its components.  The covariance is
never squared again, so small eigenvalues keep their relative precision.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, store

#: Quantised entry: floor(STEPS * c) + SHIFT.
STEPS, SHIFT = 64, 1_000_000
#: floor(STEPS * c) is held within this, far outside any embedding, so that sums stay exact.
LARGEST = 2.0**31
COMPONENTS = 16


def pivoted_cholesky(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(L, order)`` with ``c[order][:, order] = L L'``, L lower triangular with as many columns as the rank.

    Each step takes the largest diagonal entry that is left; it ends where
    that is rounding noise of the largest.
    """
    a, p = np.array(c, dtype=np.float64), len(c)
    order, left = np.arange(p), np.diag(a).copy()
    factor, least = np.zeros((p, p)), p * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    for k in range(p):
        j = k + int(np.argmax(left[k:]))
        if not left[j] > least:
            return factor[:, :k], order
        if j != k:
            a[[k, j]] = a[[j, k]]
            a[:, [k, j]] = a[:, [j, k]]
            factor[[k, j], :k] = factor[[j, k], :k]
            order[[k, j]], left[[k, j]] = order[[j, k]], left[[j, k]]
        factor[k, k] = np.sqrt(left[k])
        factor[k + 1 :, k] = (a[k + 1 :, k] - factor[k + 1 :, :k] @ factor[k, :k]) / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def _rounds(n: int):
    """The pairs of 0..n-1 in rounds of disjoint pairs (a round-robin tournament)."""
    seats = list(range(n + n % 2))
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[: len(seats) // 2], reversed(seats), strict=False) if a < n and b < n]
        yield np.array([min(x) for x in pairs], dtype=int), np.array([max(x) for x in pairs], dtype=int)
        seats = [seats[0], seats[-1], *seats[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60, tolerance: float = 1e-15) -> np.ndarray:
    """Rotate the factor's columns pairwise until all are orthogonal.  A round's disjoint pairs are rotated together."""
    u = np.array(factor, dtype=np.float64)
    rounds = list(_rounds(u.shape[1])) if u.shape[1] > 1 else []
    for _ in range(sweeps):
        worst = 0.0
        for i, j in rounds:
            x, y = u[:, i], u[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, float(off.max(initial=0.0)))
            turn = off > tolerance
            if not turn.any():
                continue
            i, j, x, y = i[turn], j[turn], x[:, turn], y[:, turn]
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            u[:, i], u[:, j] = cos * x - cos * t * y, cos * t * x + cos * y
        if worst <= tolerance:
            break
    return u


def eigen(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a covariance by falling size (as many as its rank) and the unit components as rows."""
    factor, order = pivoted_cholesky(c)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(0))
    rank = np.argsort(-norms, kind="stable")
    rows = np.zeros((len(rank), len(c)))
    rows[:, order] = (turned[:, rank] / norms[rank]).T
    return norms[rank] ** 2, rows


@dataclass
class Whitening:
    """What is learned from the fit list: its size, sums per dimension, components and eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def __post_init__(self):
        self.floor = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = [s - self.n * int(f) for s, f in zip(self.sums, self.floor, strict=True)]  # S - n * floor, exactly

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S/n``: whole parts are taken off exactly before anything is rounded."""
        return (x - self.floor).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of ``(n x - S)^2`` per row, exactly."""
        far = x - self.floor
        most = self.n * (int(np.abs(far).max(initial=0)) + 1)
        if most * most * x.shape[1] < 2**62:
            y = self.n * far - np.array(self.rest, dtype=np.int64)
            return pa.array((y * y).sum(1)).cast(pa.decimal128(38, 0))
        return pa.array([Decimal(sum((self.n * int(v) - r) ** 2 for v, r in zip(row, self.rest, strict=True))) for row in far], pa.decimal128(38, 0))


def _usable(vector: Column) -> Column:
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, entry), F.lit(False))


def _quantised(vector: Column) -> Column:
    step = lambda c: F.floor(F.least(F.greatest(c.cast("double") * STEPS, F.lit(-LARGEST)), F.lit(LARGEST))) + F.lit(SHIFT)
    return F.transform(vector, step)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(rows: DataFrame, of, width: int, columns: int, kind: str = "double") -> np.ndarray:
    """Sum over all rows of the (width x columns) matrices ``of(x)``, one partial sum per task, added up by Spark."""

    def part(batches):
        total = None
        for batch in batches:
            if len(batch):
                own = of(_matrix(batch.column(0), width))
                total = own if total is None else total + own
        if total is not None:
            at = pa.array(np.arange(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array(list(total), pa.list_(pa.from_numpy_dtype(total.dtype)))], ["i", "row"])

    parts = rows.mapInArrow(part, f"i int, row array<{kind}>").select("i", F.posexplode("row").alias("j", "v"))
    sums = parts.groupBy("i", "j").agg(F.sum(F.col("v") if kind == "double" else F.col("v").cast("decimal(38,0)")).alias("v"))
    out = np.zeros((columns, width), dtype=object if kind != "double" else float)
    for r in sums.toArrow().to_pylist():  # at most columns * width numbers
        out[r["i"], r["j"]] = int(r["v"]) if kind != "double" else r["v"]
    return out


def fit_whitening(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """Learn from the fit list, a stored table of one column ``x`` (distinct quantised vectors); None if it spans nothing."""
    counted = _summed(fit, lambda x: np.vstack([x.sum(0), np.full(x.shape[1], len(x))]).astype(np.int64), width, 2, "long")
    n, sums = int(counted[1, 0]), [int(v) for v in counted[0]]
    if n == 0:
        return None
    empty = Whitening(n, sums, np.zeros(0), np.zeros((0, width)), 0.0)

    def scatter(x):
        y = empty.centred(x)
        return y.T @ y

    covariance = _summed(fit, scatter, width, width) / n
    values, rows = eigen((covariance + covariance.T) / 2)
    if not len(values):
        return None
    found = Whitening(n, sums, values[:components], rows[:components], float(np.trace(covariance)))

    def moments(x):
        w = found.whiten(x)
        return np.pad(np.vstack([w.T @ w, w.sum(0)]), ((0, 0), (0, width - w.shape[1])))

    k = len(found.values)
    got = _summed(fit, moments, width, k + 1)[:, :k] / n
    found.identity_error = float(np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k)).max())
    return found


def whiten_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every usable vector, learned from the distinct quantised vectors.

    Returns ``vec_id, component`` (from 1, by falling eigenvalue), ``n`` (size
    of the fit list), ``deviation`` (decimal), ``whitened, explained,
    identity_error``, one row per vector and component.

    Vectors that are null, empty or hold null or non-finite entries are
    dropped, and so are those not of the length that most vectors have (the
    longer one on a tie).  Repeated rows and rows without id each get their
    rows.  There are at most as many components as the fit list has
    directions, so a table whose vectors are all alike, like an empty one, has
    an empty result.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where(_usable(F.col("v")) & (F.size("v") > 0))
    lengths = usable.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
    most = lengths.agg(F.max(F.struct("n", "width")).alias("m")).first()["m"]
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if most is None:
        return spark.createDataFrame([], schema)
    width = int(most["width"])
    quantised = usable.where(F.size("v") == width).select("vec_id", _quantised(F.col("v")).alias("x"))
    fit = store(quantised.select("x").distinct(), "whitening-fit")
    learned = fit_whitening(fit, width, components)
    if learned is None:
        return spark.createDataFrame([], schema)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches):
        k = len(learned.values)
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(1), width)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            m = len(x) * k
            cols = [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(m, learned.n)), learned.deviation(x).take(each)]
            cols += [pa.array(learned.whiten(x).ravel()), pa.array(np.tile(learned.values / learned.trace, len(x))), pa.array(np.full(m, learned.identity_error))]
            yield pa.RecordBatch.from_arrays(cols, names)

    return quantised.mapInArrow(project, schema)
