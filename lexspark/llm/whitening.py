"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed: a pass multiplies the centred rows by a block of vectors and back, in
Arrow batches, and adds up one small matrix. A Chebyshev polynomial of the covariance, applied by its
three-term recurrence of passes, damps the unwanted end of the spectrum; QR and Rayleigh-Ritz follow,
until the residuals certify the wanted components. The driver holds matrices of dimensions x block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.plans.lineage import cut_lineage

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
SEED = 42
TOLERANCE = 2e-14
MOST_DEGREE = 16
MOST_GROWTH = 1e9
MOST_ROUNDS = 200
LANCZOS_STEPS = 8
_SLOTS = 32
_FEW_BYTES = 1 << 30
_LONG = 1 << 63


def fixed_point(rows: DataFrame, scale: int = SCALE, offset: int = OFFSET, id_col: str = "vec_id",
                vector: str = "embedding") -> DataFrame:
    """(vec_id, x): vectors of finite entries, each as floor(scale * entry) + offset.

    Entries must fit into 64 bits then. Rows whose vector is NULL, has no entries, or holds NULL or
    non-finite entries are left out, and so are vectors shorter or longer than those of most rows (of
    the shorter, if two lengths are as many).
    """
    read = rows.select(F.col(id_col).alias("vec_id"), F.transform(vector, lambda c: c.cast("double")).alias("c"))
    finite = F.forall("c", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    kept = read.where((F.size("c") > 0) & finite)
    sizes = kept.groupBy(F.size("c").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.col("n").desc(), "d").first()
    return kept.where(F.size("c") == (most["d"] if most else 0)).select(
        "vec_id", F.transform("c", lambda c: F.floor(c * float(scale)) + F.lit(offset)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column as an integer matrix, without a copy."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass(frozen=True)
class Fit:
    """Number of rows, sums per dimension, and the least and largest entry of each."""

    n: int
    sums: tuple[int, ...]
    least: tuple[int, ...]
    most: tuple[int, ...]

    @property
    def exact_in_64_bits(self) -> bool:
        """Whether n * x - S and the sum of its squares stay below 2**63 for every row between the extremes."""
        far = [max(abs(self.n * a - s), abs(self.n * b - s)) for a, b, s in
               zip(self.least, self.most, self.sums, strict=True)]
        reach = max((self.n * max(abs(a), abs(b)) for a, b in zip(self.least, self.most, strict=True)), default=0)
        return sum(f * f for f in far) < _LONG and reach < _LONG

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: in 64 bits if they suffice, else in Python integers."""
        kind = np.int64 if self.exact_in_64_bits else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n with an error of one rounding."""
        return (self.deviations(x) / self.n).astype(np.float64)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums, least, most = 0, None, None, None
    for batch in batches:
        if not len(batch):
            continue
        x = _matrix(batch.column(0))
        n += len(x)
        own = [int(v) for v in x.astype(object).sum(axis=0)] if np.abs(x).max() >= _LONG >> 20 else x.sum(axis=0).tolist()
        sums = own if sums is None else [a + b for a, b in zip(sums, own, strict=True)]
        least = x.min(axis=0) if least is None else np.minimum(least, x.min(axis=0))
        most = x.max(axis=0) if most is None else np.maximum(most, x.max(axis=0))
    if n:
        d = len(sums)
        yield pa.RecordBatch.from_arrays([
            pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([str(s) for s in sums]),
            pa.array(least), pa.array(most),
        ], ["dim", "n", "sum", "least", "most"])


def measured(fit_rows: DataFrame) -> Fit:
    """Exact totals of the fit list, one row per dimension on the driver."""
    parts = fit_rows.select("x").mapInArrow(_measured, "dim int, n bigint, sum string, least bigint, most bigint")
    found = parts.groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"), F.min("least").alias("least"),
        F.max("most").alias("most")).orderBy("dim").collect()
    return Fit(found[0]["n"] if found else 0, tuple(int(r["sum"]) for r in found),
               tuple(r["least"] for r in found), tuple(r["most"] for r in found))


class Covariance:
    """Products with the covariance of the fit list, each a pass over it."""

    def __init__(self, fit_rows: DataFrame, fit: Fit):
        self.rows = fit_rows.select("x")
        self.fit = fit
        self.d = len(fit.sums)
        self.many = fit.n * self.d * 8 > _FEW_BYTES  # so many tasks that their sums are added by Spark first
        self.passes = 0

    def _summed(self, partial, shape: tuple[int, int]) -> np.ndarray:
        """Sum of one matrix per task, in the order of tasks; sums of many tasks are added in slots first."""
        def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                if len(batch):
                    total += partial(_matrix(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                ["task", "total"])

        def per_slot(_, rows: pa.Table) -> pa.Table:
            order = np.argsort(rows.column("task").to_numpy(), kind="stable")
            totals = rows.column("total").to_pylist()
            total = np.zeros(shape)
            for i in order:
                total += np.frombuffer(totals[i]).reshape(shape)
            return pa.table({"slot": pa.array([int(rows.column("task")[0].as_py()) % _SLOTS], pa.int32()),
                             "total": pa.array([total.tobytes()], pa.binary())})

        self.passes += 1
        tasks = self.rows.mapInArrow(per_task, "task int, total binary")
        if self.many:
            tasks = tasks.groupBy((F.col("task") % _SLOTS).alias("slot")).applyInArrow(per_slot, "slot int, total binary")
        else:
            tasks = tasks.withColumnRenamed("task", "slot")
        total = np.zeros(shape)
        for row in sorted(tasks.collect(), key=lambda r: r["slot"]):
            total += np.frombuffer(row["total"]).reshape(shape)
        return total

    def times(self, block: np.ndarray) -> np.ndarray:
        """V @ block."""
        fit = self.fit

        def partial(x: np.ndarray) -> np.ndarray:
            rows = fit.centred(x)
            return rows.T @ (rows @ block)

        return self._summed(partial, block.shape) / fit.n

    def trace(self) -> float:
        fit = self.fit
        return float(self._summed(lambda x: np.square(fit.centred(x)).sum(keepdims=True).reshape(1, 1), (1, 1))[0, 0]) / fit.n

    def of_projection(self, block: np.ndarray) -> np.ndarray:
        """Covariance of the rows' projections on a block, from the projections themselves."""
        fit, k = self.fit, block.shape[1]

        def partial(x: np.ndarray) -> np.ndarray:
            own = fit.centred(x) @ block
            return np.vstack([own.T @ own, own.sum(axis=0)])

        total = self._summed(partial, (k + 1, k)) / fit.n
        return total[:k] - np.outer(total[k], total[k])


def lower_end(cov: Covariance, start: np.ndarray, steps: int = LANCZOS_STEPS) -> float:
    """A value near or below the spectrum's lower end, by Lanczos steps on one vector; never below 0."""
    basis, diagonal, off = [start / np.linalg.norm(start)], [], []
    for _ in range(min(steps, cov.d)):
        w = cov.times(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        for q in (*basis, *basis):
            w -= (q @ w) * q
        off.append(float(np.linalg.norm(w)))
        if off[-1] <= 1e-12 * abs(diagonal[0]):
            off[-1] = 0.0
            break
        basis.append(w / off[-1])
    small = np.diag(diagonal) + np.diag(off[:-1], 1) + np.diag(off[:-1], -1)
    values, vectors = np.linalg.eigh(small)
    return max(0.0, float(values[0] - off[-1] * abs(vectors[-1, 0])))


def _growth(value: float, low: float, high: float, degree: int) -> float:
    """The Chebyshev polynomial of ``degree`` at a value above the damped interval."""
    at = max((2 * value - low - high) / (high - low), 1.0)
    return math.cosh(min(degree * math.acosh(at), 600.0))


def filtered(cov: Covariance, block: np.ndarray, locked: np.ndarray, low: float, high: float, degree: int,
             top: float) -> np.ndarray:
    """The Chebyshev polynomial of the covariance, damping [low, high] and scaled at ``top``, times a block.

    Locked components are taken out after each step, so that rounding does not bring them back.
    """
    centre, half = (high + low) / 2, (high - low) / 2

    def free(y: np.ndarray) -> np.ndarray:
        return y - locked @ (locked.T @ y)

    first = ratio = half / (top - centre)
    before, now = block, free((cov.times(block) - centre * block) * (first / half))
    for _ in range(2, degree + 1):
        following = 1 / (2 / first - ratio)
        before, now = now, free(2 * following / half * (cov.times(now) - centre * now) - ratio * following * before)
        ratio = following
    return now


@dataclass
class Components:
    """Unit eigenvectors as columns by falling eigenvalue, and how far they are certified."""

    vectors: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    passes: int
    rounds: int


def _ritz(cov: Covariance, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, values, residual norms) of the covariance in the span of a block."""
    q = np.linalg.qr(block)[0]
    image = cov.times(q)
    small = q.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors = q @ turn
    return vectors, values, np.linalg.norm(image @ turn - vectors * values, axis=0)


def leading_components(
    cov: Covariance, wanted: int = COMPONENTS, seed: int = SEED, tolerance: float = TOLERANCE, rounds: int = MOST_ROUNDS,
) -> Components:
    """The ``wanted`` leading eigenpairs, residuals at most ``tolerance`` times the largest eigenvalue.

    The block is twice as wide as wanted; the damped interval reaches from the spectrum's lower end to
    the least Ritz value, or ends below it if the wanted ones come too near. The degree is bounded by the growth between the block's first and last free
    vector, so that the last ones stay numerically independent. Certified leading vectors are locked.
    When all residuals are small enough, fresh random vectors are filtered once more: if they show a
    larger eigenvalue outside the span, it joins the block and the rounds go on. Residuals that rounding
    keeps above the tolerance end the rounds once they stop falling, if they are below its 50-fold.
    ArithmeticError says that ``rounds`` did not suffice.
    """
    draw = np.random.default_rng(seed)
    d, wanted = cov.d, min(wanted, cov.d)
    width = min(d, 2 * wanted)
    vectors, values, residuals = _ritz(cov, np.eye(d) if width == d else draw.standard_normal((d, width)))
    if width == d or values[0] <= 0:
        return Components(vectors[:, :wanted], values[:wanted], residuals[:wanted], cov.passes, 0)
    low = lower_end(cov, draw.standard_normal(d))
    best, stalled = math.inf, 0
    for done in range(1, rounds + 1):
        limit = tolerance * values[0]
        good = residuals[:wanted] <= limit
        worst = float(residuals[:wanted].max())
        stalled = stalled + 1 if worst > 0.5 * best else 0
        best = min(best, worst)
        settled = good.all() or (stalled >= 2 and worst <= 50 * limit)
        n_locked = int(np.argmin(good)) if not good.all() else wanted - 1
        if settled:
            n_locked = wanted
        locked, block = vectors[:, :n_locked], vectors[:, n_locked:]
        if settled:  # look for what the block may have missed
            block = draw.standard_normal((d, width - wanted))
            block -= locked @ (locked.T @ block)
            block = np.linalg.qr(block)[0]
        high, last = float(values[-1]), float(values[wanted - 1])
        low = min(low, high)
        if last - high < 0.01 * (high - low):  # equal eigenvalues reach beyond the block: damp below them
            high -= 0.1 * (high - low)
        top = float(values[min(n_locked, width - 1)])
        if high - low <= 1e-9 * values[0] or top <= high:
            low = min(low, high - 1e-3 * values[0])
            top = max(top, high + 1e-12 * values[0])
        degree = MOST_DEGREE
        while degree > 2 and _growth(top, low, high, degree) > MOST_GROWTH * _growth(last, low, high, degree):
            degree -= 1
        grown = filtered(cov, block, locked, low, high, degree, top)
        if settled:
            grown = np.linalg.qr(grown - locked @ (locked.T @ grown))[0]
            fresh, outside, _ = _ritz(cov, grown)
            if outside[0] <= last + 1e-10 * values[0]:
                return Components(vectors[:, :wanted], values[:wanted], residuals[:wanted], cov.passes, done)
            grown = fresh
        vectors, values, residuals = _ritz(cov, np.hstack([locked, grown]))
    raise ArithmeticError(f"{rounds} rounds leave a residual of {residuals[:wanted].max():.3g}")


def _projected(fit: Fit, block: np.ndarray, constant: list[tuple]):
    k = block.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                deviation = fit.deviations(_matrix(part.column(1)))
                whitened = (deviation / fit.n).astype(np.float64) @ block
                squares = np.repeat(np.square(deviation).sum(axis=1), k)
                ids = part.column(0).take(pa.array(np.repeat(np.arange(len(part)), k)))
                columns = [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                           pa.array(np.full(len(ids), fit.n)), pa.array(squares.tolist(), pa.int64()),
                           pa.array(whitened.ravel())]
                columns += [pa.array(np.tile(np.array(c, float), len(part))) for c in constant]
                yield pa.RecordBatch.from_arrays(columns, [
                    "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whitened(rows: DataFrame, components: int = COMPONENTS, seed: int = SEED, scale: int = SCALE,
             offset: int = OFFSET) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per kept row and component.

    Vectors become integers (``fixed_point`` says which rows are left out). Each distinct vector counts
    once in the fit, however often it stands in ``rows``; all kept rows are projected, repeated ones
    too, and a NULL id is kept. ``deviation`` is the exact sum of squares of n * x - S; one that needs
    more than 64 bits ends the job with OverflowError. ``identity_error`` is measured on the fit list's
    own projections. Directions without variance are no components: there are fewer than
    ``components`` rows a vector then, and none if all vectors are equal. An empty table gives an empty
    result; other columns are not read.
    """
    spark = rows.sparkSession
    points = cut_lineage(fixed_point(rows, scale, offset))
    fit_rows = cut_lineage(points.select("x").distinct())
    fit = measured(fit_rows)
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    if not fit.n:
        return spark.createDataFrame([], schema)
    cov = Covariance(fit_rows, fit)
    found = leading_components(cov, components, seed)
    real = found.values > 1e-12 * max(float(found.values[0]), 0.0) if found.values[0] > 0 else np.zeros(len(found.values), bool)
    values, vectors = found.values[real], found.vectors[:, real]
    if not len(values):
        return spark.createDataFrame([], schema)
    block = vectors / np.sqrt(values)
    error = float(np.abs(cov.of_projection(block) - np.eye(len(values))).max())
    explained = values / cov.trace()
    return points.mapInArrow(_projected(fit, block, [explained, np.full(len(values), error)]), schema)
