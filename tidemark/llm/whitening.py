"""Operator 12: whitening of embeddings, components by FEAST contour integration.

Entries are put on the grid ``floor(64 * c) + 1000000``.  The *fit list* holds
each grid vector once (copies collapse map-side).  Everything that grows with
the rows is a Spark job; what reaches the driver is of the size of a
covariance, whatever the number of rows.

1. Count and sums per dimension, then products of entries less the rounded
   mean, are exact integers: a block's products are one float matrix product
   that stays below 2**53, or Python integers where entries are too large.
   The covariance is their exact quotient, rounded once.
2. Inertia (signs of a pivoted ``L D L'`` of the shifted covariance) counts the
   eigenvalues above a shift.  Bisection on it finds the interval of the
   leading eigenvalues and cuts it into intervals of a few eigenvalues each.
3. Each interval is a row of a Spark job: FEAST integrates the resolvent round
   the interval (complex shifted solves at Gauss-Legendre nodes), which
   projects a block of vectors onto the interval's eigenspace; Rayleigh-Ritz
   takes the eigenpairs out, and the step is repeated until the residuals stop
   shrinking.  The pairs inside must be as many as the inertia counted, or the
   job fails.
4. Rows are centred, projected and scaled; the covariance of the whitened fit
   list is measured in a pass of its own.

Edge cases: vectors that are null or empty, or that hold a null or non-finite
entry (or one beyond 2**55, which no long on the grid holds), are left out; the
dimension is that of most of the others (the greater on a tie), and vectors of
another length are left out too.  Eigenvalues that rounding cannot tell from
zero have no component, so a table of one vector, or of equal ones, gives no
rows, like an empty table.  Equal eigenvalues have any orthonormal basis.  A
null id stays null; repeated rows give repeated rows; other columns are
ignored.  ``deviation`` is null where the exact value is no long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0 ** 55
NODES = 8            # quadrature nodes on the half circle
PER_INTERVAL = 6     # eigenvalues that an interval should hold at most
NARROW = 8.0         # ratio of an interval's ends, so that small eigenvalues do not crowd one end
ROUNDS = 10          # per block width; a block that does not converge is doubled
EPS = float(np.finfo(float).eps)
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


# ------------------------------------------------------------------ grid rows
def grid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``_v, _x`` of the rows whose vector can be used."""
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST))
    v = vectors.select(F.col(id_col).cast("long").alias("_v"), F.col(vector_col).cast("array<double>").alias("_c"))
    return v.filter((F.size("_c") > 0) & F.forall("_c", usable)).select(
        "_v", F.transform("_c", lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long")).alias("_x"))


def _commonest_length(grid: DataFrame) -> int:
    top = grid.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return top[0]["d"] if top else 0


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index("_x"))
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1).astype(np.int64, copy=False)


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


# -------------------------------------------------------------------- moments
@dataclass
class Moments:
    """Of the fit list: ``n`` vectors; ``mid`` the rounded mean, ``rest`` the
    sums of what is left after taking it off; ``cov`` the covariance."""

    n: int
    mid: np.ndarray
    rest: list[int]
    cov: np.ndarray

    @property
    def offset(self) -> np.ndarray:
        """The mean less its rounded value."""
        return np.array([r / self.n for r in self.rest])


def _exact_sum(x: np.ndarray) -> list[int]:
    if len(x) and int(np.abs(x).max()) >= (1 << 62) // len(x):
        x = x.astype(object)
    return x.sum(axis=0)


def _exact_gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` in exact integers."""
    top = int(np.abs(y).max()) if y.size else 0
    if top > 1 << 26:
        y = y.astype(object)
        return y.T.dot(y)
    step = max(1, min(len(y), (1 << 53) // max(1, top * top)))
    total = np.zeros((y.shape[1],) * 2, object)
    for i in range(0, len(y), step):
        part = y[i:i + step].astype(np.float64)
        total = total + np.rint(part.T @ part).astype(np.int64)
    return total


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for b in batches:
        x = _matrix(b)
        n += len(x)
        s = np.array(_exact_sum(x), object)
        total = s if total is None else total + s
    if n:
        values = _decimals([n, *total])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), values], names=["i", "s"])


def _products(batches: Iterator[pa.RecordBatch], mid: np.ndarray) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        g = _exact_gram(_matrix(b) - mid)
        total = g if total is None else total + g
    if total is not None:
        i, j = np.triu_indices(len(mid))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(total[i, j])],
                                         names=["i", "j", "s"])


def moments(fit: DataFrame) -> Moments | None:
    """Exact moments of a table of distinct grid vectors (``_x``)."""
    rows = fit.mapInArrow(_sums, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    if not rows:
        return None
    values = [int(r["s"]) for r in sorted(rows, key=lambda r: r["i"])]
    n, sums = values[0], values[1:]
    mid = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, mid)]
    at = np.array(mid, np.int64)
    pairs = fit.mapInArrow(lambda it: _products(it, at), "i int, j int, s decimal(38,0)") \
        .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    cov = np.zeros((len(mid),) * 2)
    for r in pairs:
        i, j = r["i"], r["j"]
        cov[i, j] = cov[j, i] = (n * int(r["s"]) - rest[i] * rest[j]) / (n * n)
    return Moments(n, at, rest, cov)


# -------------------------------------------------------------------- inertia
def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` exceed ``shift``: the positive pivots of
    ``L D L'`` with complete diagonal pivoting, 1x1 or 2x2 blocks."""
    a = a - shift * np.eye(len(a))
    positive = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal().copy()
        r = int(diagonal.argmax())
        np.fill_diagonal(size, 0.0)
        p, q = np.unravel_index(int(size.argmax()), size.shape)
        if diagonal[r] == 0 and size[p, q] == 0:
            break
        if diagonal[r] >= 0.6403882032022076 * size[p, q]:
            positive += a[r, r] > 0
            a = a - np.outer(a[:, r] / a[r, r], a[r])
            gone = [r]
        else:  # such a block has one eigenvalue of each sign
            positive += 1
            c = a[:, [p, q]]
            a = a - c @ np.linalg.solve(c[[p, q]], c.T)
            gone = [p, q]
        left = np.setdiff1d(np.arange(len(a)), gone)
        a = a[np.ix_(left, left)]
        a = (a + a.T) / 2
    return int(positive)


def _between(lo: float, hi: float) -> float:
    return float(np.sqrt(lo * hi)) if lo > 0 and hi > 4 * lo else (lo + hi) / 2


def _clear(a: np.ndarray, shift: float, lo: float, hi: float) -> float:
    """A shift near ``shift`` with no eigenvalue beside it."""
    for k in range(12):
        s = shift + (-1) ** k * ((k + 1) // 2) * (hi - lo) / 40
        if lo < s < hi and above(a, s * (1 - 1e-9)) == above(a, s * (1 + 1e-9)):
            return s
    return shift


def intervals(a: np.ndarray, wanted: int) -> tuple[list[tuple[float, float, int]], int]:
    """``(low, high, eigenvalues inside)`` covering the ``wanted`` largest
    eigenvalues (all if fewer exceed rounding), and how many are wanted then."""
    trace = float(np.trace(a))
    if not trace > 0:
        return [], 0
    top = float(np.abs(a).sum(axis=1).max()) * (1 + 1e-6)
    floor = 8 * EPS * len(a) * trace
    wanted = min(wanted, above(a, floor))
    if not wanted:
        return [], 0
    lo, hi = floor, top
    while hi - lo > 1e-7 * hi and above(a, lo) > wanted:
        s = _clear(a, _between(lo, hi), lo, hi)
        if above(a, s) >= wanted:
            lo = s
        else:
            hi = s
    out, todo = [], [(lo, top)]
    while todo:
        lo, hi = todo.pop()
        inside = above(a, lo) - above(a, hi)
        if not inside:
            continue
        if (inside <= PER_INTERVAL and hi <= NARROW * lo) or hi - lo <= 1e-7 * hi:
            out.append((lo, hi, inside))
            continue
        s = _clear(a, _between(lo, hi), lo, hi)
        todo += [(lo, s), (s, hi)]
    return out, wanted


# ---------------------------------------------------------------------- FEAST
def feast(a: np.ndarray, lo: float, hi: float, inside: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in ``(lo, hi]`` and their vectors, which the inertia says are
    ``inside`` many.  A block of ``d`` vectors spans everything, so the widest
    block finds what close neighbours outside the interval hide from others."""
    d = len(a)
    scale = float(np.linalg.norm(a))
    rng = np.random.default_rng(seed)
    block = rng.standard_normal((d, min(d, inside + max(4, inside // 2))))
    node, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (1 + node))
    middle, radius = (lo + hi) / 2, (hi - lo) / 2
    last, spent = np.inf, 0
    while spent < ROUNDS or block.shape[1] < d:
        if spent == ROUNDS:
            block = np.hstack([block, rng.standard_normal((d, min(d, 2 * block.shape[1]) - block.shape[1]))])
            last, spent = np.inf, 0
        spent += 1
        filtered = np.zeros_like(block)
        for e, w in zip(turn, weight):
            solved = np.linalg.solve((middle + radius * e) * np.eye(d) - a, block.astype(complex))
            filtered += 0.5 * w * (radius * e * solved).real
        basis, size, _ = np.linalg.svd(filtered, full_matrices=False)
        basis = basis[:, size > size[0] * 1e-14]
        value, turned = np.linalg.eigh(basis.T @ a @ basis)
        vector = basis @ turned
        residual = np.linalg.norm(a @ vector - vector * value, axis=0)
        found = (value > lo) & (value <= hi) & (residual <= 1e-9 * scale)
        if found.sum() == inside:
            worst = float(residual[found].max())
            if worst <= 4 * EPS * scale or (worst >= last / 2 and worst <= 1e-12 * scale):
                return value[found], vector[:, found]
            last = worst
        block = vector
    raise ArithmeticError(f"{inside} eigenvalues lie between {lo} and {hi}, {int(found.sum())} were found")


def _solve(batches: Iterator[pa.RecordBatch], a: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            value, vector = feast(a, r["lo"], r["hi"], r["inside"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(value, pa.float64()), pa.array(list(vector.T), pa.list_(pa.float64()))],
                names=["value", "vector"])


def components(spark: SparkSession, cov: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their vectors as columns.  Vectors
    that come from different intervals are made orthogonal by one more
    Rayleigh-Ritz step over all of them."""
    parts, wanted = intervals(cov, wanted)
    if not wanted:
        return np.zeros(0), np.zeros((len(cov), 0))
    rows = spark.createDataFrame(parts, "lo double, hi double, inside int").repartition(len(parts)) \
        .mapInArrow(lambda it: _solve(it, cov), "value double, vector array<double>").collect()
    if len(rows) != sum(p[2] for p in parts):
        raise ArithmeticError("eigenvalues are missing")
    rows.sort(key=lambda r: r["value"])
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in rows]).T)
    value, turned = np.linalg.eigh(basis.T @ cov @ basis)
    order = np.argsort(-value, kind="stable")[:wanted]
    return value[order], (basis @ turned)[:, order]


# -------------------------------------------------------------------- whitening
def _deviation(y: np.ndarray, m: Moments) -> pa.Array:
    """The sum of ``(n * x - S) ** 2`` of each row."""
    largest = m.n * (int(np.abs(y).max()) if y.size else 0) + max(abs(r) for r in m.rest)
    if largest ** 2 * y.shape[1] < 1 << 63:
        t = m.n * y - np.array(m.rest, np.int64)
        return pa.array((t * t).sum(axis=1), pa.int64())
    t = m.n * y.astype(object) - np.array(m.rest, object)
    return pa.array([int(v) if v < 1 << 63 else None for v in (t * t).sum(axis=1)], pa.int64())


def _whitened(batches: Iterator[pa.RecordBatch], m: Moments, w: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not len(b):
            continue
        y = _matrix(b) - m.mid
        z = (y - m.offset) @ w
        lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, w.shape[1], dtype=np.int32), z.ravel())
        yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("_v")), _deviation(y, m), lists],
                                         names=["vec_id", "deviation", "z"])


def _second_moments(batches: Iterator[pa.RecordBatch], m: Moments, w: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of the whitened entries and of their products."""
    total = np.zeros((w.shape[1] + 1,) * 2)
    for b in batches:
        z = (_matrix(b) - m.mid - m.offset) @ w
        one = np.column_stack([np.ones(len(z)), z])
        total += one.T @ one
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                      pa.array(total.ravel())], names=["i", "j", "s"])


def identity_error(fit: DataFrame, m: Moments, w: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the
    identity, measured over the list."""
    sums = fit.mapInArrow(lambda it: _second_moments(it, m, w), "i int, j int, s double") \
        .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((w.shape[1] + 1,) * 2)
    for r in sums:
        total[r["i"], r["j"]] = r["s"]
    mean = total[0, 1:] / m.n
    return float(np.abs(total[1:, 1:] / m.n - np.outer(mean, mean) - np.eye(w.shape[1])).max())


def _listed(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = 16) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    of every usable row and component."""
    spark = vectors.sparkSession
    grid = grid_vectors(vectors, id_col, vector_col)
    none = spark.createDataFrame([], RESULT)
    d = _commonest_length(grid)
    if not d:
        return none
    grid = grid.filter(F.size("_x") == d)
    fit = written(grid.select("_x").distinct(), "fit-list")
    m = moments(fit)
    value, vector = components(spark, m.cov, wanted)
    if not len(value):
        return none
    w = vector / np.sqrt(value)
    error = identity_error(fit, m, w)
    explained = value / np.trace(m.cov)
    rows = grid.mapInArrow(lambda it: _whitened(it, m, w), "vec_id long, deviation long, z array<double>")
    return rows.select("vec_id", F.lit(m.n).cast("long").alias("n"), "deviation", F.posexplode("z").alias("p", "whitened")) \
        .select("vec_id", (F.col("p") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                F.get(_listed(explained), F.col("p")).alias("explained"), F.lit(error).alias("identity_error"))
