"""Embedding whitening by Jacobi-Davidson on a covariance that is never formed.

Vectors become integers, floor(scale * x) + offset, packed into blocks.  Counts
and sums are exact.  The covariance is used only through products with a few
vectors: every task centres its blocks, multiplies, and the tasks' partial sums
are added in groups before a bounded number of them reaches the driver.  There
a search space is kept: Rayleigh-Ritz gives the best pairs in it, pairs whose
residual has come down to rounding are locked, and for the next few pairs the
correction equations, projected against what is locked and against the pairs
themselves, are solved by a few MINRES steps (one product a step, for all pairs
of the round) and extend the space.  A full space is cut down to its best pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Values in a packed block; pairs corrected a round; MINRES steps a round; rounds before giving up.
CELLS, WIDTH, STEPS, ROUNDS = 1 << 18, 8, 6, 400
#: Residuals count as rounding below this share of the largest eigenvalue, eigenvalues as zero below ZERO of it.
TOL, ZERO = 1e-13, 1e-11
LARGEST = 1 << 50  # integers beyond saturate
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def clean(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x array<double>): rows whose vector is not null and holds finite numbers only."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("x"))
    return rows.where(F.col("x").isNotNull() & (F.size("x") > 0)
                      & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))


def pack(rows: DataFrame, dim: int, scale: int, offset: int, cells: int) -> DataFrame:
    """(ids array<long>, ints binary, wide boolean): blocks of at most ``cells`` integers, 4 bytes each where they fit, else 8."""
    most = max(1, cells // dim)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, most):
                part = b.slice(at, most)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False)
                x = np.clip(np.floor(x * scale), -LARGEST, LARGEST).astype(np.int64) + offset
                wide = bool(np.abs(x).max() >= 2**31)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([x.astype("<i8" if wide else "<i4").tobytes()], pa.binary()), pa.array([wide])], ["ids", "ints", "wide"])

    return rows.select("id", "x").mapInArrow(run, "ids array<long>, ints binary, wide boolean")


def _blocks(batch: pa.RecordBatch, dim: int):
    """The integer matrices of a batch of packed blocks."""
    for ints, wide in zip(batch.column("ints"), batch.column("wide")):
        yield np.frombuffer(ints.as_py(), "<i8" if wide.as_py() else "<i4").reshape(-1, dim).astype(np.int64)


class Centred:
    """x - S/n with full precision: whole numbers up to the rounded mean, the rest of it as one fraction."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.groups = n, 1
        self.middle = [round_half(s, n) for s in sums]
        self.rest = [s - n * m for s, m in zip(sums, self.middle)]  # n * (mean - middle), exact
        self.middle_array = np.array(self.middle, np.int64)
        self.fraction = np.array([r / n for r in self.rest])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.middle_array).astype(np.float64) - self.fraction

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum over dimensions of (n x - S)^2, exact; null where it is no long."""
        near = x - self.middle_array
        top = int(np.abs(near).max()) * self.n + max(map(abs, self.rest))
        if top * top * x.shape[1] < 2**63:
            far = near * self.n - np.array(self.rest, np.int64)
            return (far * far).sum(axis=1).tolist()
        far = near.astype(object) * self.n - np.array(self.rest, object)
        return [d if d < 2**63 else None for d in (far * far).sum(axis=1).tolist()]


def round_half(a: int, b: int) -> int:
    return (2 * a + b) // (2 * b)


def totals(blocks: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of each dimension."""
    def run(batches):
        n, sums = 0, [0] * dim
        for b in batches:
            for x in _blocks(b, dim):
                n += len(x)
                sums = [s + int(v) for s, v in zip(sums, x.sum(axis=0, dtype=object if np.abs(x).max() > 2**40 else np.int64))]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), pa.array([Decimal(v) for v in (n, *sums)], pa.decimal128(38, 0))], ["j", "s"])

    rows = blocks.mapInArrow(run, "j int, s decimal(38,0)").groupBy("j").agg(F.sum("s").alias("s")).collect()
    found = {r.j: int(r.s) for r in rows}
    return found[-1], [found[j] for j in range(dim)]


def summed(blocks: DataFrame, dim: int, centred: Centred, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``of(centred block)`` over all blocks: per task, then per group of about sqrt(tasks) tasks, then on the driver."""
    def run(batches):
        total, seen = np.zeros(shape), False
        for b in batches:
            for x in _blocks(b, dim):
                total, seen = total + of(centred(x)), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def add(batches):
        total = np.zeros(shape)
        for b in batches:
            for part in b.column(0):
                total = total + np.frombuffer(part.as_py()).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = blocks.mapInArrow(run, "part binary").repartition(centred.groups).mapInArrow(add, "part binary").collect()
    return sum((np.frombuffer(r.part).reshape(shape) for r in parts), np.zeros(shape))


# ---- on the driver: dim x few arrays --------------------------------------------------

def minres(product: Callable[[np.ndarray], np.ndarray], project: Callable[[np.ndarray], np.ndarray], theta: np.ndarray,
           right: np.ndarray, steps: int, least: float) -> np.ndarray:
    """MINRES for project((A - theta_i) t_i) = right_i, one column a pair; all columns share the products with A.

    Lanczos vectors with Givens rotations, as many steps as given or until every
    column's residual has shrunk to ``least`` of its start.
    """
    beta = np.linalg.norm(right, axis=0)
    start = np.maximum(beta, np.finfo(float).tiny)
    old, now = np.zeros_like(right), right / start
    solution, w_old, w_now = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c_old, s_old, c_now, s_now = np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta), np.zeros_like(beta)
    rest, beta = start.copy(), np.zeros_like(beta)
    for _ in range(steps):
        image = project(product(now)) - theta * now
        alpha = (image * now).sum(axis=0)
        image = project(image - alpha * now - beta * old)
        beta_next = np.linalg.norm(image, axis=0)
        # the new column of the tridiagonal matrix: rotated by the last two rotations, then by its own
        third, second, first = s_old * beta, c_old * c_now * beta + s_now * alpha, c_now * alpha - c_old * s_now * beta
        length = np.maximum(np.hypot(first, beta_next), np.finfo(float).tiny)
        c, s = first / length, beta_next / length
        w = (now - third * w_old - second * w_now) / length
        solution += w * (c * rest)
        rest = -s * rest
        if (np.abs(rest) <= least * start).all():
            break
        old, now = now, image / np.maximum(beta_next, np.finfo(float).tiny)
        w_old, w_now, beta = w_now, w, beta_next
        c_old, s_old, c_now, s_now = c_now, s_now, c, s
    return solution


def outside(basis: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Columns of ``v`` without their parts in the orthonormal ``basis`` (twice, against rounding)."""
    v = v - basis @ (basis.T @ v)
    return v - basis @ (basis.T @ v)


def fresh(basis: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Orthonormal columns of the part of ``v`` outside ``basis``; dependent ones are left out."""
    v = v / np.maximum(np.linalg.norm(v, axis=0), np.finfo(float).tiny)
    left, size, _ = np.linalg.svd(outside(basis, v), full_matrices=False)
    return np.linalg.qr(outside(basis, left[:, size > 1e-10]))[0]


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, want: int, width: int = WIDTH,
                    steps: int = STEPS, tol: float = TOL, rounds: int = ROUNDS, seed: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``want`` largest eigenvalues, falling, their unit eigenvectors, and the number of rounds.

    ``product`` applies a symmetric matrix to the columns of an array.  Raises
    where residuals do not come down to ``tol`` within ``rounds``.
    """
    rng = np.random.default_rng(seed)
    most = min(dim, want + 4 * width)
    locked, values = np.zeros((dim, 0)), []
    space = fresh(locked, rng.standard_normal((dim, min(dim, 2 * width))))
    image = product(space)
    scale = 0.0
    for turn in range(1, rounds + 1):
        h = space.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        space, image = space @ y, image @ y
        scale = max(scale, float(theta[0]), 0.0)
        residual = outside(locked, image - space * theta)
        size = np.linalg.norm(residual, axis=0)
        # lock from the top only, so that no larger pair is passed over
        open_from = next((i for i in range(len(theta)) if size[i] > tol * scale), len(theta))
        whole = locked.shape[1] + space.shape[1] == dim
        done = open_from if whole else min(open_from, max(0, len(theta) - width))  # a guard of pairs not yet locked
        done = min(done, want - len(values))
        locked, values = np.hstack([locked, space[:, :done]]), [*values, *theta[:done]]
        space, image, theta, residual, size = space[:, done:], image[:, done:], theta[done:], residual[:, done:], size[done:]
        if len(values) == want:
            return np.array(values), locked, turn
        if whole:  # nothing to add: products again, as the old ones carry the rounding of every turn
            space = fresh(locked, space)
            image = product(space)
            tol *= 1.5
            continue
        if space.shape[1] + locked.shape[1] + width > most and space.shape[1] > 2 * width and most < dim:
            keep = max(2 * width, want - len(values) + width)
            space, image, theta, residual, size = space[:, :keep], image[:, :keep], theta[:keep], residual[:, :keep], size[:keep]
        pick = [i for i in range(len(theta)) if size[i] > tol * scale][:width] or list(range(min(width, len(theta))))
        pairs = np.hstack([locked, space[:, pick]])
        correction = minres(product, lambda v: outside(pairs, v), theta[pick], outside(pairs, -residual[:, pick]), steps, 0.5 ** min(turn, 20))
        more = fresh(np.hstack([locked, space]), np.hstack([correction, residual[:, pick]]))[:, : 2 * width]
        if not more.shape[1]:
            more = fresh(np.hstack([locked, space]), rng.standard_normal((dim, width)))
        space, image = np.hstack([space, more]), np.hstack([image, product(more)])
    raise RuntimeError(f"{len(values)} of {want} pairs after {rounds} rounds, residuals {size[:width] / scale}")


# ---- on Spark ------------------------------------------------------------------------

def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET, cells: int = CELLS) -> DataFrame:
    """(vec_id, component from 1, n, deviation, whitened, explained, identity_error), a row per vector and component.

    Vectors that are null, empty or hold a null or non-finite entry take no
    part; so do vectors of another length than the most frequent one (ties: the
    longer).  A null id stays null.  Repeated rows count and are returned as
    often as they come.  Entries beyond a 50-bit whole number saturate.  There
    are at most ``components`` components, and none of zero variance; equal
    eigenvalues share a space in which the basis is any.  ``deviation`` is null
    where it is no long.  An empty table, or one of equal vectors, gives no rows.
    """
    spark = vectors.sparkSession
    rows = clean(vectors, id_col, vec_col)
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], _OUT)
    dim = common.dim
    blocks = materialize(pack(rows.where(F.size("x") == dim), dim, scale, offset, cells))
    n, sums = totals(blocks, dim)
    centred = Centred(n, sums)
    centred.groups = max(1, round(blocks.rdd.getNumPartitions() ** 0.5))

    variances = summed(blocks, dim, centred, lambda x: (x * x).sum(axis=0), (dim,)) / n
    trace = float(variances.sum())
    if trace == 0.0:
        return spark.createDataFrame([], _OUT)

    def product(v: np.ndarray) -> np.ndarray:
        return summed(blocks, dim, centred, lambda x: x.T @ (x @ v), v.shape) / n

    values, axes, _ = jacobi_davidson(product, dim, min(components, dim))
    use = values > ZERO * values[0]
    values, turn = values[use], axes[:, use] / np.sqrt(values[use])
    k = len(values)
    first = summed(blocks, dim, centred, lambda x: (x @ turn).sum(axis=0), (k,)) / n
    second = summed(blocks, dim, centred, lambda x: (x @ turn - first).T @ (x @ turn - first), (k, k)) / n
    error = float(np.abs(second - np.eye(k)).max())
    explained = values / trace

    def run(batches):
        for b in batches:
            for ids, x in zip(b.column("ids"), _blocks(b, dim)):
                m = len(x)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids.as_py(), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)), pa.array(centred.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array((centred(x) @ turn).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(run, _OUT)
