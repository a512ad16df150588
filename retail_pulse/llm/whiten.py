"""Embedding whitening by Jacobi-Davidson: the covariance is only ever multiplied with a few vectors, in passes over the data.

1. Vectors become integers; the distinct ones (the fit list) are packed into matrices in the shared folder. One pass gives their number and
   exact sums per dimension, so the mean is known before anything is multiplied.
2. A product of the covariance with a block of vectors is one Spark job: each task centres its rows and adds up ``x (x . b)``; the partial sums
   (dimension x block numbers) of more than 64 tasks meet in about the square root of that number before they reach the driver.
3. The leading eigenvectors come from Jacobi-Davidson on the driver's small matrices: Rayleigh-Ritz in the subspace searched so far; pairs whose residual
   has reached double precision are locked; for the others the projected correction equation ``(I - UU') (V - e I) (I - UU') t = -r`` is solved by a few
   MINRES steps, in lockstep, so that a step is one distributed product for all of them; the corrections extend the subspace, which restarts from its best
   Ritz vectors when it is full. Guard pairs behind the last component keep it from settling on a wrong one.
4. A last pass projects every row, and one over the fit list measures how far the whitened covariance is from the identity.

Defined cases: vectors that are NULL, empty, shorter than the longest, or that hold a NULL or non-finite component have no row; rows with a NULL id have theirs; repeated rows
come out as often as they came but count once in the fit. Components whose eigenvalue is not above rounding (fewer dimensions or
distinct vectors than components, constant tables) do not exist and have no rows, so one vector or an empty table gives an empty result. A deviation above the range of
a long is clipped to it. Equal eigenvalues leave their eigenvectors undetermined, as always.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.llm.common import written
from retail_pulse.llm.vectors import dimension, floors, matrix, slices, usable

_EPS = float(np.finfo(np.float64).eps)
_LONG = 2**63 - 1
#: partial sums that may reach the driver from one pass without meeting in tasks first
_AT_ONCE = 64


@dataclass
class Fit:
    """The fit list: packed blocks (n, kind, packed) in the shared folder, its size, exact sums, and mean."""

    blocks: DataFrame
    n: int
    sums: list[int]
    tasks: int

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _rows(batch: pa.RecordBatch, dim: int):
    """The packed blocks of a batch, each as a matrix."""
    for kind, packed in zip(batch.column(0), batch.column(1), strict=True):
        yield np.frombuffer(packed.as_py(), dtype=kind.as_py()).reshape(-1, dim)


def fit_list(vectors: DataFrame, dim: int, block: int = 4096) -> Fit:
    """Pack the distinct vectors ``v`` (longs) into blocks of the narrowest integer type that holds them."""
    def pack(batches):
        for b in slices(batches, block):
            x = matrix(b.column(0), dim)
            kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= x.min(initial=0) and x.max(initial=0) <= np.iinfo(k).max)
            yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([x.astype(kind).tobytes()], pa.binary())], names=["kind", "packed"])

    blocks = written(vectors.select("v").distinct().mapInArrow(pack, "kind string, packed binary"), "whiten-fit")

    def add_up(batches):
        n, low, high = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for b in batches:
            for x in _rows(b, dim):
                n += len(x)
                x = x.astype(np.int64)
                low += (x & 0xFFFFFFFF).sum(axis=0)  # halves, so that sums of any longs are exact
                high += (x >> 32).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(dim, n)), pa.array(np.arange(dim)), pa.array(low), pa.array(high)], names=["n", "d", "low", "high"])

    wide = "decimal(38,0)"
    rows = blocks.mapInArrow(add_up, "n long, d long, low long, high long").groupBy("d").agg(
        F.sum("n").alias("n"), F.sum(F.col("low").cast(wide)).alias("low"), F.sum(F.col("high").cast(wide)).alias("high")).collect()  # one row per dimension
    at = {r.d: r for r in rows}
    sums = [(int(at[d].high) << 32) + int(at[d].low) if d in at else 0 for d in range(dim)]
    return Fit(blocks, at[0].n if at else 0, sums, max(1, blocks.rdd.getNumPartitions()))


def _summed(partial: DataFrame, tasks: int, size: int) -> np.ndarray:
    """The sum of the arrays of ``size`` doubles in the binary column ``y``, one from each task.

    The driver adds at most ``_AT_ONCE`` arrays itself; more of them meet in tasks before.
    """
    def add(batches):
        total = np.zeros(size)
        for b in batches:
            for y in b.column(0):
                total += np.frombuffer(y.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["y"])

    met = partial if tasks <= _AT_ONCE else partial.repartition(isqrt(tasks)).mapInArrow(add, "y binary")
    return sum((np.frombuffer(r.y) for r in met.collect()), np.zeros(size))


def centred_product(fit: Fit, block: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the fit list times ``block`` (dimension x width): one pass, nothing of dimension x dimension."""
    mean, dim = fit.mean, fit.dim

    def run(batches):
        total = np.zeros(block.shape)
        for b in batches:
            for x in _rows(b, dim):
                c = x - mean
                total += c.T @ (c @ block)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["y"])

    return _summed(fit.blocks.mapInArrow(run, "y binary"), fit.tasks, block.size).reshape(block.shape) / fit.n


def trace(fit: Fit) -> float:
    """Sum of all eigenvalues: the mean squared distance to the mean."""
    mean, dim = fit.mean, fit.dim

    def run(batches):
        total = np.zeros(1)
        for b in batches:
            for x in _rows(b, dim):
                total += ((x - mean) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["y"])

    return float(_summed(fit.blocks.mapInArrow(run, "y binary"), fit.tasks, 1)[0]) / fit.n


def minres(product, b: np.ndarray, steps: int, goal: float) -> np.ndarray:
    """``steps`` MINRES steps for ``product(x) = b``, every column its own system, all columns in one product per step."""
    size = np.linalg.norm(b, axis=0)
    x, w, w_old, v_old = (np.zeros_like(b) for _ in range(4))
    v = np.divide(b, size, out=np.zeros_like(b), where=size > 0)
    left, beta = size.copy(), np.zeros_like(size)  # residual, last off-diagonal
    cos = cos_old = np.ones_like(size)
    sin = sin_old = np.zeros_like(size)
    live = size > 0
    for _ in range(steps):
        if not live.any():
            break
        p = product(v)
        alpha = np.einsum("ij,ij->j", v, p)
        p = p - alpha * v - beta * v_old
        following = np.linalg.norm(p, axis=0)
        # the new column of the tridiagonal matrix after the two last rotations
        above2, above1, diagonal = sin_old * beta, sin * alpha + cos_old * cos * beta, cos * alpha - cos_old * sin * beta
        pivot = np.hypot(diagonal, following)
        live = live & (pivot > 0)
        by = np.where(live, pivot, 1.0)
        cos_old, sin_old = cos, sin
        cos, sin = np.where(live, diagonal / by, 1.0), np.where(live, following / by, 0.0)
        w_old, w = w, (v - above2 * w_old - above1 * w) / by
        x = x + np.where(live, cos * left, 0.0) * w
        left = -sin * left
        tiny = np.finfo(np.float64).tiny
        v_old, v, beta = v, np.divide(p, following, out=np.zeros_like(p), where=following > tiny), following
        live = live & (np.abs(left) > goal * size) & (following > tiny)
    return x


@dataclass
class Components:
    """Leading eigenpairs: values, unit vectors as columns, relative residuals, and the number of distributed products."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int


def _extend(basis: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Orthonormal columns of ``new`` outside of ``basis``, as many as the space still holds."""
    for _ in range(2):
        new = new - basis @ (basis.T @ new)
        length = np.linalg.norm(new, axis=0)
        new = new[:, length > 0] / length[length > 0]
    q, r = np.linalg.qr(new)
    q = q[:, np.abs(np.diag(r)) > 1e-10]
    q = q - basis @ (basis.T @ q)
    return np.linalg.qr(q)[0][:, :basis.shape[0] - basis.shape[1]]


def jacobi_davidson(product, dim: int, k: int, guard: int = 2, inner: int = 3, largest_space: int | None = None, max_products: int = 2000, seed: int = 0) -> Components:
    """The ``k`` greatest eigenpairs of the symmetric operator ``product`` (dim x width -> dim x width).

    A pair is locked once its residual is at most 64 units of rounding of the greatest eigenvalue; the first guard pair only has to be near (1e-8). A run
    whose residuals stop falling above that (a limit set by the summation order) ends with what it has reached if that is below 1e-12; above it raises.
    """
    k = min(k, dim)
    m = min(dim, k + guard)
    space = min(dim, largest_space or max(40, 6 * m))
    calls = 0

    def times(block):
        nonlocal calls
        calls += 1
        return product(block)

    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, m)))[0]
    image = times(basis)
    least, stalled = np.inf, 0
    while True:
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        u, ritz = basis @ turn[:, :m], values[:m]
        residual = image @ turn[:, :m] - u * ritz
        size = np.linalg.norm(residual, axis=0) / max(abs(values[0]), np.finfo(np.float64).tiny)
        # every wanted pair to double precision, the first guard pair to 1e-8
        goal = np.where(np.arange(m) < k, 64 * _EPS, 1e-8)
        open_ = np.flatnonzero(size > goal)
        worst = float(size[:k].max())
        stalled = 0 if worst < 0.5 * least else stalled + 1
        least = min(least, worst)
        settled = stalled >= 8 and worst < 1e-12
        if values[0] <= 0 or settled or not np.any(open_ <= k) or (basis.shape[1] == dim and stalled >= 2):
            return Components(ritz[:k], u[:, :k], size[:k], calls)
        if calls >= max_products:
            raise RuntimeError(f"no convergence after {calls} products: residuals {size[:k].tolist()}")
        if basis.shape[1] + len(open_) > space and (space < dim or basis.shape[1] == dim):
            # thick restart: the best Ritz vectors, multiplied anew so that rounding does not pile up
            basis = np.linalg.qr(basis @ turn[:, :min(2 * m, basis.shape[1])])[0]
            image = times(basis)

        def projected(x, u=u):
            return x - u @ (u.T @ x)

        shift = ritz[open_]
        step = minres(lambda x, shift=shift, projected=projected: projected(times(projected(x)) - x * shift), -projected(residual[:, open_]), inner, 1e-4)
        new = _extend(basis, step)
        if not new.shape[1]:
            new = _extend(basis, np.random.default_rng(calls).standard_normal((dim, m)))
        if new.shape[1]:
            basis, image = np.hstack([basis, new]), np.hstack([image, times(new)])


def whiten(vectors: DataFrame, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(``id_col``, component, n, deviation, whitened, explained, identity_error) for each usable row and each of the ``k`` leading components."""
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    ready = written(vectors.filter(usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), floors(F.col(vector_col), scale).alias("v")), "whiten-vectors")
    dim = dimension(ready, "v")
    if dim is None:
        return vectors.sparkSession.createDataFrame([], schema)
    ready = ready.filter(F.size("v") == dim)
    fit = fit_list(ready, dim)
    total = trace(fit)
    found = jacobi_davidson(lambda block: centred_product(fit, block), dim, k)
    real = found.values > 1e-12 * total
    if total <= 0 or not real.any():
        return vectors.sparkSession.createDataFrame([], schema)
    n, sums, mean = fit.n, fit.sums, fit.mean
    scaled = found.vectors[:, real] / np.sqrt(found.values[real])
    explained = found.values[real] / total
    width = scaled.shape[1]

    def spread(batches):
        got = np.zeros((width, width))
        for b in batches:
            for x in _rows(b, dim):
                w = (x - mean) @ scaled
                got += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([got.tobytes()], pa.binary())], names=["y"])

    covariance = _summed(fit.blocks.mapInArrow(spread, "y binary"), fit.tasks, width * width).reshape(width, width) / n
    error = float(np.abs(covariance - np.eye(width)).max())

    def project(batches):
        s = np.array(sums, dtype=object)
        for b in slices(batches):
            x = matrix(b.column(1), dim)
            top = max(abs(int(x.max())), abs(int(x.min())))
            if dim * (n * top + max(map(abs, sums))) ** 2 < _LONG:
                deviation = ((n * x - s.astype(np.int64)) ** 2).sum(axis=1)
            else:
                deviation = np.minimum(((n * x.astype(object) - s) ** 2).sum(axis=1), _LONG).astype(np.int64)
            w = (x - mean) @ scaled
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.repeat(np.arange(len(x)), width))), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(x) * width, n)), pa.array(np.repeat(deviation, width)), pa.array(w.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * width, error))], names=schema.names)

    return ready.mapInArrow(project, schema)
