"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V of the distinct vectors is never built. A pass over them applies it to a block of columns: each task sums
X'(XQ) of its centred rows, and sums of tasks are added per dimension. A filter is a Chebyshev polynomial of V, a pass per
degree: it stays below one on the unwanted part of the spectrum and grows fast above it, so the block turns towards the leading
eigenvectors. QR and Rayleigh-Ritz then give their best estimates; cycles go on until the residuals |Vu - eu| certify them.
The driver holds blocks of (dimensions x columns) only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.vectors import integer_vectors, matrices
from faultline.session import written

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
GUARD = 32           # columns beyond the wanted ones
DEGREE = 10
LANCZOS_STEPS = 12
CYCLES = 60
CERTIFIED = 1e-12    # residuals against the largest eigenvalue; cycles go on to GOAL where rounding allows
GOAL = 1e-14
LIMIT = 1 << 40


@dataclass
class Moments:
    """Rows, exact sums and the trace of the covariance; a row is centred as (x - base) - rest, free of cancellation."""

    n: int
    sums: list[int]
    trace: float = 0.0

    def __post_init__(self):
        self.base = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest


@dataclass
class Whitening:
    """Leading eigenvalues and eigenvectors (columns) of the covariance; ``residual`` is relative to the largest one."""

    moments: Moments
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int
    identity_error: float = 0.0


def _summed(fit: DataFrame, dims: int, columns: int, of_rows, kind: str = "double") -> np.ndarray:
    """Sum over all rows of a (dims x columns) figure of each batch, added up within a task, then per dimension."""
    names = [f"q{j}" for j in range(columns)]

    def run(batches):
        total = 0
        for _, x in matrices(batches, dims):
            total = total + of_rows(x)
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), *[pa.array(np.ascontiguousarray(total[:, j])) for j in range(columns)]], names=["dim", *names])

    each = fit.select("x").mapInArrow(run, "dim int, " + ", ".join(f"{c} {kind}" for c in names))
    rows = each.groupBy("dim").agg(*[F.sum(c).alias(c) for c in names]).collect()
    out = np.zeros((dims, columns), np.float64 if kind == "double" else object)
    for r in rows:
        out[r["dim"]] = [r[c] for c in names]
    return out


def moments(fit: DataFrame, dims: int) -> Moments | None:
    both = _summed(fit, dims, 2, lambda x: np.column_stack([x.sum(0), np.full(dims, len(x))]), "bigint")
    if dims == 0 or both[0, 1] == 0:
        return None
    found = Moments(int(both[0, 1]), [int(s) for s in both[:, 0]])
    found.trace = float(_summed(fit, dims, 1, lambda x: (found.centred(x) ** 2).sum(0)[:, None]).sum() / found.n)
    return found


def _lowest(apply, dims: int, rng: np.random.Generator) -> float:
    """A lower bound of the spectrum: least Ritz value of a few Lanczos steps, less what is left over."""
    steps = min(LANCZOS_STEPS, dims)
    q, before, beta = rng.standard_normal(dims), np.zeros(dims), 0.0
    q /= np.linalg.norm(q)
    basis, a, b = [], [], []
    for _ in range(steps):
        basis.append(q)
        r = apply(q[:, None])[:, 0] - beta * before
        a.append(float(q @ r))
        r -= a[-1] * q
        for u in basis:
            r -= (u @ r) * u
        beta = float(np.linalg.norm(r))
        b.append(beta)
        if beta <= 1e-12 * abs(a[0]):
            break
        before, q = q, r / beta
    least = np.linalg.eigvalsh(np.diag(a) + np.diag(b[:-1], 1) + np.diag(b[:-1], -1))[0]
    return max(0.0, float(least) - b[-1])


def _filtered(apply, block: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """Scaled Chebyshev polynomial of V times the block: at most about one on [low, high], one at ``top``."""
    half, centre = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - centre)
    before, now = block, (apply(block) - centre * block) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - centre * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def leading(fit: DataFrame, dims: int, found: Moments, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, seed: int = 42) -> Whitening:
    """The leading eigenpairs, at most ``components``, of those eigenvalues that are above rounding."""
    passes = 0

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def of_rows(x):
            c = found.centred(x)
            return c.T @ (c @ q)

        return _summed(fit, dims, q.shape[1], of_rows) / found.n

    rng = np.random.default_rng(seed)
    wanted, columns = min(components, dims), min(dims, components + guard)
    block = np.linalg.qr(rng.standard_normal((dims, columns)))[0]
    low = _lowest(apply, dims, rng) if columns < dims else 0.0
    residual = np.inf
    for _ in range(CYCLES):
        image = apply(block)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = max(values[0], 0.0)
        before, residual = residual, float(np.linalg.norm(image[:, :wanted] - block[:, :wanted] * values[:wanted], axis=0).max() / top) if top else 0.0
        if residual <= GOAL or columns == dims or (residual <= CERTIFIED and residual > before / 4):
            break
        low = min(low, values[-1])
        high = max(values[-1], low + 1e-3 * top)
        block = np.linalg.qr(_filtered(apply, block, low, high, max(top, high * 1.0001), degree))[0]
    if residual > CERTIFIED:
        raise ArithmeticError(f"eigenvectors are not certified: residual {residual} after {CYCLES} cycles")
    fine = [i for i in range(wanted) if values[i] > 16 * dims * np.finfo(float).eps * top]
    result = Whitening(found, values[fine], block[:, fine], residual, passes)
    if fine:
        scaled = result.vectors / np.sqrt(result.values)
        result.identity_error = float(np.abs(scaled.T @ apply(scaled) - np.eye(len(fine))).max())
    return result


def _projected(model: Whitening, dims: int, kind: str, key: str):
    found, k = model.moments, len(model.values)
    scaled, explained = model.vectors / np.sqrt(model.values), model.values / found.trace
    sums = np.array(found.sums, object)

    def deviation(x: np.ndarray) -> list[int | None]:
        """Exact: in 64 bits where that is safe, else in Python's integers; NULL where a long cannot hold it."""
        most = max(abs(found.n * int(v) - s) for v, s in [*zip(x.max(0), found.sums), *zip(x.min(0), found.sums)])
        if most * most * dims < 1 << 62:
            return ((found.n * x - sums.astype(np.int64)) ** 2).sum(1).tolist()
        return [d if (d := sum((found.n * v - s) ** 2 for v, s in zip(row, found.sums))) < 1 << 63 else None for row in x.tolist()]

    def run(batches):
        for batch, x in matrices(batches, dims):
            for at in range(0, len(x), 2048):
                own = x[at:at + 2048]
                rows = np.repeat(np.arange(len(own)), k)
                yield pa.RecordBatch.from_arrays([
                    batch.column(key).slice(at, len(own)).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(own))),
                    pa.array(deviation(own), pa.int64()).take(pa.array(rows)), pa.array((found.centred(own) @ scaled).ravel()),
                    pa.array(np.tile(explained, len(own)))], names=[key, "component", "deviation", "whitened", "explained"])

    return run, f"`{key}` {kind}, component int, deviation bigint, whitened double, explained double"


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector with finite components and per
    leading component.

    Components are floor(scale * c) + OFFSET; the model is fitted on the distinct vectors, of which there are ``n``. Components
    without variance are left out, so a single distinct vector (or none) gives no rows. ``deviation`` is NULL where it
    exceeds 64 bits. Repeated rows give repeated rows; other columns are ignored.
    """
    kind = df.schema[key].dataType.simpleString()
    rows, dims = integer_vectors(df, vector, scale, LIMIT, [key])
    fit = written(rows.select("x").distinct(), "distinct")
    found = moments(fit, dims)  # of x - OFFSET, which the offset leaves as it is: n x - S, and every covariance
    model = leading(fit, dims, found, components) if found else None
    if model is None or not len(model.values):
        empty = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], empty)
    run, schema = _projected(model, dims, kind, key)
    return rows.mapInArrow(run, schema).withColumns({"n": F.lit(found.n).cast("bigint"), "identity_error": F.lit(model.identity_error)})
