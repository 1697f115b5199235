"""Whitening of embeddings: the leading eigenvectors of the covariance by Chebyshev-filtered subspace iteration.

Vectors x of integers are centred before they are multiplied; V = sum (x - m)(x - m)' / n.
V is never made.  A *pass* over all rows gives V Q for a block Q of a few
vectors: each task sums (x - m)((x - m)'Q) over its rows, and the sums meet in a
tree.  In each round

1. a Rayleigh-Ritz step turns the block, of ``components`` and ``GUARD`` more
   vectors, into approximate eigenvectors with their values;
2. the Chebyshev polynomial of degree m on [0, b], where b is the block's least
   value, is applied by its three-term recurrence, a pass a degree: it stays
   below 1 on the unwanted spectrum and grows steeply above;
3. QR makes the block orthonormal again.

The result is certified, not assumed: every wanted pair must have a residual
|V u - e u| of rounding size relative to the largest eigenvalue, which then no
longer shrinks from round to round, and ``identity_error`` is measured on the
whitened rows.  Of equal eigenvalues any basis of their space is taken.

The mean is kept as exact integers (sums S, count n).  Rows go as in
``integer_vectors``.  Directions without variance have a null ``whitened`` and take no part in ``identity_error``;
``deviation`` is null where no long holds it.  Repeated rows and ids each count; an
empty table gives no row.  A vector of d components has min(8, d) of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.vectors import integer_vectors, matrix, tree_sum
from leafmill.session import ship_package, through_table

GUARD = 32  # vectors of the block beside the wanted ones
DEGREE = 12  # of a round's polynomial at most
SPREAD = 1e10  # how much more the largest value may grow than the least in a round
ROUNDING = 64 * np.finfo(float).eps
ROUNDS = 200
HALF = np.int64(1 << 26)
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """n and S of the fit list, the trace of its covariance, and eigenpairs in falling order."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float  # the largest, relative to the largest eigenvalue
    passes: int

    @property
    def flat(self) -> np.ndarray:
        """Components without variance."""
        return self.values <= len(self.sums) * ROUNDING * max(self.values[0], 0) if len(self.values) else np.zeros(0, bool)


def _moments(batches: Iterator[pa.RecordBatch]) -> bytes | None:
    """Exact count and sums: high and low halves are added apart, so that no sum overflows."""
    total = None
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch)
            own = np.stack([(x // HALF).sum(axis=0), (x % HALF).sum(axis=0), np.full(x.shape[1], len(x))])
            total = own if total is None else total + own
    return None if total is None else total.astype("<i8").tobytes()


def _add(kind: str):
    return lambda a, b: (np.frombuffer(a, kind) + np.frombuffer(b, kind)).tobytes()


class Centre:
    """x - S/n: the whole part is taken off as integers, the rest as a fraction."""

    def __init__(self, n: int, sums: tuple[int, ...]):
        self.n, self.whole = n, np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.fraction = np.array([r / n for r in self.rest])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.fraction

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exact; null beyond a long."""
        y = x - self.whole
        bound = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if bound * bound * y.shape[1] < 1 << 63:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        found = ((self.n * y.astype(object) - np.array(self.rest, object)) ** 2).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in found]


def _product(centre: Centre, block: np.ndarray):
    def partial(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = centre(matrix(batch))
                own = y.T @ (y @ block)
                total = own if total is None else total + own
        return None if total is None else total.astype("<f8").tobytes()

    return partial


def _spread(centre: Centre):
    def partial(batches: Iterator[pa.RecordBatch]) -> bytes:
        return np.array([sum(float((centre(matrix(b)) ** 2).sum()) for b in batches if b.num_rows)], "<f8").tobytes()

    return partial


def _degree(top: float, least: float) -> int:
    """The largest degree at which the top of the spectrum does not outgrow the rest beyond doubles."""
    if least <= 0:
        return 1
    growth = np.arccosh(max(2 * top / least - 1, 1))
    return int(np.clip(np.log(2 * SPREAD) / growth if growth else DEGREE, 1, DEGREE))


def fit(rows: DataFrame, components: int = 8, guard: int = GUARD, seed: int = 13) -> Fit | None:
    """Eigenpairs of the covariance of ``x``; None without rows."""
    moments = tree_sum(rows, _moments, _add("<i8"))
    if moments is None:
        return None
    high, low, counts = np.frombuffer(moments, "<i8").reshape(3, -1)
    n, sums = int(counts[0]), tuple(int(a) * int(HALF) + int(b) for a, b in zip(high, low))
    centre, d = Centre(n, sums), len(sums)
    trace = float(np.frombuffer(tree_sum(rows, _spread(centre), _add("<f8")), "<f8")[0]) / n
    wanted, guard = min(components, d), max(guard, 1)  # without one the filter has nothing to keep the least apart from
    passes = 0

    def product(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return np.frombuffer(tree_sum(rows, _product(centre, block), _add("<f8")), "<f8").reshape(block.shape) / n

    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, min(d, wanted + guard))))[0]
    before = np.inf
    for _ in range(ROUNDS):
        image = product(block)
        inner = block.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        scale = max(values[0], np.finfo(float).tiny)
        residual = float(np.linalg.norm(image - block * values, axis=0)[:wanted].max() / scale)
        if block.shape[1] == d or residual <= ROUNDING and residual > before / 2:
            break
        before = residual
        half = max(values[-1], 0) / 2
        if half == 0:  # the rest has no variance: an image is filtered already
            block = np.linalg.qr(image + block * scale * np.finfo(float).eps)[0]
            continue
        old, new = block, (image - half * block) / half
        for _ in range(_degree(values[0], values[-1]) - 1):
            old, new = new, 2 * (product(new) - half * new) / half - old
        block = np.linalg.qr(new)[0]
    else:
        raise ArithmeticError(f"no certified eigenvectors after {ROUNDS} rounds: relative residual {residual:.1e}")
    vectors = block[:, :wanted]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)] < 0, -1, 1)
    return Fit(n, sums, trace, np.maximum(values[:wanted], 0), vectors, residual, passes)


def _whitened(found: Fit, centre: Centre, x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return centre(x) @ np.where(found.flat, 0, found.vectors / np.sqrt(found.values))


def _covariance(found: Fit, centre: Centre):
    def partial(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        total = None
        for batch in batches:
            if batch.num_rows:
                w = _whitened(found, centre, matrix(batch))
                own = np.concatenate([w.T @ w, w.sum(axis=0, keepdims=True)])
                total = own if total is None else total + own
        return None if total is None else total.astype("<f8").tobytes()

    return partial


def identity_error(rows: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(found.values)
    data = np.frombuffer(tree_sum(rows, _covariance(found, Centre(found.n, found.sums)), _add("<f8")), "<f8").reshape(k + 1, k)
    mean = data[k] / found.n
    error = data[:k] / found.n - np.outer(mean, mean) - np.eye(k)
    used = ~found.flat
    return float(np.abs(error[np.ix_(used, used)]).max(initial=0))


def project(rows: DataFrame, found: Fit, error: float) -> DataFrame:
    """A row for each vector and component."""
    k = len(found.values)
    explained = found.values / found.trace if found.trace > 0 else np.zeros(k)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = Centre(found.n, found.sums)
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = matrix(batch)
            white = _whitened(found, centre, x)
            yield pa.record_batch([
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, found.n)),
                pa.array([v for v in centre.deviations(x) for _ in range(k)], pa.int64()),
                pa.array(white.ravel(), mask=np.tile(found.flat, m)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(make, RESULT)


def whiten(df: DataFrame, vec_id: Column, vector: Column, components: int = 8, scale: int = 1024, shift: int = 100000) -> DataFrame:
    """``RESULT`` for each row with a vector and each of its leading components."""
    ship_package(df.sparkSession)
    rows = through_table(integer_vectors(df, vector, scale, shift, vec_id=vec_id.cast("long")), "vectors")
    found = fit(rows, components)
    if found is None:
        return df.sparkSession.createDataFrame([], RESULT)
    return project(rows, found, identity_error(rows, found))
