"""Whitening of vectors along principal components found by spectral divide-and-conquer.

Entries become whole numbers, so counts, sums and products over the fit list
(each distinct vector once) are exact whole numbers, the same for every
partitioning.  Tasks sum their rows, a second round of tasks sums the sums; one
d x d matrix comes to the driver.

There the symmetric covariance is split: the polar factor of ``V - shift I``
(dynamically weighted Halley iteration, by QR and Cholesky) is the sign of the
matrix, half of it plus the identity projects on the eigenvalues above the shift, bases of
that subspace and its complement give two smaller matrices, and so on down to
single components; parts below the wanted ones are left.  The components, at
most ``COMPONENTS`` vectors of d numbers, go with the plan to all rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connscore.llm import common as C

#: Components that are given back.
COMPONENTS = 16

#: x = floor(SCALE * c) + OFFSET
SCALE, OFFSET = 64, 1_000_000

#: Tasks of the second round of summing; so many parts come to the driver.
PARTS = 32

_EPS = np.finfo(float).eps
_EDGE = float(1 << 61)
_LOW = 40    # bits of the lower half of a wide sum


# ---- exact sums ---------------------------------------------------------------------

class Wide:
    """A sum of 64-bit whole-number arrays that does not overflow: high * 2**40 + low."""

    def __init__(self, high: np.ndarray | int = 0, low: np.ndarray | int = 0):
        self.high, self.low = high, low

    def add(self, other: "Wide") -> "Wide":
        low = self.low + other.low
        return Wide(self.high + other.high + (low >> _LOW), low & ((1 << _LOW) - 1))

    def plus(self, block: np.ndarray) -> "Wide":
        low = block & ((1 << _LOW) - 1)
        return self.add(Wide(block >> _LOW, low.astype(np.int64)))    # Python numbers stay so in the upper half

    def whole(self) -> np.ndarray:
        return np.asarray(self.high).astype(object) * (1 << _LOW) + np.asarray(self.low).astype(object)


def _gram(y: np.ndarray) -> np.ndarray:
    """Exact y.T @ y of whole numbers."""
    top = int(np.abs(y).max(initial=0))
    rows = (1 << 53) // max(top * top, 1)
    if rows << 9 < len(y):
        big = y.astype(object)
        return big.T @ big
    out = np.zeros((y.shape[1], y.shape[1]), np.int64)
    for k in range(0, len(y), rows):     # at most 2**9 exact blocks, so the sum fits too
        part = y[k:k + rows].astype(float)
        out += (part.T @ part).astype(np.int64)
    return out


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, vectors) of a column of packed 64-bit numbers."""
    values = column.to_pylist()
    lengths = np.array([len(v) // 8 for v in values])
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield int(d), at, np.frombuffer(b"".join(values[i] for i in at), "<i8").reshape(len(at), d)


def _summed(table: DataFrame, part_of: Callable, add: Callable) -> dict:
    """{length: sum over all rows of ``table``}; ``part_of(length, vectors)`` summed by ``add``, in two rounds of tasks."""
    schema = "length int, part binary"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for d, _, x in _by_length(batch.column(0)):
                new = part_of(d, x)
                sums[d] = add(sums[d], new) if d in sums else new
        yield _packed(sums)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for d, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                new = pickle.loads(part)
                sums[d] = add(sums[d], new) if d in sums else new
        yield _packed(sums)

    parts = table.mapInArrow(first, schema).withColumn("to", F.spark_partition_id() % PARTS)
    sums: dict = {}
    for row in parts.repartition(PARTS, "to").select("length", "part").mapInArrow(second, schema).collect():
        new = pickle.loads(row.part)
        sums[row.length] = add(sums[row.length], new) if row.length in sums else new
    return sums


def _packed(sums: dict) -> pa.RecordBatch:
    return pa.record_batch({"length": pa.array(list(sums), pa.int32()),
                            "part": pa.array([pickle.dumps(v) for v in sums.values()], pa.binary())})


# ---- eigenvectors on the driver -------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a square matrix by the QR-based dynamically weighted Halley iteration."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    low, eye = _EPS, np.eye(n)      # a bound below every singular value that is told from zero
    for _ in range(30):
        square = low * low
        root = np.cbrt(4 * (1 - square) / square ** 2)
        step = np.sqrt(1 + root)
        p = step + 0.5 * np.sqrt(max(8 - 4 * root + 8 * (2 - square) / (square * step), 0.0))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            basis = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))[0]
            new = q / r * x + (p - q / r) / np.sqrt(r) * (basis[:n] @ basis[n:].T)
        else:
            factor = np.linalg.cholesky(eye + r * (x.T @ x))
            half = np.linalg.solve(factor, x.T)
            new = q / r * x + (p - q / r) * np.linalg.solve(factor.T, half).T
        low = min(low * (p + q * square) / (1 + r * square), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if low > 1 - 10 * _EPS and moved < np.cbrt(_EPS) * n:
            break
        low = min(low, 1 - _EPS)
    return x


def _parted(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces of eigenvalues above and below some shift; None if all are equal."""
    n = len(a)
    spread = np.linalg.norm(a - np.trace(a) / n * np.eye(n))
    if spread <= n * _EPS * scale:
        return None
    rng = np.random.default_rng(n)
    best = None
    for attempt in range(12):
        middle = np.median(np.diag(a)) if attempt == 0 else np.trace(a) / n + spread / np.sqrt(n) * rng.uniform(-0.9, 0.9)
        sign = polar_factor(a - middle * np.eye(n))
        projector = (np.eye(n) + (sign + sign.T) / 2) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        start = projector @ rng.standard_normal((n, k))
        for _ in range(2):
            whole = np.linalg.qr(start, mode="complete")[0]
            start = projector @ whole[:, :k]
        whole = np.linalg.qr(start, mode="complete")[0]
        upper, lower = whole[:, :k], whole[:, k:]
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 4 * n * _EPS * scale:      # else the shift was too near an eigenvalue
            break
    return best[1:] if best else None


def leading_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    Equal eigenvalues give any orthonormal vectors of their subspace.  The
    largest entry of a vector is positive.
    """
    scale = np.linalg.norm(v)
    found: list[tuple[float, np.ndarray]] = []
    work = [(v, np.eye(len(v)))]
    while work and len(found) < wanted:
        a, basis = work.pop()
        a = (a + a.T) / 2
        parts = _parted(a, scale) if len(a) > 1 else None
        if parts is None:
            found.extend((a[i, i], basis[:, i]) for i in range(len(a)))
            continue
        upper, lower = parts
        work.append((lower.T @ a @ lower, basis @ lower))
        work.append((upper.T @ a @ upper, basis @ upper))    # taken first
    found = sorted(found, key=lambda x: -x[0])[:wanted]
    vectors = np.stack([x / np.linalg.norm(x) for _, x in found], axis=1) if found else np.empty((len(v), 0))
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    vectors = vectors * signs
    return np.einsum("ij,ij->j", vectors, v @ vectors), vectors


# ---- rows -----------------------------------------------------------------------------

def _whole_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, vector) to (vec_id, x as packed 64-bit numbers), without bad vectors."""
    for batch in batches:
        vectors = batch.column(1)
        lengths = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten()      # of the rows that are not null
        present = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
        lengths = lengths[present]
        values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)    # null as nan
        first = np.concatenate(([0], np.cumsum(lengths)))
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
        good = bad[first[1:]] == bad[first[:-1]]
        with np.errstate(invalid="ignore", over="ignore"):
            x = np.floor(SCALE * values)
            x = np.where(np.isfinite(x), np.clip(x, -_EDGE, _EDGE), np.sign(x) * _EDGE)
        x = np.nan_to_num(x).astype("<i8") + OFFSET
        yield pa.record_batch({
            "vec_id": batch.column(0).take(pa.array(present[good])),
            "x": pa.array([x[a:b].tobytes() for a, b in zip(first[:-1][good], first[1:][good])], pa.binary())})


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S, exact; Python numbers where 64 bits do not hold them."""
    top = int(np.abs(x).max(initial=0))
    if (n + 1) * max(top, 1) < 1 << 61 and max(map(abs, total), default=0) < 1 << 61:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def _deviation(centred: np.ndarray) -> list[int | None]:
    top = int(np.abs(centred).max(initial=0))
    if top * top * max(centred.shape[1], 1) < 1 << 63:
        return np.einsum("ij,ij->i", centred, centred).tolist()
    sums = [sum(int(c) ** 2 for c in row) for row in centred]
    return [s if s < 1 << 63 else None for s in sums]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Null vectors and those with null or non-finite entries are dropped.
    Vectors of one length are whitened among themselves, so each length has
    its own fit list.  Components without variance (e at most d times the
    rounding unit of the largest) are left out, so equal vectors alone, empty
    vectors and an empty table give no rows.  x is held at 2**61 in size, a deviation
    beyond a long is null.  Equal rows come as often as they are there; a null
    vec_id stays null.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding")).mapInArrow(
        _whole_numbers, "vec_id long, x binary")
    fit = C.written(rows.select("x").filter(F.length("x") > 0).distinct(), "fit-list")

    # n and S
    totals = _summed(fit, lambda d, x: (len(x), Wide().plus(x.sum(axis=0) if _small(x) else x.astype(object).sum(axis=0))),
                     lambda a, b: (a[0] + b[0], a[1].add(b[1])))
    totals = {d: (n, [int(v) for v in s.whole()]) for d, (n, s) in totals.items()}
    centre = {d: [(2 * s + n) // (2 * n) for s in total] for d, (n, total) in totals.items()}

    # products of rows centred at the nearest whole numbers; the exact rest is taken off below
    def products(d: int, x: np.ndarray) -> Wide:
        return Wide().plus(_gram(x - np.array(centre[d], np.int64)))

    models = {}
    for d, gram in _summed(fit, products, Wide.add).items():
        n, total = totals[d]
        rest = np.array([s - n * c for s, c in zip(total, centre[d], strict=True)], object)
        v = ((n * gram.whole() - np.outer(rest, rest)) / (n * n)).astype(float)
        e, q = leading_components(v, components)
        used = e > d * _EPS * max(e.max(initial=0.0), 0.0)
        models[d] = (n, total, q[:, used] / np.sqrt(e[used]), e[used] / np.trace(v) if used.any() else e[used])

    def moments(d: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, total, q, _ = models[d]
        w = (_centred(x, n, total).astype(float) / n) @ q
        return w.sum(axis=0), w.T @ w

    error = 0.0
    for d, (first, second) in _summed(fit, moments, lambda a, b: (a[0] + b[0], a[1] + b[1])).items():
        n, k = models[d][0], len(first)
        if k:
            error = max(error, float(np.abs(second / n - np.outer(first / n, first / n) - np.eye(k)).max()))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, x in _by_length(batch.column(1)):
                if d not in models or not (k := models[d][2].shape[1]):
                    continue
                n, total, q, explained = models[d]
                centred = _centred(x, n, total)
                each = np.repeat(np.arange(len(at)), k)
                size = len(each)
                yield pa.record_batch({
                    "vec_id": batch.column(0).take(pa.array(at[each])),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    "n": pa.array(np.full(size, n, np.int64)),
                    "deviation": pa.array(_deviation(centred), pa.int64()).take(pa.array(each)),
                    "whitened": pa.array(((centred.astype(float) / n) @ q).ravel()),
                    "explained": pa.array(np.tile(explained, len(at))),
                    "identity_error": pa.array(np.full(size, error))})

    return rows.mapInArrow(project, "vec_id long, component int, n long, deviation long, whitened double, "
                                    "explained double, identity_error double")


def _small(x: np.ndarray) -> bool:
    return int(np.abs(x).max(initial=0)) * len(x) < 1 << 62
