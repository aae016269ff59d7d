"""k-means for several k in shared passes.

The vectors are packed once into blocks (a binary of doubles for the rows of a
batch that share a label).  Every pass reads the blocks once for all k:

* candidates -- k-means|| with one set of candidates for all k: a uniform draw,
  then rounds that draw by squared distance to the candidates so far, without
  replacement; each candidate weighs the rows nearest to it, and the starting
  centres of a k are the cheapest of several weighted k-means++ fits to them;
* iterations -- a task adds up the rows of each centre of every k; a k whose
  centres have stopped moves no further and is left out of the passes;
* facts -- rows, cost and silhouette per k, centre and label.

What comes to the driver are candidates, centres and their sums.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connscore.operators.prepare import persisted
from connscore.sources.scratch import scratch_table

#: Rows whose distances are computed at once, rounds of drawing by distance, k-means++ fits to the candidates.
CHUNK, DRAWS, TRIES = 1024, 2, 5


def vector_blocks(df: DataFrame, features_col: str, label_col: str | None = None) -> DataFrame:
    """(x binary, d, label): the rows of a batch with one label as doubles, row by row, each of ``d`` numbers."""
    label = F.col(label_col) if label_col else F.lit(None).cast("double")
    rows = df.select(vector_to_array(F.col(features_col)).alias("x"), label.alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            labels = batch.column(1).dictionary_encode(null_encoding="encode")
            which = labels.indices.to_numpy(zero_copy_only=False)
            parts = [x[which == i].tobytes() for i in range(len(labels.dictionary))]
            yield pa.record_batch({"x": pa.array(parts, pa.binary()), "d": pa.array([x.shape[1]] * len(parts), pa.int32()),
                                   "label": labels.dictionary})
    return rows.mapInArrow(run, rows.selectExpr("CAST(NULL AS BINARY) AS x", "CAST(NULL AS INT) AS d", "label").schema)


def _chunks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch.column(0):
            x = np.frombuffer(block.as_py()).reshape(-1, d)
            for low in range(0, len(x), CHUNK):
                yield x[low:low + CHUNK]


class _Space:
    """Arrays that a task uses again for every chunk: new ones would cost more than what is computed in them."""

    def __init__(self):
        self.held: dict[tuple[str, int], np.ndarray] = {}

    def array(self, name: str, rows: int, columns: int) -> np.ndarray:
        held = self.held.get((name, columns))
        if held is None or len(held) < rows:
            held = self.held[name, columns] = np.empty((rows, columns))
        return held[:rows]


def _distances(x: np.ndarray, centres: np.ndarray, space: _Space | None = None) -> np.ndarray:
    """Squared distances (rows, centres), a dimension at a time; good until ``space`` is used again."""
    space = space or _Space()
    out, diff = (space.array(name, len(x), len(centres)) for name in ("far", "diff"))
    out[...] = 0
    for j in range(x.shape[1]):
        np.subtract(x[:, j:j + 1], centres[None, :, j], out=diff)
        diff *= diff
        out += diff
    return out


def _nearest(x: np.ndarray, centres: np.ndarray, space: _Space) -> np.ndarray:
    """Nearest centre of each row by products; only sums of rows are taken from it."""
    one = space.array("one", len(x), x.shape[1] + 1)
    one[:, :-1], one[:, -1] = x, 1
    by = np.vstack([-2.0 * centres.T, (centres * centres).sum(axis=1)])
    return np.matmul(one, by, out=space.array("near", len(x), len(centres))).argmin(axis=1)


def _drawn(blocks: DataFrame, centres: np.ndarray, d: int, n: int, seed: int) -> np.ndarray:
    """``n`` rows drawn without replacement, by squared distance to the centres (uniformly without centres)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows, space = np.empty(0), np.empty((0, d)), _Space()
        for x in _chunks(batches, d):
            rng = np.random.default_rng([seed, zlib.crc32(x.tobytes())])
            weight = _distances(x, centres, space).min(axis=1) if len(centres) else np.ones(len(x))
            some = np.flatnonzero(weight > 0)
            key = rng.standard_exponential(len(x))[some] / weight[some]
            keys, rows = np.concatenate([keys, key]), np.concatenate([rows, x[some]])
            if len(keys) > n:
                least = np.argpartition(keys, n - 1)[:n]
                keys, rows = keys[least], rows[least]
        yield pa.record_batch({"key": pa.array(keys, pa.float64()),
                               "x": pa.array([r.tobytes() for r in rows], pa.binary())})
    found = blocks.select("x").mapInArrow(run, "key double, x binary").orderBy("key", "x").limit(n).collect()
    return np.array([np.frombuffer(r["x"]) for r in found]).reshape(-1, d)


def _sums(blocks: DataFrame, centres: Mapping[int, np.ndarray], d: int) -> dict[int, np.ndarray]:
    """Per k: for each centre the rows nearest to it and their sum, (centres, 1 + d)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, space = {k: np.zeros((len(c), 1 + d)) for k, c in centres.items()}, _Space()
        for x in _chunks(batches, d):
            for k, c in centres.items():
                near = _nearest(x, c, space)
                total[k][:, 0] += np.bincount(near, minlength=len(c))
                for j in range(d):
                    total[k][:, 1 + j] += np.bincount(near, x[:, j], len(c))
        yield pa.record_batch({"k": pa.array(list(total), pa.int32()),
                               "part": pa.array([t.tobytes() for t in total.values()], pa.binary())})

    def added(parts: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(part.as_py()) for part in parts.column("part"))
        return pa.table({"k": parts.column("k").slice(0, 1), "part": pa.array([whole.tobytes()], pa.binary())})

    found = (blocks.select("x").mapInArrow(run, "k int, part binary")
             .groupBy("k").applyInArrow(added, "k int, part binary").collect())
    return {r["k"]: np.frombuffer(r["part"]).reshape(-1, 1 + d) for r in found}


def _start(points: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """The cheapest of several weighted k-means++ fits to the candidates."""
    best, least = points[:k], np.inf
    if len(points) <= k:
        return points
    for attempt in range(TRIES):
        rng = np.random.default_rng([seed, k, attempt])
        centres = points[[rng.choice(len(points), p=weight / weight.sum())]]
        near = _distances(points, centres)[:, 0]
        while len(centres) < k and (near * weight).sum() > 0:
            more = points[[rng.choice(len(points), p=near * weight / (near * weight).sum())]]
            centres, near = np.concatenate([centres, more]), np.minimum(near, _distances(points, more)[:, 0])
        for _ in range(30):
            which = _distances(points, centres).argmin(axis=1)
            n = np.bincount(which, weight, len(centres))
            sums = np.stack([np.bincount(which, weight * x, len(centres)) for x in points.T], axis=1)
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1e-300)[:, None], centres)
            if np.array_equal(moved, centres):
                break
            centres = moved
        cost = (_distances(points, centres).min(axis=1) * weight).sum()
        if cost < least:
            best, least = centres, cost
    return best


def fitted_centres(blocks: DataFrame, d: int, ks: Iterable[int], seed: int = 1, max_iter: int = 20,
                   tol: float = 1e-4) -> dict[int, np.ndarray]:
    """Centres of each k (fewer where there are fewer distinct vectors), of vectors of ``d`` numbers.

    ``blocks`` is read in every pass; a cached or written table.
    """
    ks = sorted(set(ks))
    points = _drawn(blocks, np.empty((0, d)), d, 2 * max(ks), seed)
    if not len(points):
        raise ValueError("no vectors to cluster")
    points = np.unique(points, axis=0)
    for i in range(DRAWS):
        points = np.unique(np.concatenate([points, _drawn(blocks, points, d, 2 * max(ks), seed + 1 + i)]), axis=0)
    weight = _sums(blocks, {0: points}, d)[0][:, 0]
    centres = {k: _start(points, weight, k, seed) for k in ks}
    going = dict(centres)
    for _ in range(max_iter):
        for k, sums in _sums(blocks, going, d).items():
            old, n = centres[k], sums[:, :1]
            centres[k] = np.where(n > 0, sums[:, 1:] / np.maximum(n, 1), old)
            going[k] = centres[k]
            if (((centres[k] - old) ** 2).sum(axis=1) <= tol * tol).all():
                del going[k]
        if not going:
            break
    return centres


def model_of(spark: SparkSession, estimator: KMeans, centres: np.ndarray) -> KMeansModel:
    """A k-means model with these centres: ``estimator`` started from them all, without an iteration."""
    rows = spark.createDataFrame([(Vectors.dense(c),) for c in centres.tolist()], [estimator.getFeaturesCol()])
    as_given = estimator.copy({estimator.initMode: "random", estimator.maxIter: 0})
    return as_given.fit(rows)


def cluster_facts(blocks: DataFrame, centres: Mapping[int, np.ndarray], d: int) -> DataFrame:
    """(k, prediction, label, n, cost, inside): rows per centre and label, their squared distances and silhouettes.

    The silhouette is the simplified one of ``clusters.cluster_quality``; ties go to the smaller centre.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = _Space()
        for batch in batches:
            out = []
            for i, block in enumerate(batch.column(0)):
                x = np.frombuffer(block.as_py()).reshape(-1, d)
                for k, c in centres.items():
                    n, cost, inside = (np.zeros(len(c)) for _ in range(3))
                    for low in range(0, len(x), CHUNK):
                        far = _distances(x[low:low + CHUNK], c, space)
                        rows, near = np.arange(len(far)), far.argmin(axis=1)
                        a = far[rows, near]
                        far[rows, near] = np.inf
                        b = far.min(axis=1)
                        apart = (b > 0) & np.isfinite(b)
                        share = np.zeros(len(a))
                        share[apart] = 1 - np.sqrt(a[apart]) / np.sqrt(b[apart])
                        n += np.bincount(near, minlength=len(c))
                        cost += np.bincount(near, a, len(c))
                        inside += np.bincount(near, share, len(c))
                    at = np.flatnonzero(n)
                    out.append((np.full(len(at), k), at, np.full(len(at), i), n[at], cost[at], inside[at]))
            if out:
                ks, near, which, n, cost, inside = map(np.concatenate, zip(*out, strict=True))
                yield pa.record_batch({
                    "k": pa.array(ks, pa.int32()), "prediction": pa.array(near, pa.int32()),
                    "label": batch.column(2).take(pa.array(which)), "n": pa.array(n.astype(np.int64)),
                    "cost": pa.array(cost), "inside": pa.array(inside)})

    schema = blocks.selectExpr("0 AS k", "0 AS prediction", "label", "0L AS n", "0D AS cost", "0D AS inside").schema
    return (blocks.mapInArrow(run, schema).groupBy("k", "prediction", "label")
            .agg(*[F.sum(c).alias(c) for c in ("n", "cost", "inside")]))


def kmeans_models(spark: SparkSession, vectors: DataFrame, estimators: Mapping[int, KMeans],
                  label_col: str | None = None) -> tuple[dict[int, KMeansModel], DataFrame]:
    """The model of each k and the (written) ``cluster_facts`` of their clusters.

    ``estimators`` differ in k alone; seed, iterations, tolerance and features column are theirs.
    """
    est = next(iter(estimators.values()))
    with persisted(vector_blocks(vectors, est.getFeaturesCol(), label_col)) as blocks:
        d = blocks.agg(F.max("d")).first()[0] or 1
        centres = fitted_centres(blocks, d, estimators, est.getSeed(), est.getMaxIter(), est.getTol())
        models = {k: model_of(spark, estimators[k], centres[k]) for k in estimators}
        placed = {k: np.array(m.clusterCenters()) for k, m in models.items()}
        return models, scratch_table(cluster_facts(blocks, placed, d), "cluster-facts")
