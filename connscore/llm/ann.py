"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are projected to ``DIMENSIONS`` Gaussian coordinates.  For a pair at
distance d the squared projected distance over d squared is chi-square with
that many degrees of freedom, so once the search has reached projected radius
r with a k-th neighbour at distance d, a nearer vector was missed with
probability at most 1 - chi2(r^2 / d^2): the search stops when that is under
``MISS``.

The top of the kd-tree is fit on a bounded sample and cuts the projected space
into leaves; every vector is indexed in its leaf.  A query searches its own
leaf first, then the leaves that its stopping test does not rule out.  Within
a block of a leaf a kd-tree of small cells is searched in the order of
projected distance, and the vectors met are verified on their original
coordinates.  Large leaves are split into blocks, and the queries that come to
a leaf into chunks, so a vector travels once for each ``CHUNK`` queries that
reach its own leaf and not at all where none does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from connscore.llm import common as C

#: Projected coordinates (even) and the probability to miss a neighbour at the stop.
DIMENSIONS, MISS = 12, 0.02

#: Rows the tree is fit on, rows of a block, of a cell, queries of a chunk.
SAMPLE, BLOCK, CELL, CHUNK = 8192, 8192, 64, 512

SEED = 71


def chi2(x: float, m: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def stop_ratio(miss: float = MISS, m: int = DIMENSIONS) -> float:
    """Squared projected radius over squared distance at which the search stops."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (low, mid) if chi2(mid, m) >= 1 - miss else (mid, high)
    return high


def projection(dimensions: int, m: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimensions, m))


def split_tree(points: np.ndarray, leaves: int) -> list[tuple]:
    """Cuts (first leaf, leaves, dimension, value) from the root down; each halves its points."""
    out, todo = [], [(0, leaves, points)]
    while todo:
        first, n, part = todo.pop()
        if n == 1:
            continue
        axis = int(np.argmax(np.ptp(part, axis=0))) if len(part) else 0
        value = float(np.median(part[:, axis])) if len(part) else 0.0
        out.append((first, n, axis, value))
        right = part[:, axis] > value
        todo += [(first, n // 2, part[~right]), (first + n // 2, n // 2, part[right])]
    return out


def leaf_of(cuts: list[tuple], points: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(points), np.int64)
    for first, n, axis, value in cuts:
        here = np.flatnonzero((leaf == first) & (points[:, axis] > value))
        leaf[here] = first + n // 2
    return leaf


def boxes(cuts: list[tuple], leaves: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.full((leaves, m), -np.inf), np.full((leaves, m), np.inf)
    for first, n, axis, value in cuts:
        mid = first + n // 2
        high[first:mid, axis] = np.minimum(high[first:mid, axis], value)
        low[mid:first + n, axis] = np.maximum(low[mid:first + n, axis], value)
    return low, high


def _box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for j in range(points.shape[1]):
        x = points[:, j, None]
        gap = np.maximum(np.maximum(low[None, :, j] - x, x - high[None, :, j]), 0)
        out += gap * gap
    return out


def _vectors(column, dimensions: int) -> np.ndarray:
    raw = b"".join(column)
    kind = "<f8" if len(raw) == 8 * dimensions * len(column) else "<f4"
    return np.frombuffer(raw, kind).reshape(-1, dimensions).astype(np.float64)


def dealt(index: DataFrame, probes: DataFrame, leaves: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``index`` and ``probes`` by the search task (leaf, block, chunk) that they meet in.

    A leaf has as many blocks as its rows need and as many chunks as its
    probes need; pairs of a leaf and a chunk that do not exist get no rows.
    """
    def of_leaf(table: DataFrame, rows: int):
        sizes = {r["leaf"]: r["n"] for r in table.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # a row a leaf
        parts = F.array(*[F.lit(math.ceil(sizes.get(i, 0) / rows)) for i in range(leaves)])
        return F.element_at(parts, (F.col("leaf") + 1).cast("int"))

    blocks, chunks = of_leaf(index, BLOCK), of_leaf(probes, CHUNK)
    both = index.filter(chunks > 0), probes.filter(blocks > 0)
    return (both[0].select("vec_id", "vec", "leaf", F.pmod(F.xxhash64("vec_id"), blocks).cast("int").alias("block"),
                           F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")),
            both[1].select("query_id", "vec", "bound", "leaf",
                           F.pmod(F.xxhash64("query_id"), chunks).cast("int").alias("chunk"),
                           F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")))


def _search(dimensions: int, k: int, ratio: float):
    """One block against one chunk of queries: the k nearest within what the test lets through."""
    matrix = projection(dimensions)

    def run(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        rows = rows.sort_values("vec_id", ignore_index=True)
        ids, vectors = rows["vec_id"].to_numpy(), _vectors(rows["vec"], dimensions)
        points = vectors @ matrix
        cells = 1 << max(0, math.ceil(math.log2(max(1, len(ids) / CELL))))
        cell = leaf_of(split_tree(points, cells), points)
        order = np.argsort(cell, kind="stable")
        starts = np.searchsorted(cell[order], np.arange(cells + 1))
        full = np.flatnonzero(np.diff(starts))
        low = np.array([points[order[starts[c]:starts[c + 1]]].min(axis=0) for c in full])
        high = np.array([points[order[starts[c]:starts[c + 1]]].max(axis=0) for c in full])
        asked, wanted = queries["query_id"].to_numpy(), _vectors(queries["vec"], dimensions)
        reach = _box_distance(wanted @ matrix, low, high)
        turn = np.argsort(reach, axis=1, kind="stable")
        bound = queries["bound"].to_numpy().astype(np.float64)
        dist = np.full((len(asked), k), np.inf)
        near = np.full((len(asked), k), -1, np.int64)
        active = np.arange(len(asked))
        for step in range(len(full)):
            c = turn[active, step]
            limit = np.minimum(dist[active, -1], bound[active])
            go = reach[active, c] <= ratio * limit * limit    # an infinite limit lets everything through
            active, c = active[go], c[go]
            if not len(active):
                break
            for which in np.unique(c):
                who = active[c == which]
                member = order[starts[full[which]]:starts[full[which] + 1]]
                for part in range(0, len(member), 1024):
                    m = member[part:part + 1024]
                    for lot in range(0, len(who), 64):
                        w = who[lot:lot + 64]
                        gap = wanted[w][:, None, :] - vectors[m][None, :, :]
                        d = np.sqrt((gap * gap).sum(axis=2))
                        all_d = np.concatenate((dist[w], d), axis=1)
                        all_i = np.concatenate((near[w], np.broadcast_to(ids[m], d.shape)), axis=1)
                        best = np.lexsort((all_i, all_d), axis=1)[:, :k]
                        dist[w] = np.take_along_axis(all_d, best, axis=1)
                        near[w] = np.take_along_axis(all_i, best, axis=1)
        found = np.isfinite(dist)
        who, _ = np.nonzero(found)
        return pd.DataFrame({"query_id": asked[who], "vec_id": near[found], "score": dist[found]})
    return run


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose vec_id ``every`` divides.

    ``vectors`` has vec_id and embedding.  Rows without id, null, empty or zero
    vectors and those with null or non-finite components take no part.
    Vectors of different lengths have no distance: each length is searched by
    itself.  score is the Euclidean distance of the vectors as they are, in double precision; ties go to
    the smaller vec_id.  Of equal vectors only the k + 1 smallest ids can be
    among k neighbours, so only those are indexed; all are queries.  An empty
    table gives an empty result.
    """
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    usable = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~odd
                            & F.exists("embedding", lambda x: x != 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    lengths = [r["d"] for r in usable.select(F.size("embedding").alias("d")).distinct().orderBy("d").collect()]
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for d in lengths:
        out = out.unionByName(_nearest(usable.filter(F.size("embedding") == d), d, kind, every, k))
    return out


def _nearest(usable: DataFrame, dimensions: int, kind: str, every: int, k: int) -> DataFrame:
    number = "<f4" if kind == "float" else "<f8"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(number)
            rows = flat.reshape(-1, dimensions) + np.dtype(number).type(0)   # -0 as 0
            yield pa.record_batch({"vec_id": batch.column(0),
                                   "vec": pa.array([r.tobytes() for r in rows], pa.binary())})

    rows = C.written(usable.mapInArrow(packed, "vec_id long, vec binary"), "vectors")
    first_ids = Window.partitionBy("vec").orderBy("vec_id")
    kept = rows.withColumn("nth", F.row_number().over(first_ids)).filter(F.col("nth") <= k + 1).drop("nth")
    sample = (rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").toArrow())
    matrix = projection(dimensions)
    points = _vectors(sample["vec"].to_pylist(), dimensions) @ matrix
    n = rows.count()
    leaves = 1 << max(0, min(math.ceil(math.log2(max(1, n / BLOCK))), int(math.log2(max(1, len(points) / 16)))))
    cuts = split_tree(points, leaves)

    def with_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = leaf_of(cuts, _vectors(batch.column(1).to_pylist(), dimensions) @ matrix)
            yield pa.record_batch({"vec_id": batch.column(0), "vec": batch.column(1), "leaf": pa.array(at)})

    index = C.written(kept.mapInArrow(with_leaf, "vec_id long, vec binary, leaf long"), "index")
    queries = C.written(rows.filter(F.col("vec_id") % every == 0)
                        .mapInArrow(with_leaf, "vec_id long, vec binary, leaf long")
                        .withColumnRenamed("vec_id", "query_id"), "queries")
    ratio = stop_ratio()
    search = _search(dimensions, k + 1, ratio)

    def searched(probes: DataFrame) -> DataFrame:
        left, right = dealt(index, probes, leaves)
        key = ["leaf", "block", "chunk"]
        return (left.groupBy(*key).cogroup(right.groupBy(*key))
                .applyInPandas(search, "query_id long, vec_id long, score double"))

    home = C.written(searched(queries.withColumn("bound", F.lit(float("inf")))), "home")
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    bound = (home.withColumn("nth", F.row_number().over(by_query)).filter(F.col("nth") == k + 1)
             .select("query_id", F.col("score").alias("bound")))
    low, high = boxes(cuts, leaves, DIMENSIONS)

    def other_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            reach = _box_distance(_vectors(batch.column(1).to_pylist(), dimensions) @ matrix, low, high)
            limit = batch.column(3).to_numpy(zero_copy_only=False)
            go = reach <= ratio * (limit * limit)[:, None]
            go[np.arange(len(go)), batch.column(2).to_numpy()] = False
            who, leaf = np.nonzero(go)
            at = pa.array(who)
            yield pa.record_batch({"query_id": batch.column(0).take(at), "vec": batch.column(1).take(at),
                                   "bound": batch.column(3).take(at), "leaf": pa.array(leaf)})

    probes = (queries.join(bound, "query_id", "left")
              .select("query_id", "vec", "leaf", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
              .mapInArrow(other_leaves, "query_id long, vec binary, bound double, leaf long"))
    found = home.unionByName(searched(C.written(probes, "probes"))).filter("vec_id <> query_id")
    return (found.withColumn("rank", F.row_number().over(by_query).cast("int")).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
