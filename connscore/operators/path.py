"""Elastic-net path of binary logistic regression: all penalties from the same passes.

A sweep that fits one model a penalty reads the rows some twenty times for
each.  Here the models of all penalties go on together: a pass gives every model its
weighted sums of products (d + 1 squared numbers a partition, summed in two
rounds of tasks), the driver solves the small penalised quadratic problems by
coordinate descent, each from where it stood, and the next pass follows.  A
model that no longer moves is left out of the next pass.

Minimised is the mean log loss plus penalty * (mix * |w|_1 + (1 - mix) / 2 *
|w|_2 squared) over standardised columns, the constant term free.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connscore.functions.vectors import linear_margin, sigmoid
from connscore.operators.prepare import Spread

#: The penalties of the published regularisation sweep.
PENALTIES = (0.0, 0.003, 0.01, 0.05, 0.1, 0.3, 1.0, 2.0)

#: Tasks of the second round of summing.
PARTS = 32


@dataclass(frozen=True)
class PathModel:
    """One penalty's model: weights and constant in standardised columns, and the columns' moments."""
    penalty: float
    columns: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float
    passes: int

    def margin(self):
        raw = [w / s if s else 0.0 for w, s in zip(self.weights, self.std)]
        constant = self.intercept - sum(w * m for w, m in zip(raw, self.mean))
        return linear_margin([F.col(f"`{c}`") for c in self.columns], raw, constant)


def _sums(table: DataFrame, part) -> np.ndarray:
    """Sum over all rows of the arrays that ``part`` makes of a batch's matrix (label first)."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            new = part(rows)
            total = new if total is None else total + new
        if total is not None:
            yield pa.record_batch({"part": pa.array([pickle.dumps(total)], pa.binary())})

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted((x for b in batches for x in b.column(0).to_pylist()))   # the same order every time
        if parts:
            yield pa.record_batch({"part": pa.array([pickle.dumps(sum(map(pickle.loads, parts)))], pa.binary())})

    parts = table.mapInArrow(first, "part binary").withColumn("to", F.spark_partition_id() % PARTS)
    got = parts.repartition(PARTS, "to").select("part").mapInArrow(second, "part binary").collect()
    return sum(pickle.loads(p) for p in sorted(bytes(r.part) for r in got))


def _newton(mean: np.ndarray, std: np.ndarray, models: np.ndarray):
    """Per model: gradient of the log loss and the weighted products of [1, standardised columns]."""
    def part(rows: np.ndarray) -> np.ndarray:
        x = np.column_stack([np.ones(len(rows)), np.where(std > 0, (rows[:, 1:] - mean) / np.where(std > 0, std, 1), 0)])
        out = np.zeros((len(models), x.shape[1], x.shape[1] + 1))
        for k, w in enumerate(models):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
            out[k, :, 0] = x.T @ (p - rows[:, 0])
            out[k, :, 1:] = (x * (p * (1 - p))[:, None]).T @ x
        return out
    return part


def _descend(gradient: np.ndarray, products: np.ndarray, start: np.ndarray, penalty: float, mix: float) -> np.ndarray:
    """Minimum of the quadratic model around ``start`` plus the penalty, by coordinate descent."""
    w, slope = start.copy(), gradient.copy()        # slope: of the quadratic model at w
    for _ in range(2000):
        moved = 0.0
        for j in range(len(w)):
            h = products[j, j]
            if h <= 0 and (j == 0 or not penalty):
                continue
            pull = h * w[j] - slope[j]
            if j:
                pull = np.sign(pull) * max(abs(pull) - penalty * mix, 0.0)
            new = pull / (h + (penalty * (1 - mix) if j else 0.0)) if pull else 0.0
            if new != w[j]:
                slope += products[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]))
                w[j] = new
        if moved < 1e-10:
            break
    return w


def fit_path(df: DataFrame, columns: Sequence[str], label_col: str = "label",
             penalties: Sequence[float] = PENALTIES, mix: float = 0.2, max_passes: int = 50,
             tolerance: float = 1e-7, start: dict[float, PathModel] | None = None,
             spread: Spread | None = None) -> list[PathModel]:
    """A model for each penalty, in the order given.

    Rows without a label or with a null column take no part.  ``start`` has
    models to begin from (an earlier path over fewer rows), by penalty.
    Without a penalty and with classes that a plane parts, weights have no
    minimum; they stop growing after ``max_passes``.
    """
    keys = [k for k in (spread.keys if spread else ()) if k not in columns and k != label_col]
    rows = df.select(F.col(label_col).cast("double").alias(label_col),
                     *[F.col(f"`{c}`").cast("double").alias(c) for c in columns], *keys).dropna(subset=[label_col, *columns])
    if spread:
        rows = spread.apply(rows)
    rows = rows.select(F.col(label_col), *[F.col(f"`{c}`") for c in columns]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = _sums(rows, lambda r: np.concatenate([[len(r)], r.sum(axis=0)]))
        if np.ndim(first) == 0:
            raise ValueError("no rows to fit")
        n, label_mean, mean = first[0], first[1] / first[0], first[2:] / first[0]
        std = np.sqrt(_sums(rows, lambda r: ((r[:, 1:] - mean) ** 2).sum(axis=0)) / max(n - 1, 1))
        models = np.zeros((len(penalties), len(columns) + 1))
        if 0 < label_mean < 1:
            models[:, 0] = np.log(label_mean / (1 - label_mean))
        for k, penalty in enumerate(penalties):
            if start and penalty in start:
                old = start[penalty]
                raw = np.array([w / s if s else 0.0 for w, s in zip(old.weights, old.std)])
                models[k, 1:] = raw * std
                models[k, 0] = old.intercept + raw @ (mean - np.array(old.mean))
        passes, going = np.zeros(len(penalties), int), list(range(len(penalties)))
        for _ in range(max_passes):
            if not going or not 0 < label_mean < 1:
                break
            sums = _sums(rows, _newton(mean, std, models[going])) / n
            still = []
            for k, s in zip(going, sums):
                new = _descend(s[:, 0], s[:, 1:], models[k], penalties[k], mix)
                step = new - models[k]
                size = np.abs(step).max()
                models[k] += step * min(1.0, 5.0 / size if size else 1.0)   # a far step is taken in parts
                passes[k] += 1
                if size > tolerance:
                    still.append(k)
            going = still
        return [PathModel(float(p), tuple(columns), tuple(map(float, mean)), tuple(map(float, std)),
                          tuple(map(float, m[1:])), float(m[0]), int(c))
                for p, m, c in zip(penalties, models, passes)]
    finally:
        rows.unpersist()


def score_path(df: DataFrame, model: PathModel, out_col: str = "score") -> DataFrame:
    """``df`` with the probability of class 1; null where a column is null."""
    return df.withColumn(out_col, sigmoid(model.margin()))


def path_table(spark: SparkSession, models: Sequence[PathModel]) -> DataFrame:
    """(penalty, norm, n_zero, passes): size of the standardised weights and how many are zero, a row a penalty."""
    return spark.createDataFrame(
        [(m.penalty, float(np.abs(m.weights).sum()), sum(w == 0 for w in m.weights), m.passes) for m in models],
        "penalty double, norm double, n_zero int, passes int")
