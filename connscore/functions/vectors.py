"""Vector arithmetic as built-in expressions over array<double> columns.

Used to score models given by literal parameters (weights, centres, rules)
without a Python UDF and without joining data to a parameter table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c: str | Column) -> Column:
    """Cast an array (e.g. array<float>) to array<double> before arithmetic."""
    return _col(c).cast("array<double>")


def linear_margin(features: Sequence[str | Column], weights: Sequence[float],
                  intercept: float = 0.0) -> Column:
    """w . x + b over scalar feature columns, summed in feature order."""
    if len(features) != len(weights):
        raise ValueError("features and weights differ in length")
    total = F.lit(float(intercept))
    terms = [_col(f).cast("double") * F.lit(float(w)) for f, w in zip(features, weights)]
    acc = terms[0]
    for t in terms[1:]:
        acc = acc + t
    return acc + total


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def squared_distance(x: Column, center: Column) -> Column:
    """Sum over i of (x[i] - c[i])^2, accumulated in index order."""
    diffs = F.zip_with(x, center, lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


def nearest_center_struct(features: str | Column, centers: Sequence[Sequence[float]],
                          center_ids: Sequence[int] | None = None) -> Column:
    """struct<distance: double, cid: int> of the nearest centre.

    Ties on distance go to the smaller centre id (struct ordering).  The
    centres travel with the plan as a literal, like a fitted model's centres
    do, so each row is scored where it lies: no shuffle, no cross join.
    """
    ids = list(center_ids) if center_ids is not None else list(range(len(centers)))
    x = as_double_array(features)
    cands = [F.struct(squared_distance(x, F.array(*[F.lit(float(v)) for v in c])).alias("distance"),
                      F.lit(int(i)).alias("cid"))
             for c, i in zip(centers, ids)]
    return F.array_min(F.array(*cands))


def argmax_index(values: Sequence[Column]) -> Column:
    """Index of the largest value; ties go to the smaller index."""
    cands = [F.struct(v.cast("double").alias("v"), F.lit(-i).alias("neg_idx"))
             for i, v in enumerate(values)]
    best = F.array_max(F.array(*cands))
    return (-best["neg_idx"]).cast("double")
