"""Cluster operators: nearest centre, cost, majority labelling, dictionary join.

Centres are model parameters (k rows).  They are brought to the driver once,
behind an explicit bound, and travel with the plan as a literal, exactly as
a fitted k-means model's centres do.  Every data row is then scored where it
lies; no cross join of rows with centres is formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from connscore.functions.vectors import nearest_center_struct

MAX_CENTERS = 10_000
# a cluster dictionary has at most one row per cluster; below this bound it
# is broadcast to the scored rows
BROADCAST_DICT_ROWS = 1_000_000


def class_exemplars(df: DataFrame, label_col: str, features_col: str,
                    id_col: str) -> DataFrame:
    """(cid, center): per label, the features of its lowest-id row."""
    return (df.groupBy(F.col(label_col).alias("cid"))
            .agg(F.min_by(F.col(features_col), F.col(id_col)).alias("center")))


def collect_centers(centers: DataFrame, id_col: str = "cid", center_col: str = "center",
                    max_centers: int = MAX_CENTERS) -> tuple[list[int], list[list[float]]]:
    """Bring centres to the driver, refusing more than ``max_centers``."""
    rows = centers.orderBy(id_col).limit(max_centers + 1).collect()
    if len(rows) > max_centers:
        raise ValueError(f"more than {max_centers} centres; not a centre table")
    if not rows:
        raise ValueError("the centre table is empty")
    ids = [int(r[id_col]) for r in rows]
    vecs = [[float(v) for v in (r[center_col].toArray() if hasattr(r[center_col], "toArray")
                                else r[center_col])] for r in rows]
    return ids, vecs


def model_centers(kmeans_model) -> tuple[list[int], list[list[float]]]:
    centers = kmeans_model.clusterCenters()
    return list(range(len(centers))), [[float(v) for v in c] for c in centers]


def _arrow_ok(df: DataFrame) -> bool:
    return not any(isinstance(f.dataType, VectorUDT) for f in df.schema.fields)


def _nearest_batches(features_col: str, center_ids: Sequence[int],
                     centers: Sequence[Sequence[float]], prediction_col: str,
                     distance_col: str):
    """Per Arrow batch: squared distances to every centre, accumulated one
    dimension at a time in index order (the same arithmetic, in the same
    order, as the expression form), then the first minimum (centres are in
    ascending id order, so ties go to the smaller id).  Rows are processed
    in chunks so that chunk x k stays bounded for large k."""
    import numpy as np

    cent = np.asarray(centers, dtype=np.float64)
    cid = np.asarray(center_ids, dtype=np.int32)
    chunk = max(1, 2_000_000 // max(1, len(cent)))

    def run(batches):
        for pdf in batches:
            n = len(pdf)
            pred = np.zeros(n, dtype=np.int32)
            dist = np.zeros(n, dtype=np.float64)
            feats = pdf[features_col]
            valid = feats.notna().to_numpy()
            if valid.any():
                x = np.stack(feats[valid].to_numpy()).astype(np.float64)
                p_out = np.empty(len(x), dtype=np.int32)
                d_out = np.empty(len(x), dtype=np.float64)
                for s in range(0, len(x), chunk):
                    xs = x[s:s + chunk]
                    acc = np.zeros((len(xs), len(cent)))
                    for j in range(cent.shape[1]):
                        diff = xs[:, j:j + 1] - cent[None, :, j]
                        acc = acc + diff * diff
                    b = acc.argmin(axis=1)
                    p_out[s:s + len(xs)] = cid[b]
                    d_out[s:s + len(xs)] = acc[np.arange(len(xs)), b]
                pred[valid] = p_out
                dist[valid] = d_out
            out = pdf.assign(**{prediction_col: pred, distance_col: dist})
            if not valid.all():
                out[prediction_col] = out[prediction_col].astype("Int32").where(valid)
                out[distance_col] = out[distance_col].where(valid)
            yield out

    return run


def assign_nearest(df: DataFrame, features_col: str, center_ids: Sequence[int],
                   centers: Sequence[Sequence[float]], prediction_col: str = "prediction",
                   distance_col: str = "distance", method: str = "auto") -> DataFrame:
    """Nearest centre per row (ties -> smaller id) and its squared distance.

    ``features_col`` may be an array column or an ML vector column.

    ``method="arrow"`` scores Arrow batches with a vectorised numpy kernel
    (``mapInPandas``: row-wise, no shuffle); ``method="expr"`` uses built-in
    higher-order functions.  Both give bit-identical results; the Arrow path
    measured ~6x faster (100k x 64-dim rows, 10 centres), so ``auto`` takes it
    whenever every column can travel through Arrow.
    """
    if method not in ("auto", "arrow", "expr"):
        raise ValueError(f"unknown method {method!r}")
    feats_col = features_col
    if isinstance(df.schema[features_col].dataType, VectorUDT):
        df = df.withColumn("__feats", vector_to_array(F.col(features_col)))
        feats_col = "__feats"
    use_arrow = method == "arrow" or (method == "auto" and _arrow_ok(df))
    if use_arrow:
        schema = (T.StructType(list(df.schema.fields))
                  .add(prediction_col, T.IntegerType(), True)
                  .add(distance_col, T.DoubleType(), True))
        out = df.mapInPandas(_nearest_batches(feats_col, center_ids, centers,
                                              prediction_col, distance_col), schema)
    else:
        best = nearest_center_struct(F.col(feats_col), centers, center_ids)
        out = (df.withColumn("__nearest", best)
                 .withColumn(prediction_col, F.col("__nearest.cid"))
                 .withColumn(distance_col, F.col("__nearest.distance"))
                 .drop("__nearest"))
    return out.drop("__feats") if feats_col == "__feats" else out


def _two_nearest_batches(features_col: str, center_ids: Sequence[int], centers: Sequence[Sequence[float]]):
    """Per Arrow batch: nearest centre (ties to the smaller id), squared distance to it and to the next centre."""
    import numpy as np

    cent = np.asarray(centers, dtype=np.float64)
    cid = np.asarray(center_ids, dtype=np.int32)
    chunk = max(1, 2_000_000 // max(1, len(cent)))

    def run(batches):
        for pdf in batches:
            feats = pdf[features_col]
            valid = feats.notna().to_numpy()
            pred, near, far = (np.zeros(len(pdf), t) for t in (np.int32, np.float64, np.float64))
            if valid.any():
                x = np.stack(feats[valid].to_numpy()).astype(np.float64)
                found = []
                for s in range(0, len(x), chunk):
                    acc = np.zeros((len(x[s:s + chunk]), len(cent)))
                    for j in range(cent.shape[1]):
                        diff = x[s:s + chunk, j:j + 1] - cent[None, :, j]
                        acc = acc + diff * diff
                    b, rows = acc.argmin(axis=1), np.arange(len(acc))
                    least = acc[rows, b]
                    acc[rows, b] = np.inf
                    found.append((cid[b], least, acc.min(axis=1)))
                pred[valid], near[valid], far[valid] = (np.concatenate(c) for c in zip(*found))
            out = pdf.assign(prediction=pred, distance=near, next_distance=far)
            if not valid.all():
                out["prediction"] = out["prediction"].astype("Int32").where(valid)
                out["distance"], out["next_distance"] = out["distance"].where(valid), out["next_distance"].where(valid)
            yield out

    return run


def assign_two_nearest(df: DataFrame, features_col: str, center_ids: Sequence[int],
                       centers: Sequence[Sequence[float]]) -> DataFrame:
    """``df`` with prediction, distance and next_distance (squared, to the second nearest centre; infinite if k is 1)."""
    schema = (T.StructType(list(df.schema.fields)).add("prediction", T.IntegerType(), True)
              .add("distance", T.DoubleType(), True).add("next_distance", T.DoubleType(), True))
    return df.mapInPandas(_two_nearest_batches(features_col, center_ids, centers), schema)


def cluster_quality(assigned: DataFrame) -> DataFrame:
    """(cost, silhouette) of rows with distance and next_distance, in one aggregate.

    The simplified silhouette of a row is (b - a) / b for its distances a and b
    to the nearest and the next centre: 1 on a centre, 0 half way, and without
    the pairwise distances of rows.  One centre has no silhouette, which is
    given as 0; a row on two centres at once counts 0.
    """
    a, b = F.sqrt("distance"), F.sqrt("next_distance")
    inside = (F.when(F.col("next_distance") == 0, F.lit(0.0))
              .when(F.col("next_distance") == float("inf"), F.lit(0.0)).otherwise((b - a) / b))
    return assigned.agg(F.coalesce(F.sum("distance"), F.lit(0.0)).alias("cost"),
                        F.avg(F.when(F.col("distance").isNotNull(), inside)).alias("silhouette"))


def clustering_cost(assigned: DataFrame, distance_col: str = "distance") -> DataFrame:
    """Sum of squared distances to the nearest centre (one row)."""
    return assigned.agg(F.sum(distance_col).alias("cost"))


def cluster_label_counts(assigned: DataFrame, cluster_col: str = "prediction",
                         label_col: str = "label") -> DataFrame:
    return (assigned.groupBy(F.col(cluster_col).alias("prediction"),
                             F.col(label_col).alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))


def cluster_majority(assigned: DataFrame, cluster_col: str = "prediction",
                     label_col: str = "label") -> DataFrame:
    """(prediction, label): each cluster's most frequent label.

    Equal counts go to the larger label (max over struct(count, label)).
    The first aggregate combines map-side, so a cluster holding a third of
    the rows reaches the shuffle as one partial row per partition; the
    second aggregate sees at most clusters x labels rows.
    """
    return majority_of_counts(cluster_label_counts(assigned, cluster_col, label_col))


def majority_of_counts(counts: DataFrame) -> DataFrame:
    """(prediction, label): the label with most rows per cluster; ``counts`` has prediction, label, n."""
    return (counts.groupBy("prediction")
            .agg(F.max(F.struct("n", "label")).alias("best"))
            .select("prediction", F.col("best.label").alias("label")))


def keep_label_counts(assigned: DataFrame, path: str, batch: str, cluster_col: str = "prediction",
                      label_col: str = "label") -> str:
    """Keep the (cluster, label) counts of one batch of scored rows in the counts table at ``path``.

    A batch has a folder of its own, so keeping it again after a failure
    replaces it, and the rows of earlier batches are never scored again.
    """
    if not batch or not all(c.isalnum() or c in "-_." for c in batch):
        raise ValueError("a batch name consists of letters, digits, '-', '_' and '.'")
    cluster_label_counts(assigned, cluster_col, label_col).write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return path


def kept_label_counts(spark: SparkSession, path: str, label_type: str = "double") -> DataFrame:
    """(prediction, label, n) over all batches kept at ``path``."""
    kept = spark.read.schema(f"prediction int, label {label_type}, n long").parquet(path)
    return kept.groupBy("prediction", "label").agg(F.sum("n").alias("n"))


def _dictionary_side(dictionary: DataFrame, max_rows: int | None) -> DataFrame:
    if max_rows is not None and max_rows <= BROADCAST_DICT_ROWS:
        return F.broadcast(dictionary)
    return dictionary


def join_cluster_labels(scored: DataFrame, dictionary: DataFrame,
                        actual_col: str = "label", cluster_col: str = "prediction",
                        keep: Sequence[str] = (), how: str = "inner",
                        max_dictionary_rows: int | None = None) -> DataFrame:
    """Scored rows x dictionary on cluster id -> (keep..., actual_label, label).

    ``max_dictionary_rows`` is the known bound on dictionary size (the number
    of clusters); only with such a bound is the dictionary broadcast.  With
    ``how="left"`` every row stays, and ``__covered`` says whether its cluster has an entry.
    """
    s = scored.select(*keep, F.col(actual_col).alias("actual_label"),
                      F.col(cluster_col).alias("__cid"))
    d = dictionary.select(F.col("prediction").alias("__cid"), F.col("label").alias("label"))
    if how == "left":   # which rows found an entry, beside those whose entry has a null label
        d = d.withColumn("__found", F.lit(True))
    joined = s.join(_dictionary_side(d, max_dictionary_rows), "__cid", how).drop("__cid")
    if how == "left":
        return joined.withColumn("__covered", F.coalesce("__found", F.lit(False))).drop("__found")
    return joined


def uncovered_rows(scored: DataFrame, dictionary: DataFrame,
                   cluster_col: str = "prediction",
                   max_dictionary_rows: int | None = None) -> DataFrame:
    """Scored rows whose cluster has no dictionary entry (lost by inner join)."""
    d = _dictionary_side(dictionary.select(F.col("prediction").alias(cluster_col)),
                         max_dictionary_rows)
    return scored.join(d, cluster_col, "left_anti")


def cluster_coverage(dictionary: DataFrame) -> DataFrame:
    """(label, n_clusters): how many clusters carry each label."""
    return dictionary.groupBy("label").agg(F.count(F.lit(1)).alias("n_clusters"))


def cluster_sizes(assigned: DataFrame, cluster_col: str = "prediction") -> DataFrame:
    return (assigned.groupBy(F.col(cluster_col).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("size")))
