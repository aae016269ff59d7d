"""Fitted models on targets that can be learned, so SQL can tell what they must give.

Targets are rules on ``l_quantity`` (whole numbers 1 to 50).  A tree deep
enough must find the rule exactly, one too shallow misses a known set of rows.
For logistic regression and k-means the queries give what holds for any right
solver.  Models are fitted on lines of even orders and scored on odd ones.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from connscore.operators import clusters as C
from connscore.operators import features as FE
from connscore.operators import metrics as M
from connscore.operators import models as MD
from connscore.operators.prepare import spread_by_rows
from connscore.operators.sweeps import sweep_fits
from connscore.plans import jobs
from connscore.plans.roles import L_KEYS, L_ROLES, embeddings, lineitem
from connscore.session import scratch_path

HALF, LOW, HIGH, INNER = 25, 15, 35, 10
DEPTHS, KS = [1, 2, 3], [2, 5, 20]

_HALF_ROLES = replace(L_ROLES, label="target", normal_token="low", classes=("low", "high"))
_BAND_ROLES = replace(L_ROLES, label="target", normal_token="low", classes=("low", "mid", "high"))
_HALVES = f"CASE WHEN l_quantity <= {HALF} THEN 'low' ELSE 'high' END"
_BANDS = f"CASE WHEN l_quantity <= {LOW} THEN 'low' WHEN l_quantity <= {HIGH} THEN 'mid' ELSE 'high' END"


def _split(spark, sf, target):
    rows = lineitem(spark, sf).withColumn("target", F.expr(target))
    even = F.pmod("l_orderkey", F.lit(2)) == 0
    return rows.filter(even), rows.filter(~even)


def learned_tree(spark, sf):
    train, held_out = _split(spark, sf, _HALVES)
    path = scratch_path(spark, "learned-tree")
    jobs.tree_train(train, _HALF_ROLES, path, "binary", 1)
    return jobs.tree_test(spark, held_out, _HALF_ROLES, path)


def learned_tree_bands(spark, sf):
    train, held_out = _split(spark, sf, _BANDS)
    path = scratch_path(spark, "learned-bands")
    jobs.tree_train(train, _BAND_ROLES, path, "multiClass", 2)
    return jobs.multiclass_per_class_test(spark, held_out, _BAND_ROLES, path)


def learned_tree_rule(spark, sf):
    """The root's rule as explained: feature position, whole part of the threshold, and held-out rows it gets wrong."""
    train, held_out = _split(spark, sf, _HALVES)
    model = jobs.tree_train(train, _HALF_ROLES, scratch_path(spark, "learned-rule"), "binary", 1)
    rule = r"If \(feature (\d+) <= ([0-9.]+)\)"
    found = (MD.tree_debug_rows(spark, model).filter(F.col("rule").rlike(rule))
             .select(F.regexp_extract("rule", rule, 1).cast("int").alias("feature"),
                     F.regexp_extract("rule", rule, 2).cast("double").alias("threshold")).first())
    column = list(L_ROLES.feature_order)[found["feature"]]
    wrong = (F.col(column) > found["threshold"]) != (F.col("target") == "high")
    return held_out.agg(F.lit(found["feature"]).alias("feature"),
                        F.lit(int(found["threshold"])).cast("long").alias("threshold_floor"),
                        F.count("*").alias("n_held_out"), F.count_if(wrong).alias("n_wrong"))


def learned_depths(spark, sf):
    """Confusion counts per depth for a target that takes two cuts, of the rows of the fit and of held-out ones."""
    inner = f"CASE WHEN l_quantity > {INNER} AND l_quantity <= {HIGH} THEN 'inner' ELSE 'low' END"
    train, held_out = _split(spark, sf, inner)
    rows, tests = (jobs.with_binary_target(r, _HALF_ROLES) for r in (train, held_out))
    counts = ["tp", "tn", "fp", "fn", "n", "n_mismatch"]

    def stages(depth):
        return MD.tree_pipeline(list(L_ROLES.feature_order), L_ROLES.vocabularies, max_depth=depth).getStages()

    def evaluate(depth, tree, cached):
        return {"max_depth": depth, **M.confusion_counts(tree.transform(cached)).first().asDict()}

    fitted, models = sweep_fits(spark, Pipeline(stages=stages(1)[:-1]), rows, DEPTHS, lambda d: stages(d)[-1], evaluate,
                                "max_depth int, tp long, tn long, fp long, fn long, n long, n_mismatch long",
                                spread=spread_by_rows(rows.count(), tuple(L_KEYS)))
    unseen = spark.createDataFrame([(d, *M.confusion_counts(m.transform(tests)).select(*counts).first())
                                    for d, m in models.items()], fitted.schema)
    return fitted.withColumn("fold", F.lit("fit")).union(unseen.withColumn("fold", F.lit("held_out")))


def learned_logistic(spark, sf):
    """Probabilities of a fit sum to the positives, and order held-out rows by the target."""
    train, held_out = _split(spark, sf, _HALVES)
    path = scratch_path(spark, "learned-logistic")
    model = jobs.logreg_binary_train(train, _HALF_ROLES, path, max_iter=100)
    fitted = MD.positive_score(model.transform(jobs.with_binary_target(train, _HALF_ROLES)))
    sums = fitted.agg(F.count("*").alias("n"), F.abs(F.avg("score") - F.avg("label")).alias("gap")).first()
    scored = MD.positive_score(model.transform(jobs.with_binary_target(held_out, _HALF_ROLES)))
    return M.area_under_roc(scored, "score").select(
        "n_pos", "n_neg", (F.col("auc") > 0.99).alias("ordered"), F.lit(sums["n"]).cast("long").alias("n_train"),
        F.lit(sums["gap"] < 1e-3).alias("calibrated"))


def learned_clusters(spark, sf):
    """Per k: rows in clusters, rows not at their nearest centre, and whether the cost fell."""
    vectors = FE.with_vector(embeddings(spark, sf), "embedding", "raw_features")
    prefix = Pipeline(stages=MD.kmeans_pipeline(2).getStages()[:-1])

    def evaluate(k, km, cached):
        scored = km.transform(cached)
        sizes = C.cluster_sizes(scored).agg(F.sum("size")).first()[0]
        ids, centres = C.model_centers(km)
        nearest = C.assign_nearest(
            scored.select(F.col("prediction").alias("given"), vector_to_array("features").alias("__f")),
            "__f", ids, centres)
        return {"k": k, "n": sizes, "n_not_nearest": nearest.filter("given <> prediction").count(),
                "cost": jobs.centres_cost(km, cached)}

    table, _ = sweep_fits(spark, prefix, vectors, KS, lambda k: MD.kmeans_pipeline(k).getStages()[-1], evaluate,
                          "k int, n long, n_not_nearest long, cost double")
    before = F.lag("cost").over(Window.orderBy("k"))   # one row per k
    return table.select("k", "n", "n_not_nearest", F.coalesce(F.col("cost") < before, F.lit(True)).alias("cost_fell"))


QUERIES = {f.__name__: f for f in (learned_tree, learned_tree_bands, learned_tree_rule, learned_depths,
                                   learned_logistic, learned_clusters)}


# ---- what SQL says they must give ---------------------------------------------------

_ODD, _EVEN = "l_orderkey % 2 <> 0", "l_orderkey % 2 = 0"


def _count(condition: str) -> str:
    return f"CAST(count_if({condition}) AS BIGINT)"


_INSIDE = f"l_quantity > {INNER} AND l_quantity <= {HIGH}"
ORACLE_SQL = {
    "learned_tree": f"""SELECT {_count(f'l_quantity > {HALF}')} AS tp, {_count(f'l_quantity <= {HALF}')} AS tn,
  CAST(0 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS fn, count(*) AS n, CAST(0 AS BIGINT) AS n_mismatch,
  CAST(1 AS DOUBLE) AS precision, CAST(1 AS DOUBLE) AS recall, CAST(1 AS DOUBLE) AS f1,
  CAST(0 AS DOUBLE) AS error, CAST(1 AS DOUBLE) AS accuracy FROM lineitem WHERE {_ODD}""",
    "learned_tree_bands": f"""SELECT cls, count(*) AS n_actual, count(*) AS n_predicted, count(*) AS tp,
  CAST(1 AS DOUBLE) AS precision, CAST(1 AS DOUBLE) AS recall, CAST(1 AS DOUBLE) AS f1
FROM (SELECT CAST(CASE WHEN l_quantity <= {LOW} THEN 0 WHEN l_quantity <= {HIGH} THEN 1 ELSE 2 END AS DOUBLE) AS cls
      FROM lineitem WHERE {_ODD}) GROUP BY cls""",
    "learned_tree_rule": f"""SELECT CAST(0 AS INTEGER) AS feature,
  CAST(max(CASE WHEN {_EVEN} AND l_quantity <= {HALF} THEN l_quantity END) AS BIGINT) AS threshold_floor,
  {_count(_ODD)} AS n_held_out, CAST(0 AS BIGINT) AS n_wrong FROM lineitem""",
    # one cut takes the upper edge, which parts more; the rows below the lower one stay wrong
    "learned_depths": f"""SELECT CASE WHEN {_EVEN} THEN 'fit' ELSE 'held_out' END AS fold,
  CAST(max_depth AS INTEGER) AS max_depth, {_count(_INSIDE)} AS tp,
  {_count(f'l_quantity > {HIGH} OR (l_quantity <= {INNER} AND max_depth > 1)')} AS tn,
  {_count(f'l_quantity <= {INNER} AND max_depth = 1')} AS fp, CAST(0 AS BIGINT) AS fn, count(*) AS n,
  {_count(f'l_quantity <= {INNER} AND max_depth = 1')} AS n_mismatch
FROM lineitem, (VALUES {', '.join(f'({d})' for d in DEPTHS)}) AS d(max_depth) GROUP BY ALL""",
    "learned_logistic": f"""SELECT {_count(f'{_ODD} AND l_quantity > {HALF}')} AS n_pos,
  {_count(f'{_ODD} AND l_quantity <= {HALF}')} AS n_neg, TRUE AS ordered,
  {_count(_EVEN)} AS n_train, TRUE AS calibrated FROM lineitem""",
    "learned_clusters": f"""SELECT CAST(k AS INTEGER) AS k, count(*) AS n, CAST(0 AS BIGINT) AS n_not_nearest,
  TRUE AS cost_fell FROM embeddings, (VALUES {', '.join(f'({k})' for k in KS)}) AS k(k) GROUP BY k""",
}
