"""Fitted models on planted structure of ``lineitem``: what a right fit must give is known to SQL.

* steps -- a column that is 0 below a cut and at least 10 above it, so a plane
  parts the classes with room to spare and a linear model makes no error;
* clusters -- five narrow clouds round points far apart, one for each line
  number (those from 5 on share the last), with a label each;
* noise -- a target that follows the quantity up to a known pseudo-random shift, so
  no model is perfect, and the penalty from which all weights are zero can be
  computed.

Models are fitted on lines of even orders and tested on odd ones through the
train and test jobs, unless the operator is the fit itself; then all lines are
used.  Inputs are dealt by the line's keys, so fits do not follow the number of cores.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connscore.operators import clusters as C
from connscore.operators import features as FE
from connscore.operators import metrics as M
from connscore.operators import models as MD
from connscore.operators import path as PA
from connscore.operators.prepare import spread_by_rows
from connscore.operators.sweeps import select_best, sweep_fits
from connscore.plans import jobs
from connscore.plans.roles import L_KEYS, L_NUMERIC, L_ROLES, lineitem
from connscore.session import scratch_path
from connscore.sources.model_store import load_pipeline
from connscore.sources.scratch import scratch_folder

HALF, LOW, HIGH = 25, 15, 35
CLUSTERS = 5
#: The sweeps' published grids.
DEPTHS, KS = [6, 8, 10, 12], [5, 10, 20, 40, 60, 80, 100, 120]
#: k among which the silhouette has to find the planted one.
CHOICE = (3, 8)

_BAND = f"CASE WHEN l_quantity <= {LOW} THEN 'low' WHEN l_quantity <= {HIGH} THEN 'mid' ELSE 'high' END"
_HALVES = f"CASE WHEN l_quantity <= {HALF} THEN 'low' ELSE 'high' END"
_CLUSTER = f"least(l_linenumber, {CLUSTERS})"
_CLOUD_LABEL = f"CASE WHEN {_CLUSTER} = 1 THEN 'low' WHEN {_CLUSTER} <= 3 THEN 'mid' ELSE 'high' END"
_SHIFT = "(l_orderkey * 7919 + l_linenumber * 104729) % 41 - 20"
_NOISY = f"CASE WHEN l_quantity + ({_SHIFT}) > 25 THEN 'high' ELSE 'low' END"

_STEPS = {"low_step": f"CASE WHEN l_quantity <= {LOW} THEN 10 + ({LOW} - l_quantity) / 10 ELSE 0 END",
          "half_step": f"CASE WHEN l_quantity > {HALF} THEN 10 + (l_quantity - {HALF}) / 10 ELSE 0 END",
          "high_step": f"CASE WHEN l_quantity > {HIGH} THEN 10 + (l_quantity - {HIGH}) / 10 ELSE 0 END"}
_PLACES = [(0.0, 0.0), (100.0, 0.0), (0.0, 100.0), (100.0, 100.0), (50.0, 300.0)]

_HALF_ROLES = replace(L_ROLES, label="halves", normal_token="low", classes=("low", "high"),
                      numeric=("half_step", "l_discount", "l_tax"))
_BAND_ROLES = replace(L_ROLES, label="band", normal_token="low", classes=("low", "mid", "high"),
                      numeric=("low_step", "high_step", "l_discount", "l_tax"))
_CLOUD_ROLES = replace(_BAND_ROLES, label="cloud_label", numeric=("x", "y"))


def planted_lines(spark, sf) -> DataFrame:
    """lineitem with the planted columns and targets."""
    lines = lineitem(spark, sf)
    cluster = F.expr(_CLUSTER).cast("int")
    at = lambda k: F.element_at(F.array(*[F.lit(p[k]) for p in _PLACES]), cluster)
    wide = lambda c: F.col(c).cast("double")
    return lines.select(
        "*", *[F.expr(e).cast("double").alias(n) for n, e in _STEPS.items()],
        F.expr(_HALVES).alias("halves"), F.expr(_BAND).alias("band"), F.expr(_NOISY).alias("noisy"),
        cluster.alias("cloud"), F.expr(_CLOUD_LABEL).alias("cloud_label"),
        (at(0) + wide("l_discount") * 10).alias("x"), (at(1) + wide("l_tax") * 10).alias("y"))


def _spread(rows: DataFrame):
    return spread_by_rows(rows.count(), tuple(L_KEYS))


def _split(spark, sf):
    rows = planted_lines(spark, sf)
    even = F.pmod("l_orderkey", F.lit(2)) == 0
    return rows.filter(even), rows.filter(~even)


# ---- binary logistic regression ---------------------------------------------------------

def _binary_fit(spark, rows, name):
    path = scratch_folder(spark, name)
    return path, jobs.logreg_binary_train(rows, _HALF_ROLES, path, reg_param=1e-4, max_iter=100, spread=_spread(rows))


def fit_logistic(spark, sf):
    rows = planted_lines(spark, sf)
    _, model = _binary_fit(spark, rows, "logreg")
    return M.binary_metrics(model.transform(jobs.with_binary_target(rows, _HALF_ROLES)))


def fit_logistic_summary(spark, sf):
    """Training summary of the fitted model: exact AUC and the best F-measure."""
    rows = planted_lines(spark, sf)
    _, model = _binary_fit(spark, rows, "logreg-summary")
    return jobs.training_summary(model, rows, _HALF_ROLES).drop("best_threshold")


def logreg_binary_held_out(spark, sf):
    train, held_out = _split(spark, sf)
    path, _ = _binary_fit(spark, train, "logreg-held-out")
    return jobs.logreg_binary_test(spark, held_out, _HALF_ROLES, path)


# ---- one-vs-rest ------------------------------------------------------------------------

def _ovr_fit(spark, rows, name):
    path = scratch_folder(spark, name)
    return path, jobs.logreg_multiclass_train(rows, _BAND_ROLES, path, reg_param=1e-4, max_iter=100,
                                              spread=_spread(rows))


def fit_one_vs_rest(spark, sf):
    rows = planted_lines(spark, sf)
    _, model = _ovr_fit(spark, rows, "ovr")
    return M.per_class_metrics(model.transform(jobs.with_class_target(rows, _BAND_ROLES)))


def ovr_held_out(spark, sf):
    """Per class on held-out rows: saved model, read again, scored by its weight table."""
    train, held_out = _split(spark, sf)
    path, _ = _ovr_fit(spark, train, "ovr-held-out")
    return jobs.multiclass_per_class_test(spark, held_out, _BAND_ROLES, path)


def ovr_collapsed_held_out(spark, sf):
    train, held_out = _split(spark, sf)
    path, _ = _ovr_fit(spark, train, "ovr-collapsed")
    return jobs.logreg_multiclass_test(spark, held_out, _BAND_ROLES, path)


def ovr_table_scores(spark, sf):
    """Per predicted class: rows, rows where the weight table and the fitted stages differ, rows whose margin is not the largest."""
    train, held_out = _split(spark, sf)
    path, model = _ovr_fit(spark, train, "ovr-table")
    kept = scratch_folder(spark, "ovr-weights")
    jobs.logreg_multiclass_table(spark, path).write.parquet(kept)
    stages = model.transform(jobs.with_class_target(held_out, _BAND_ROLES)).select(
        *L_KEYS, *_BAND_ROLES.numeric, "band", F.col("prediction").alias("of_stages"))
    scored = MD.score_one_vs_rest_table(stages, spark.read.parquet(kept), margins=True)
    highest = F.greatest(*[F.col(f"margin_{k}") for k in range(3)])
    return scored.groupBy("prediction").agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") != F.col("of_stages")).alias("n_differ"),
        F.count_if(F.col("max_margin") != highest).alias("n_not_largest"),
        F.count_distinct("band").alias("n_bands"))


# ---- trees ------------------------------------------------------------------------------

_TREE_HALF = replace(L_ROLES, label="halves", normal_token="low", classes=("low", "high"))
_TREE_BAND = replace(L_ROLES, label="band", normal_token="low", classes=("low", "mid", "high"))


def _tree(spark, rows, roles, mode, depth):
    return jobs.tree_train(rows, roles, scratch_folder(spark, "tree"), mode, depth, spread=_spread(rows))


def fit_tree(spark, sf):
    rows = planted_lines(spark, sf)
    model = _tree(spark, rows, _TREE_HALF, "binary", 4)
    return M.binary_metrics(model.transform(jobs.with_binary_target(rows, _TREE_HALF)))


def fit_tree_multiclass(spark, sf):
    rows = planted_lines(spark, sf)
    model = _tree(spark, rows, _TREE_BAND, "multiClass", 4)
    return M.per_class_metrics(model.transform(jobs.with_class_target(rows, _TREE_BAND)))


def tree_feature_importances(spark, sf):
    model = _tree(spark, planted_lines(spark, sf), _TREE_HALF, "binary", 4)
    names = [f"{c}_idx" if c in L_ROLES.vocabularies else c for c in L_ROLES.feature_order]
    return MD.feature_importances(spark, model, names)


def tree_rules(spark, sf):
    """The explanation's lines below its header (which holds the model's random name)."""
    model = _tree(spark, planted_lines(spark, sf), _TREE_HALF, "binary", 3)
    return MD.tree_debug_rows(spark, model).filter("line_no > 0").withColumn("rule", F.trim("rule"))


def sweep_tree_depth(spark, sf):
    """Metrics per depth of the published grid, on held-out rows."""
    train, held_out = _split(spark, sf)

    def stages(depth):
        return MD.tree_pipeline(list(L_ROLES.feature_order), L_ROLES.vocabularies, max_depth=depth).getStages()

    rows = jobs.with_binary_target(train, _TREE_HALF)
    tests = jobs.with_binary_target(held_out, _TREE_HALF)
    _, models = sweep_fits(spark, Pipeline(stages=stages(2)[:-1]), rows, DEPTHS, lambda d: stages(d)[-1],
                           lambda d, tree, cached: {"max_depth": d}, "max_depth int", spread=_spread(rows))
    found = [(d, *M.binary_metrics(m.transform(tests)).select("precision", "recall", "f1", "error").first())
             for d, m in models.items()]
    return spark.createDataFrame(found, "max_depth int, precision double, recall double, f1 double, error double")


# ---- k-means ------------------------------------------------------------------------------

def fit_kmeans(spark, sf):
    """Rows of each fitted cluster, named by the planted cloud that it covers."""
    rows = planted_lines(spark, sf)
    model = MD.fit_pipeline(MD.kmeans_pipeline(CLUSTERS, ["x", "y"]), rows.select("x", "y", *L_KEYS), spread=_spread(rows))
    return (model.transform(rows.select("x", "y", "cloud")).groupBy("prediction")
            .agg(F.min("cloud").alias("cloud"), F.count_distinct("cloud").alias("n_clouds"), F.count("*").alias("size"))
            .drop("prediction"))


def k_sweep_select(spark, sf):
    """The k with the best silhouette among 3 to 8."""
    rows = planted_lines(spark, sf)
    table, _ = jobs.kmeans_sweep(spark, rows.select("x", "y", *L_KEYS), range(CHOICE[0], CHOICE[1] + 1),
                                 feature_cols=["x", "y"], spread=_spread(rows))
    return select_best(table, "silhouette").select("k")


def sweep_k(spark, sf):
    """Per k of the published grid: metrics of the clusters labelled by majority."""
    rows = jobs.with_class_target(planted_lines(spark, sf), _CLOUD_ROLES)
    models, facts = jobs.kmeans_fits(spark, rows.select("x", "y", "label", *L_KEYS), KS, feature_cols=["x", "y"],
                                     label_col="label", spread=_spread(rows))
    names = ["precision", "recall", "f1", "error"]
    metrics = {k: jobs.cluster_label_metrics(facts, k) for k in models}
    found = [(k, *[m[c] for c in names]) for k, m in metrics.items()]
    return spark.createDataFrame(found, "k int, precision double, recall double, f1 double, error double")


def _kmeans_trained(spark, train, choose="silhouette"):
    model, names = scratch_folder(spark, "kmeans"), scratch_folder(spark, "kmeans-dict")
    jobs.kmeans_train(spark, train, _CLOUD_ROLES, model, names, *CHOICE, step=1, choose=choose, spread=_spread(train))
    return model, names


def kmeans_held_out(spark, sf):
    """k by silhouette, clusters labelled, saved; then held-out rows scored and joined with the dictionary."""
    train, held_out = _split(spark, sf)
    return jobs.kmeans_test(spark, held_out, _CLOUD_ROLES, *_kmeans_trained(spark, train))


def cluster_relabel(spark, sf):
    """Clusters per label after two batches of rows: the counts of the first are kept, not scored again."""
    train, later = _split(spark, sf)
    model, _ = _kmeans_trained(spark, train)
    counts = scratch_folder(spark, "label-counts")
    for name, rows in (("even", train), ("odd", later)):
        dictionary = jobs.kmeans_relabel(spark, rows, _CLOUD_ROLES, model, scratch_folder(spark, "relabelled"),
                                         counts, name)
    return C.cluster_coverage(dictionary)


def cluster_counts_merged(spark, sf):
    """Rows per planted cloud and label after two batches (and one of them again)."""
    rows = planted_lines(spark, sf).select("l_orderkey", F.col("cloud").alias("prediction"),
                                           F.col("l_linestatus").alias("label"))
    counts = scratch_folder(spark, "cloud-counts")
    for part in (0, 1, 0):
        C.keep_label_counts(rows.filter(F.pmod("l_orderkey", F.lit(2)) == part), counts, f"part-{part}")
    kept = C.kept_label_counts(spark, counts, "string")
    return kept.join(C.majority_of_counts(kept).withColumnRenamed("label", "majority"), "prediction")


# ---- regularisation path ------------------------------------------------------------------

_NOISE_ROLES = replace(L_ROLES, label="noisy", normal_token="low", classes=("low", "high"))


def sweep_lambda(spark, sf):
    """Per published penalty: rows, whether all weights are zero, whether the weights shrink, whether mean
    probabilities equal the share of positives, and whether held-out rows are ordered (or all tie)."""
    train, held_out = _split(spark, sf)
    rows = jobs.with_binary_target(train, _NOISE_ROLES)
    models = PA.fit_path(rows, L_NUMERIC, spread=_spread(rows))
    tests = jobs.with_binary_target(held_out, _NOISE_ROLES)
    scored = tests.select("label", F.inline(F.array(*[
        F.struct(F.lit(m.penalty).alias("penalty"), PA.sigmoid(m.margin()).alias("score")) for m in models])))
    auc = M.area_under_roc_by(scored, "penalty", "score")
    fitted = rows.agg(F.count("label").alias("n"), F.avg("label").alias("label"),
                      *[F.avg(PA.sigmoid(m.margin())).alias(f"p{i}") for i, m in enumerate(models)]).first()
    norms = [sum(map(abs, m.weights)) for m in models]
    facts = spark.createDataFrame(
        [(m.penalty, fitted["n"], not any(m.weights), i == 0 or norms[i] <= norms[i - 1] + 1e-9,
          abs(fitted[f"p{i}"] - fitted["label"]) < 1e-6) for i, m in enumerate(models)],
        "penalty double, n_train long, all_zero boolean, shrinks boolean, calibrated boolean")
    ordered = F.when(F.col("all_zero"), F.col("auc") == 0.5).otherwise(F.col("auc") > 0.8)
    return facts.join(auc, "penalty").select(
        "penalty", "n_train", (F.col("n_pos") + F.col("n_neg")).alias("n_held_out"), "all_zero", "shrinks", "calibrated",
        ordered.alias("ordered"))


def model_roundtrip(spark, sf):
    """Save, reload, rescore: the loaded model's output vs the in-memory one, in one pass."""
    rows = jobs.with_binary_target(planted_lines(spark, sf), _HALF_ROLES)
    path, model = _binary_fit(spark, rows, "roundtrip")
    first = model.transform(rows).select(
        *rows.columns, F.col("prediction").alias("p_mem"), vector_to_array("probability")[1].alias("q_mem"))
    both = load_pipeline(path).transform(first).select(
        "p_mem", "q_mem", F.col("prediction").alias("p_disk"), vector_to_array("probability")[1].alias("q_disk"))
    return both.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(F.col("p_mem") != F.col("p_disk")).alias("n_prediction_diff"),
                    F.max(F.abs(F.col("q_mem") - F.col("q_disk"))).alias("max_probability_diff"))


QUERIES = {f.__name__: f for f in (
    fit_logistic, fit_logistic_summary, logreg_binary_held_out, fit_one_vs_rest, ovr_held_out, ovr_collapsed_held_out,
    ovr_table_scores, fit_tree, fit_tree_multiclass, tree_feature_importances, tree_rules, sweep_tree_depth, fit_kmeans,
    k_sweep_select, sweep_k, kmeans_held_out, cluster_relabel, cluster_counts_merged, sweep_lambda, model_roundtrip)}


# ---- what SQL says they must give -----------------------------------------------------------

_ODD, _EVEN = "l_orderkey % 2 <> 0", "l_orderkey % 2 = 0"
_ONES = ("CAST(1 AS DOUBLE) AS precision, CAST(1 AS DOUBLE) AS recall, CAST(1 AS DOUBLE) AS f1, "
         "CAST(0 AS DOUBLE) AS error")


def _perfect(positive: str, where: str = "TRUE", extra: str = "") -> str:
    return f"""SELECT CAST(count_if({positive}) AS BIGINT) AS tp, CAST(count_if(NOT ({positive})) AS BIGINT) AS tn,
  CAST(0 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS fn, count(*) AS n, CAST(0 AS BIGINT) AS n_mismatch,
  {_ONES}, CAST(1 AS DOUBLE) AS accuracy{extra} FROM lineitem WHERE {where}"""


def _per_class(where: str = "TRUE") -> str:
    return f"""SELECT CAST(CASE {_BAND.removeprefix('CASE ').replace("'low'", '0').replace("'mid'", '1').replace("'high'", '2')}
  AS DOUBLE) AS cls, count(*) AS n_actual, count(*) AS n_predicted, count(*) AS tp,
  CAST(1 AS DOUBLE) AS precision, CAST(1 AS DOUBLE) AS recall, CAST(1 AS DOUBLE) AS f1
FROM lineitem WHERE {where} GROUP BY 1"""


_FIRST_CLASS = f"l_quantity > {HALF}"
_GRID = ", ".join(f"({p!r}::DOUBLE)" for p in PA.PENALTIES)
_COVARIANCES = " ,\n  ".join(
    f"abs(covar_pop(CAST({c} AS DOUBLE), y) / stddev_samp(CAST({c} AS DOUBLE)))" for c in L_NUMERIC)

ORACLE_SQL = {
    "fit_logistic": _perfect(_FIRST_CLASS),
    "fit_logistic_summary": f"""SELECT CAST(count_if({_FIRST_CLASS}) AS BIGINT) AS n_pos,
  CAST(count_if(NOT ({_FIRST_CLASS})) AS BIGINT) AS n_neg, CAST(1 AS DOUBLE) AS auc,
  CAST(1 AS DOUBLE) AS best_f_measure, CAST(0 AS BIGINT) AS n_unscored FROM lineitem""",
    "logreg_binary_held_out": _perfect(_FIRST_CLASS, _ODD),
    "fit_one_vs_rest": _per_class(),
    "ovr_held_out": _per_class(_ODD),
    "ovr_collapsed_held_out": _perfect(f"l_quantity > {LOW}", _ODD),
    "ovr_table_scores": f"""SELECT cls AS prediction, n_actual AS n, CAST(0 AS BIGINT) AS n_differ,
  CAST(0 AS BIGINT) AS n_not_largest, CAST(1 AS BIGINT) AS n_bands FROM ({_per_class(_ODD)})""",
    "fit_tree": _perfect(_FIRST_CLASS),
    "fit_tree_multiclass": _per_class(),
    "tree_feature_importances": "SELECT feature, importance FROM (VALUES " + ", ".join(
        f"('{c}', CAST({int(c == 'l_quantity')} AS DOUBLE))"
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus_idx"]) + ") AS t(feature, importance)",
    "tree_rules": f"""WITH cut AS (SELECT (max(CASE WHEN l_quantity <= {HALF} THEN CAST(l_quantity AS DOUBLE) END)
    + min(CASE WHEN l_quantity > {HALF} THEN CAST(l_quantity AS DOUBLE) END)) / 2 AS c FROM lineitem)
SELECT CAST(line_no AS INTEGER) AS line_no, rule FROM cut, LATERAL (VALUES
  (1, 'If (feature 0 <= ' || c || ')'), (2, 'Predict: 0.0'),
  (3, 'Else (feature 0 > ' || c || ')'), (4, 'Predict: 1.0')) AS t(line_no, rule)""",
    "sweep_tree_depth": f"""SELECT CAST(d AS INTEGER) AS max_depth, {_ONES}
FROM (VALUES {', '.join(f'({d})' for d in DEPTHS)}) AS t(d)""",
    "fit_kmeans": f"""SELECT CAST({_CLUSTER} AS INTEGER) AS cloud, CAST(1 AS BIGINT) AS n_clouds, count(*) AS size
FROM lineitem GROUP BY 1""",
    "k_sweep_select": f"SELECT CAST(count(DISTINCT {_CLUSTER}) AS INTEGER) AS k FROM lineitem",
    "sweep_k": f"""SELECT CAST(k AS INTEGER) AS k, {_ONES} FROM (VALUES {', '.join(f'({k})' for k in KS)}) AS t(k)""",
    "kmeans_held_out": _perfect(f"{_CLUSTER} > 1", _ODD, ", CAST(0 AS BIGINT) AS n_uncovered"),
    "cluster_relabel": f"""SELECT CAST(CASE WHEN c = 1 THEN 0 WHEN c <= 3 THEN 1 ELSE 2 END AS DOUBLE) AS label,
  count(*) AS n_clusters FROM (SELECT DISTINCT {_CLUSTER} AS c FROM lineitem) GROUP BY 1""",
    "cluster_counts_merged": f"""WITH n AS (
  SELECT CAST({_CLUSTER} AS INTEGER) AS prediction, l_linestatus AS label, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT prediction, label, n,
  first_value(label) OVER (PARTITION BY prediction ORDER BY n.n DESC, label DESC) AS majority FROM n""",
    # the weights are all zero from the penalty on whose share of |w| exceeds every covariance with the target
    "sweep_lambda": f"""WITH t AS (
  SELECT *, CASE WHEN l_quantity + ({_SHIFT}) > 25 THEN 1.0 ELSE 0.0 END AS y FROM lineitem),
most AS (SELECT greatest({_COVARIANCES}) AS c, count(*) AS n FROM t WHERE {_EVEN})
SELECT penalty, n AS n_train, (SELECT count(*) FROM t WHERE {_ODD}) AS n_held_out,
  0.2 * penalty >= c AS all_zero, TRUE AS shrinks, TRUE AS calibrated, TRUE AS ordered
FROM most, (VALUES {_GRID}) AS g(penalty)""",
    "model_roundtrip": """SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_prediction_diff,
  CAST(0 AS DOUBLE) AS max_probability_diff FROM lineitem""",
}
