import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from connscore.operators import metrics as M
from connscore.operators import models as MD
from connscore.operators.features import fit_scaler, scaler_moments, vector_columns
from connscore.plans import jobs
from connscore.plans.roles import L_NUMERIC, L_ROLES, lineitem
from connscore.session import scratch_path
from connscore.sources.model_store import load_pipeline

SF0001 = "/root/testdata/sf0.001"


def test_scaler_moments_match_sql(spark):
    li = lineitem(spark, SF0001)
    model = fit_scaler(li, L_NUMERIC)
    got = {r.feature: (r.mean, r.std) for r in scaler_moments(spark, model, L_NUMERIC).collect()}
    sql = li.agg(*[F.avg(c).alias(f"m_{c}") for c in L_NUMERIC],
                 *[F.stddev_samp(c).alias(f"s_{c}") for c in L_NUMERIC]).first()
    for c in L_NUMERIC:
        assert abs(got[c][0] - sql[f"m_{c}"]) < 1e-9 * max(1, abs(sql[f"m_{c}"]))
        assert abs(got[c][1] - sql[f"s_{c}"]) < 1e-9 * max(1, sql[f"s_{c}"])


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = fit_scaler(df, ["a", "b"]).transform(df)
    vals = vector_columns(out, "features", ["a_s", "b_s"]).collect()
    assert all(r.b_s == 0.0 for r in vals)


def test_fixed_logistic_score_equals_fitted_model(spark):
    li = jobs.with_binary_target(lineitem(spark, SF0001), L_ROLES)
    model = MD.logistic_pipeline(L_NUMERIC, max_iter=5).fit(li)
    lr = model.stages[-1]
    names = [f"x{i}" for i in range(len(L_NUMERIC))]
    arr = vector_to_array("features")
    scored = model.transform(li).select(
        *[arr[i].alias(n) for i, n in enumerate(names)],
        vector_to_array("probability")[1].alias("q"), F.col("prediction").alias("p"))
    fixed = MD.logistic_score_fixed(scored, names, list(lr.coefficients), lr.intercept)
    bad = fixed.filter((F.abs(F.col("probability") - F.col("q")) > 1e-9) |
                       (F.col("prediction") != F.col("p"))).count()
    assert bad == 0 and fixed.count() == li.count()


def test_ovr_fixed_argmax_ties_low(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "a double, b double")
    out = MD.ovr_score_fixed(df, ["a", "b"], [[1.0, 0.0], [0.0, 1.0], [0.5, 0.0]],
                             [0.0, 0.0, 0.0]).first()
    assert out.prediction == 0.0 and out.max_margin == 1.0


def test_rule_tree_score(spark):
    rule = {"feature": "x", "threshold": 0.5,
            "left": {"prediction": 0.0},
            "right": {"feature": "c", "categories": ["a"],
                      "left": {"prediction": 1.0}, "right": {"prediction": 2.0}}}
    df = spark.createDataFrame([(0.2, "a"), (0.9, "a"), (0.9, "b")], "x double, c string")
    assert [r.prediction for r in MD.tree_rule_score(df, rule).collect()] == [0.0, 1.0, 2.0]


def test_model_save_load_same_predictions(spark):
    li = lineitem(spark, SF0001)
    path = scratch_path(spark, "model-test")
    model = jobs.tree_train(li, L_ROLES, path, "binary", 3)
    target = jobs.with_binary_target(li, L_ROLES)
    first = model.transform(target).select(*target.columns, F.col("prediction").alias("a"))
    both = load_pipeline(path).transform(first)
    assert both.filter(F.col("a") != F.col("prediction")).count() == 0
    test = jobs.tree_test(spark, li, L_ROLES, path).first()
    assert test.n == li.count()
    rt = __import__("__spark_entry__").queries()["model_roundtrip"](spark, SF0001).first()
    assert rt.n == li.count() and rt.n_prediction_diff == 0 and rt.max_probability_diff == 0.0


def test_tree_multiclass_declares_classes(spark):
    li = lineitem(spark, SF0001)
    model = jobs.tree_train(li, L_ROLES, scratch_path(spark, "tree-mc"), "multiClass", 3)
    assert model.stages[-1].numClasses == len(L_ROLES.classes) + 1
    assert "If (feature" in model.stages[-1].toDebugString
    rows = MD.tree_debug_rows(spark, model).collect()
    assert rows[0].line_no == 0 and len(rows) > 1


def test_logistic_train_test_and_summary(spark):
    li = lineitem(spark, SF0001)
    path = scratch_path(spark, "lr-test")
    model = jobs.logreg_binary_train(li, L_ROLES, path)
    r = jobs.logreg_binary_test(spark, li, L_ROLES, path).first()
    assert r.tp + r.tn + r.fp + r.fn == r.n == li.count()
    s = jobs.training_summary(model, li, L_ROLES).first()
    assert 0.0 <= s.auc <= 1.0 and 0.0 <= s.best_f_measure <= 1.0


def test_one_vs_rest_collapsed_metrics(spark):
    li = lineitem(spark, SF0001)
    path = scratch_path(spark, "ovr-test")
    jobs.logreg_multiclass_train(li, L_ROLES, path, max_iter=3)
    r = jobs.logreg_multiclass_test(spark, li, L_ROLES, path).first()
    assert r.n == li.count() and 0.0 <= r.error <= 1.0


def test_kmeans_train_relabel_test(spark):
    li = lineitem(spark, SF0001)
    mp, dp = scratch_path(spark, "km-test"), scratch_path(spark, "km-dict")
    sweep = jobs.kmeans_train(spark, li, L_ROLES, mp, dp, min_k=2, max_k=12)
    costs = {r.k: r.cost for r in sweep.collect()}
    assert set(costs) == {2, 12} and all(math.isfinite(c) for c in costs.values())
    relabeled = jobs.kmeans_relabel(spark, li, L_ROLES, mp, dp + "-2")
    assert relabeled.count() <= 12
    r = jobs.kmeans_test(spark, li, L_ROLES, mp, dp).first()
    assert r.n == li.count()


def test_linear_score_equals_transform(spark):
    li = jobs.with_binary_target(lineitem(spark, "/root/testdata/sf0.01"), L_ROLES)
    model = MD.logistic_pipeline(L_NUMERIC, max_iter=10).fit(li)
    ref = model.transform(li).select(*li.columns, vector_to_array("probability")[1].alias("q"),
                                     F.col("prediction").alias("p"))
    fast = MD.linear_score(model, ref)
    bad = fast.filter((F.abs(F.col("score") - F.col("q")) > 1e-12) |
                      (F.col("prediction") != F.col("p"))).count()
    assert bad == 0
    plan = MD.linear_score(model, li)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan
    assert MD.linear_score(MD.kmeans_pipeline(3, L_NUMERIC).fit(li), li) is None


def test_accuracy_equals_multiclass_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    li = jobs.with_class_target(lineitem(spark, SF0001), L_ROLES)
    model = MD.one_vs_rest_pipeline(L_NUMERIC, max_iter=3).fit(li)
    scored = model.transform(li)
    ours = M.error_rate(scored).first().accuracy
    ref = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored)
    assert abs(ours - ref) < 1e-12


def test_cluster_sizes_equal_training_summary(spark):
    from connscore.operators import clusters as C
    li = lineitem(spark, SF0001)
    model = MD.kmeans_pipeline(5, L_NUMERIC).fit(li)
    ours = {r.prediction: r.size for r in C.cluster_sizes(model.transform(li)).collect()}
    summary = model.stages[-1].summary.clusterSizes
    assert [ours.get(i, 0) for i in range(len(summary))] == list(summary)


def test_prediction_only_scoring_equals_transform(spark):
    li = lineitem(spark, SF0001)
    model = jobs.tree_train(li, L_ROLES, scratch_path(spark, "tree-pred-only"), "binary", 4)
    target = jobs.with_binary_target(li, L_ROLES)
    first = model.transform(target).select(*target.columns, F.col("prediction").alias("a"))
    fast = MD.score(model, first)
    assert "probability" not in fast.columns
    assert fast.filter(F.col("a") != F.col("prediction")).count() == 0
    assert fast.count() == li.count()
