"""Fitted models on planted structure equal SQL; the path against MLlib; k, relabelling and dictionaries."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from connscore.operators import clusters as C
from connscore.operators import models as MD
from connscore.operators import path as PA
from connscore.operators.prepare import Spread, spread_by_rows
from connscore.operators.sweeps import select_best
from connscore.plans import jobs, planted
from connscore.plans.roles import L_KEYS, L_NUMERIC, L_ROLES, lineitem
from connscore.session import scratch_path
from connscore.sources.cluster_dict import checked_cluster_dict, read_cluster_dict, write_cluster_dict

SF0001 = "/root/testdata/sf0.001"


#: One key of each kind; tools/check_oracle.py runs them all.
KEYS = ["fit_logistic_summary", "ovr_held_out", "ovr_table_scores", "tree_rules", "k_sweep_select", "kmeans_held_out",
        "cluster_relabel", "cluster_counts_merged", "sweep_lambda"]


@pytest.mark.parametrize("name", KEYS)
def test_planted_query_equals_sql(spark, name):
    got = planted.QUERIES[name](spark, SF0001)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF0001}/lineitem.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({planted.ORACLE_SQL[name]}) ORDER BY ALL").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def noisy(spark):
    rows = jobs.with_binary_target(planted.planted_lines(spark, SF0001), planted._NOISE_ROLES)
    return rows.select(*L_NUMERIC, "label", *L_KEYS)


def test_path_equals_mllib(spark):
    rows = noisy(spark)
    models = PA.fit_path(rows, L_NUMERIC, penalties=[0.0, 0.01, 0.1, 2.0])
    for m in models:
        theirs = MD.logistic_pipeline(L_NUMERIC, reg_param=m.penalty, max_iter=300).fit(rows).stages[-1]
        assert np.allclose(m.weights, theirs.coefficients.toArray(), atol=2e-3)
        assert m.intercept == pytest.approx(theirs.intercept, abs=2e-3)
        # and never worse in what is minimised
        y = np.array([r.label for r in rows.select("label").collect()])
        x = np.array([r[:] for r in rows.select(*L_NUMERIC).collect()], float)
        x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)

        def objective(w, b):
            z = x @ w + b
            return (np.mean(np.logaddexp(0, z) - y * z)
                    + m.penalty * (0.2 * np.abs(w).sum() + 0.4 * (w ** 2).sum()))
        assert objective(np.array(m.weights), m.intercept) <= objective(theirs.coefficients.toArray(), theirs.intercept) + 1e-9


def test_path_from_an_earlier_path_takes_fewer_passes(spark):
    rows = noisy(spark)
    cold = PA.fit_path(rows, L_NUMERIC, penalties=[0.01, 0.05])
    warm = PA.fit_path(rows, L_NUMERIC, penalties=[0.01, 0.05], start={m.penalty: m for m in cold})
    assert all(w.passes < c.passes for w, c in zip(warm, cold, strict=True))
    assert all(np.allclose(w.weights, c.weights, atol=1e-6) for w, c in zip(warm, cold, strict=True))
    table = PA.path_table(spark, warm).collect()
    assert table[0]["norm"] > table[1]["norm"]


def test_path_odd_inputs(spark):
    df = spark.createDataFrame([(float(i % 2), float(i), 1.0) for i in range(40)] + [(None, 1.0, 1.0), (1.0, None, 1.0)],
                               "label double, a double, constant double")
    m, = PA.fit_path(df, ["a", "constant"], penalties=[0.1])
    assert m.weights[1] == 0.0 and np.isfinite(m.intercept)
    one, = PA.fit_path(df.filter("label = 1"), ["a"], penalties=[0.1])     # one class: nothing to tell apart
    assert one.weights == (0.0,)
    with pytest.raises(ValueError):
        PA.fit_path(df.limit(0), ["a"])


def test_weight_table_scores_like_the_fitted_stages(spark):
    lines = planted.planted_lines(spark, SF0001)
    path = scratch_path(spark, "ovr")
    model = jobs.logreg_multiclass_train(lineitem(spark, SF0001), L_ROLES, path)     # a hard target: margins are close
    table = jobs.logreg_multiclass_table(spark, path)
    assert table.count() == len(L_ROLES.classes) * (len(L_NUMERIC) + 1)
    stages = model.transform(lines).select(*L_KEYS, *L_NUMERIC, F.col("prediction").alias("of_stages"))
    scored = MD.score_one_vs_rest_table(stages, table)
    assert scored.filter("prediction <> of_stages").count() == 0
    plan = MD.score_one_vs_rest_table(lines, table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan and "Exchange" not in plan
    gap = spark.createDataFrame([(1.0, None, 0.1, 0.1)], "l_quantity double, l_extendedprice double, l_discount double, l_tax double")
    assert MD.score_one_vs_rest_table(gap, table).first()["prediction"] is None
    tie = spark.createDataFrame([(k, 0, "a", 1.0) for k in range(3)], "class int, position int, feature string, weight double")
    assert MD.score_one_vs_rest_table(spark.createDataFrame([(2.0,)], "a double"), tie).first()["prediction"] == 0.0


def cluster_sizes(spark, cores):
    lines = planted.planted_lines(spark, SF0001)
    df = lines.select(*L_NUMERIC, *L_KEYS).repartition(cores)     # as a scan by so many tasks would give
    spread = Spread(6, tuple(L_KEYS))
    model = MD.fit_pipeline(MD.kmeans_pipeline(7, L_NUMERIC), df, spread=spread)
    return sorted(map(tuple, C.cluster_sizes(model.transform(df)).collect()))


def test_a_spread_fit_does_not_follow_the_partitions(spark):
    assert cluster_sizes(spark, 2) == cluster_sizes(spark, 4)
    assert spread_by_rows(10 ** 9, ("k",)).partitions == 10_000


def test_k_is_chosen_by_silhouette_f1_or_cost(spark):
    rows = planted.planted_lines(spark, SF0001).select("x", "y", "cloud_label", *L_KEYS)
    spread = Spread(4, tuple(L_KEYS))
    table = {choose: jobs.kmeans_train(spark, rows, planted._CLOUD_ROLES, scratch_path(spark, "m"),
                                       scratch_path(spark, "d"), 3, 7, 1, choose, spread)
             for choose in ("silhouette", "f1")}
    assert select_best(table["silhouette"], "silhouette").first()["k"] == 5
    best = select_best(table["f1"], "f1").first()
    assert best["f1"] == 1.0
    assert select_best(table["f1"], "cost").first()["k"] == 7


def test_simplified_silhouette_by_hand(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 0.0],), ([10.0, 0.0],), (None,)], "v array<double>")
    scored = C.assign_two_nearest(df, "v", [0, 1], [[0.0, 0.0], [10.0, 0.0]])
    got = C.cluster_quality(scored).first()
    assert got["cost"] == 9.0
    assert got["silhouette"] == pytest.approx((1 + (7 - 3) / 7 + 1) / 3)
    alone = C.cluster_quality(C.assign_two_nearest(df, "v", [0], [[0.0, 0.0]])).first()
    assert alone["silhouette"] == 0.0


def test_merged_counts_change_the_majority_without_scoring_again(spark, tmp_path):
    first = spark.createDataFrame([(0, 1.0)] * 3 + [(1, 2.0)], "prediction int, label double")
    later = spark.createDataFrame([(0, 2.0)] * 5 + [(1, 2.0)], "prediction int, label double")
    path = str(tmp_path / "counts")
    C.keep_label_counts(first, path, "one")
    assert {tuple(r) for r in C.majority_of_counts(C.kept_label_counts(spark, path)).collect()} == {(0, 1.0), (1, 2.0)}
    for _ in range(2):      # the second time replaces the first
        C.keep_label_counts(later, path, "two")
    kept = C.kept_label_counts(spark, path)
    assert {tuple(r) for r in kept.collect()} == {(0, 1.0, 3), (0, 2.0, 5), (1, 2.0, 2)}
    assert {tuple(r) for r in C.majority_of_counts(kept).collect()} == {tuple(r) for r in
                                                                        C.cluster_majority(first.union(later)).collect()}
    with pytest.raises(ValueError):
        C.keep_label_counts(first, path, "a/b")


def test_dictionaries_are_checked_and_uncovered_rows_counted(spark, tmp_path):
    def written(rows):
        path = str(tmp_path / f"d{len(list(tmp_path.iterdir()))}")
        return write_cluster_dict(spark.createDataFrame(rows, "prediction int, label double"), path)
    for bad in ([(0, 1.0), (0, 2.0)], [(7, 1.0)], [(None, 1.0)]):
        with pytest.raises(ValueError):
            checked_cluster_dict(read_cluster_dict(spark, written(bad)), 5)
    rows = planted.planted_lines(spark, SF0001).select("x", "y", "cloud", "cloud_label", *L_KEYS)
    model = scratch_path(spark, "kmeans")
    jobs.kmeans_train(spark, rows, planted._CLOUD_ROLES, model, scratch_path(spark, "dict"), 5, 5, 1)
    from connscore.sources.model_store import load_pipeline
    scored = jobs.with_class_target(load_pipeline(model).transform(rows), planted._CLOUD_ROLES)
    lost = scored.filter("cloud = 2").first()["prediction"]
    path = str(tmp_path / "pruned")
    write_cluster_dict(C.cluster_majority(scored).filter(F.col("prediction") != lost), path)
    got = jobs.kmeans_test(spark, rows, planted._CLOUD_ROLES, model, path).first()
    n_lost = rows.filter("cloud = 2").count()
    assert got["n_uncovered"] == n_lost and got["n"] == rows.count() - n_lost and got["error"] == 0.0


def test_rows_without_a_label_are_counted_and_left_out(spark):
    rows = planted.planted_lines(spark, SF0001).withColumn(
        "band", F.when(F.col("l_linenumber") > 1, F.col("band")))
    count = jobs.unlabelled_rows(rows, planted._BAND_ROLES).first()
    assert 0 < count["n_unlabelled"] < count["n"]
    for train in (jobs.logreg_multiclass_train, jobs.logreg_binary_train, jobs.tree_train):
        train(rows, planted._BAND_ROLES, scratch_path(spark, "gaps"), **({"mode": "multiClass"} if train is jobs.tree_train else {}))

