import numpy as np

from connscore.operators import clusters as C
from connscore.operators.features import with_vector
from connscore.operators.models import kmeans_pipeline
from connscore.plans import jobs
from connscore.session import scratch_path
from connscore.sources.cluster_dict import read_cluster_dict, write_cluster_dict

SF001 = "/root/testdata/sf0.01"


def test_majority_tie_goes_to_larger_label(spark):
    rows = [(0, 1.0), (0, 1.0), (0, 4.0), (0, 4.0), (0, 2.0), (1, 3.0), (1, 0.0), (1, 3.0)]
    df = spark.createDataFrame(rows, "prediction int, label double")
    got = {r.prediction: r.label for r in C.cluster_majority(df).collect()}
    assert got == {0: 4.0, 1: 3.0}


def test_join_and_uncovered(spark):
    scored = spark.createDataFrame([(1, 0.0, 0), (2, 1.0, 1), (3, 1.0, 2)],
                                   "id int, label double, prediction int")
    dictionary = spark.createDataFrame([(0, 0.0), (1, 5.0)], "prediction int, label double")
    joined = C.join_cluster_labels(scored, dictionary, keep=["id"], max_dictionary_rows=2)
    assert sorted((r.id, r.actual_label, r.label) for r in joined.collect()) == \
        [(1, 0.0, 0.0), (2, 1.0, 5.0)]
    lost = C.uncovered_rows(scored, dictionary, max_dictionary_rows=2)
    assert [r.id for r in lost.collect()] == [3]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_nearest_center_matches_numpy(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    ids, centers = C.collect_centers(C.class_exemplars(emb, "label", "embedding", "vec_id"))
    got = {r.vec_id: (r.prediction, r.distance)
           for r in C.assign_nearest(emb, "embedding", ids, centers).collect()}
    pdf = emb.toPandas()
    x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["embedding"]])
    c = np.asarray(centers)
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    best = d.argmin(axis=1)
    for vid, b, row in zip(pdf["vec_id"], best, d):
        pred, dist = got[int(vid)]
        assert pred == ids[b]
        assert abs(dist - row[b]) < 1e-9
    for method in ("arrow", "expr"):
        plan = C.assign_nearest(emb, "embedding", ids, centers, method=method)._jdf \
            .queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan


def test_kmeans_cost_on_final_centres(spark):
    emb = with_vector(spark.read.parquet(f"{SF001}/embeddings.parquet"), "embedding",
                      "raw_features")
    model = kmeans_pipeline(4, scale=False, max_iter=3).fit(emb)
    cost = jobs.kmeans_cost(model, emb)
    x = np.stack([np.asarray(v, dtype=np.float64) for v in emb.toPandas()["embedding"]])
    c = np.asarray(model.stages[-1].clusterCenters())
    brute = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2).min(axis=1).sum()
    assert abs(cost - brute) < 1e-6 * max(1.0, brute)


def test_cluster_dict_roundtrip(spark):
    d = spark.createDataFrame([(0, 3.0), (1, 7.0)], "prediction int, label double")
    path = write_cluster_dict(d, scratch_path(spark, "dict-test"))
    back = read_cluster_dict(spark, path)
    assert back.schema.simpleString() == "struct<prediction:int,label:double>"
    assert sorted(tuple(r) for r in back.collect()) == [(0, 3.0), (1, 7.0)]


def test_coverage_and_sizes(spark):
    a = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 1.0), (2, 2.0)],
                              "prediction int, label double")
    d = C.cluster_majority(a)
    cov = {r.label: r.n_clusters for r in C.cluster_coverage(d).collect()}
    assert cov == {1.0: 2, 2.0: 1}
    sizes = {r.prediction: r.size for r in C.cluster_sizes(a).collect()}
    assert sizes == {0: 2, 1: 1, 2: 1}


def test_arrow_and_expression_paths_identical(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    ids, centers = C.collect_centers(C.class_exemplars(emb, "label", "embedding", "vec_id"))
    a = {r.vec_id: (r.prediction, r.distance)
         for r in C.assign_nearest(emb, "embedding", ids, centers, method="arrow").collect()}
    b = {r.vec_id: (r.prediction, r.distance)
         for r in C.assign_nearest(emb, "embedding", ids, centers, method="expr").collect()}
    assert a == b
    with_null = emb.select("vec_id", "embedding").union(
        spark.createDataFrame([(10**9, None)], "vec_id long, embedding array<float>"))
    got = {r.vec_id: r.prediction
           for r in C.assign_nearest(with_null, "embedding", ids, centers).collect()}
    assert got[10**9] is None and len(got) == emb.count() + 1


def test_empty_centre_table_is_refused(spark):
    import pytest
    empty = spark.createDataFrame([], "cid int, center array<double>")
    with pytest.raises(ValueError):
        C.collect_centers(empty)
