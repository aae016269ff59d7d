"""Several k in shared passes: centres, facts per cluster and label, number of passes."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from connscore.operators import kmeans_path as K
from connscore.operators import models as MD
from connscore.plans import planted

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    return np.concatenate([rng.normal(at, 0.1, (300, 2)) for at in ((0, 0), (9, 0), (0, 9))])


@pytest.fixture(scope="module")
def vectors(spark, points):
    rows = [(x.tolist(), None if i % 7 == 0 else float(i // 300)) for i, x in enumerate(points)]
    return spark.createDataFrame(rows, "x array<double>, label double").select(
        array_to_vector("x").alias("features"), "label").repartition(5)


def test_facts_equal_numpy(spark, points, vectors):
    estimators = {k: MD.kmeans_pipeline(k).getStages()[-1] for k in (2, 3, 6)}
    models, facts = K.kmeans_models(spark, vectors, estimators, "label")
    rows = facts.collect()
    for k, model in models.items():
        c = np.array(model.clusterCenters())
        assert model.getK() == k and len(c) == k
        far = ((points[:, None] - c) ** 2).sum(axis=2)
        near, two = far.argmin(axis=1), np.sort(far, axis=1)[:, :2]
        label = [None if i % 7 == 0 else float(i // 300) for i in range(len(points))]
        for r in (r for r in rows if r.k == k):
            own = np.array([p == r.prediction and y == r.label for p, y in zip(near, label, strict=True)])
            assert r.n == own.sum()
            assert r.cost == pytest.approx(two[own, 0].sum())
            assert r.inside == pytest.approx((1 - np.sqrt(two[own, 0] / two[own, 1])).sum())
        assert sum(r.n for r in rows if r.k == k) == len(points)
        # Lloyd has come to rest: a centre is the mean of its rows
        assert np.allclose(c, [points[near == i].mean(axis=0) for i in range(k)], atol=1e-3)
    assert sorted(np.round(models[3].clusterCenters(), 0).tolist()) == [[0, 0], [0, 9], [9, 0]]


def test_fewer_distinct_vectors_than_centres(spark):
    df = spark.createDataFrame([([float(i % 2)],) for i in range(9)], "x array<double>").select(
        array_to_vector("x").alias("features"))
    models, facts = K.kmeans_models(spark, df, {5: MD.kmeans_pipeline(5).getStages()[-1]})
    assert sorted(c[0] for c in models[5].clusterCenters()) == [0, 1]
    assert facts.agg(F.sum("n")).first()[0] == 9
    with pytest.raises(ValueError):
        K.kmeans_models(spark, df.limit(0), {2: MD.kmeans_pipeline(2).getStages()[-1]})


def test_all_k_share_their_passes(spark, vectors, monkeypatch):
    passes, sums = [], K._sums
    monkeypatch.setattr(K, "_sums", lambda blocks, centres, d: passes.append(len(centres)) or sums(blocks, centres, d))
    K.kmeans_models(spark, vectors, {k: MD.kmeans_pipeline(k, max_iter=4).getStages()[-1] for k in (2, 3, 4, 5, 6)})
    assert len(passes) <= 1 + 4 and passes[1] == 5


def test_sweep_k_equals_sql(spark):
    rows = planted.QUERIES["sweep_k"](spark, SF0001).collect()
    assert [tuple(r) for r in rows] == [(k, 1.0, 1.0, 1.0, 0.0) for k in planted.KS]
