import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from connscore.operators import metrics as M

# Published precision / recall / F1 rows of the source application, with the
# only integer confusion counts (tp, tn, fp, fn) consistent with them.
# Fixed values, in their published order.
GOLDEN = [
    (225569, 59599, 994, 24867, 0.995612699337, 0.900705170183, 0.945783953425),
    (225733, 59597, 996, 24703, 0.995607090403, 0.901360028111, 0.946142319743),
    (225506, 59648, 945, 24930, 0.995826911782, 0.900453608906, 0.945741863376),
    (226003, 59506, 1087, 24433, 0.995213351535, 0.90243814787, 0.946557883759),
    (225981, 58751, 1842, 24455, 0.991914775944, 0.902350301075, 0.945015148696),
    (237099, 45117, 15476, 13337, 0.938727110759, 0.946744876935, 0.942718946504),
    (239693, 42371, 18222, 10743, 0.929348816471, 0.957102812695, 0.943021652362),
    (250436, 0, 60593, 0, 0.805185368567, 1.0, 0.892080539303),
    (226690, 59590, 1003, 23746, 0.995594945826, 0.905181363702, 0.948237818664),
    (227176, 60380, 213, 23260, 0.999063279226, 0.907121979268, 0.950875320463),
    (228649, 60366, 227, 21787, 0.999008196578, 0.91300372151, 0.954071669393),
    (229103, 60296, 297, 21333, 0.998705318221, 0.91481655992, 0.954922098384),
    (229495, 60241, 352, 20941, 0.998468546468, 0.916381830088, 0.955665722085),
    (229108, 60271, 322, 21328, 0.998596521815, 0.9148365251, 0.954883238237),
    (229283, 60228, 365, 21153, 0.998410611022, 0.915535306426, 0.955178677065),
    (246647, 669, 59924, 3789, 0.804534675491, 0.984870386047, 0.885615441099),
    (224155, 59243, 1350, 26281, 0.994013436509, 0.895059017074, 0.941944484716),
    (224697, 59212, 1381, 25739, 0.993891488778, 0.897223242665, 0.943086666918),
    (201663, 59641, 952, 48773, 0.995301433754, 0.805247648102, 0.890244144699),
    (201742, 59624, 969, 48694, 0.99521979567, 0.805563097957, 0.890404217616),
    (202156, 59480, 1113, 48280, 0.994524497095, 0.807216214921, 0.891134106964),
    (201764, 59536, 1057, 48672, 0.994788508093, 0.805650944752, 0.890285202435),
    (201978, 59662, 931, 48458, 0.995411736296, 0.806505454487, 0.891056480164),
]


def test_reference_pairs(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 0.0), (1.0, 1.0)],
                               "label double, prediction double")
    r = M.binary_metrics(df).first()
    assert (r.tp, r.tn, r.fp, r.fn) == (1, 1, 0, 2)
    assert r.precision == 1.0 and abs(r.recall - 1 / 3) < 1e-12
    assert abs(r.f1 - 0.5) < 1e-12 and r.error == 0.5 and r.accuracy == 0.5


def test_golden_published_metrics(spark):
    counts = spark.createDataFrame(
        [(tp, tn, fp, fn, tp + tn + fp + fn, fp + fn) for tp, tn, fp, fn, *_ in GOLDEN],
        "tp long, tn long, fp long, fn long, n long, n_mismatch long")
    got = M.prf1(counts).collect()
    for row, (tp, tn, fp, fn, p, r, f) in zip(got, GOLDEN):
        assert (row.tp, row.fn) == (tp, fn)
        assert abs(row.precision - p) < 1e-9
        assert abs(row.recall - r) < 1e-9
        assert abs(row.f1 - f) < 1e-9


def test_no_positive_prediction_gives_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    r = M.binary_metrics(df).first()
    assert r.precision is None and r.f1 is None and r.recall == 0.0


def test_collapsed_and_per_class(spark):
    rows = [(0.0, 0.0), (3.0, 5.0), (3.0, 3.0), (0.0, 2.0), (7.0, 0.0), (2.0, 2.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    c = M.collapsed_metrics(df).first()
    assert (c.tp, c.tn, c.fp, c.fn) == (3, 1, 1, 1)
    assert c.n_mismatch == 3
    per = {r.cls: r for r in M.per_class_metrics(df).collect()}
    assert sum(r.n_actual for r in per.values()) == len(rows)
    assert sum(r.n_predicted for r in per.values()) == len(rows)
    assert per[3.0].tp == 1 and per[3.0].n_actual == 2 and per[3.0].n_predicted == 1
    assert per[2.0].precision == 0.5 and per[2.0].recall == 1.0


def _brute_curve(pairs):
    out = {}
    pos_total = sum(1 for s, y in pairs if y > 0.5)
    for t in {s for s, _ in pairs}:
        tp = sum(1 for s, y in pairs if s >= t and y > 0.5)
        fp = sum(1 for s, y in pairs if s >= t and y <= 0.5)
        p = tp / (tp + fp)
        r = tp / pos_total
        out[t] = (tp, fp, p, r, 2 * p * r / (p + r) if p + r else None)
    return out


def _brute_auc(pairs):
    pos = [s for s, y in pairs if y > 0.5]
    neg = [s for s, y in pairs if y <= 0.5]
    wins = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("n_buckets", [1, 3, 16])
def test_threshold_curve_and_auc_exact(spark, n_buckets):
    rnd = random.Random(7)
    pairs = [(round(rnd.random(), 2), float(rnd.random() < 0.4)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "score double, label double").repartition(5)
    curve = {r.threshold: r for r in M.f_measure_by_threshold(df, "score", n_buckets=n_buckets).collect()}
    brute = _brute_curve(pairs)
    assert set(curve) == set(brute)
    for t, (tp, fp, p, r, f) in brute.items():
        assert (curve[t].tp, curve[t].fp) == (tp, fp)
        assert abs(curve[t].precision - p) < 1e-12 and abs(curve[t].recall - r) < 1e-12
    auc = M.area_under_roc(df, "score", n_buckets=n_buckets).first().auc
    assert abs(auc - _brute_auc(pairs)) < 1e-12
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC").evaluate(df)
    assert abs(auc - ev) < 1e-9
    best = M.best_f_measure(M.f_measure_by_threshold(df, "score")).first()
    bf = max(v[4] for v in brute.values() if v[4] is not None)
    assert abs(best.f_measure - bf) < 1e-12
    summ = M.threshold_summary(df, "score").first()
    assert abs(summ.auc - auc) < 1e-12 and abs(summ.best_f_measure - bf) < 1e-12


def test_running_totals_match_cumsum(spark):
    rnd = random.Random(3)
    keys = rnd.sample(range(10_000), 500)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k long, v long")
    got = {r.k: (r.cum_v, r.total_v) for r in M.running_totals(df, "k", ["v"], n_buckets=6).collect()}
    acc = 0
    total = sum(k % 7 for k in keys)
    for k in sorted(keys):
        acc += k % 7
        assert got[k] == (acc, total)


def test_threshold_table_has_no_unpartitioned_window_over_rows(spark):
    df = spark.range(1000).select((F.col("id") / 1000).alias("score"),
                                  (F.col("id") % 3 == 0).cast("double").alias("label"))
    plan = M.threshold_table(df, "score", n_buckets=8)._jdf.queryExecution().executedPlan().toString()
    # the per-row window is partitioned by bucket; only the bucket table is global
    assert "Window [" in plan and "__b" in plan


def test_metrics_invariant_under_repartition(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(
        (F.col("l_returnflag") != "N").cast("double").alias("label"),
        (F.col("l_discount") > 0.05).cast("double").alias("prediction"))
    a = M.binary_metrics(li).first().asDict()
    b = M.binary_metrics(li.repartition(13)).first().asDict()
    assert a == b
    assert a["tp"] + a["tn"] + a["fp"] + a["fn"] == a["n"]
    assert min(a["precision"], a["recall"]) <= a["f1"] <= max(a["precision"], a["recall"])


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "label double, prediction double, score double")
    r = M.binary_metrics(empty).first()
    assert (r.tp, r.n) == (0, 0) and r.precision is None and r.error is None
    assert M.per_class_metrics(empty).count() == 0
    assert M.f_measure_by_threshold(empty, "score").count() == 0
    assert M.area_under_roc(empty, "score").first().auc is None
