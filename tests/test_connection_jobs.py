"""All five jobs end to end on the 42-field connection format (files on disk)."""

import pytest

from conftest import LINE_A, LINE_B
from connscore.plans import jobs
from connscore.plans.roles import CONNECTION_ROLES
from connscore.session import scratch_path
from connscore.sources.records import quarantined, read_records, well_formed


def _variant(line: str, i: int, label: str | None = None) -> str:
    f = line.split(",")
    f[4] = str(100 + 7 * i)          # src_bytes
    f[22] = str(1 + i % 9)           # count
    if label:
        f[41] = label
    return ",".join(f)


@pytest.fixture(scope="module")
def conn_path(tmp_path_factory):
    rows = []
    # > 67 rows: MLlib caps maxBins at the row count, and `service` has arity 67
    for i in range(40):
        rows.append(_variant(LINE_A, i))
        rows.append(_variant(LINE_B, i))
    rows += [_variant(LINE_B, 1, "smurf."), _variant(LINE_A, 2, "newattack.")]
    rows.append(LINE_A.replace(",212,", ",2x12,"))      # bad number
    rows.append(",".join(LINE_A.split(",")[:-2]))       # short row
    p = tmp_path_factory.mktemp("conn") / "connections.log"
    p.write_text("\n".join(rows) + "\n")
    return str(p)


def test_statistics_and_quarantine(spark, conn_path):
    recs = read_records(spark, conn_path)
    assert quarantined(recs).count() == 2
    good = well_formed(recs)
    counts = {r.label: r.n for r in jobs.statistics(good, CONNECTION_ROLES).collect()}
    assert counts == {"normal.": 40, "neptune.": 40, "smurf.": 1, "newattack.": 1}
    card = {r.column_name: r.n_values for r in
            jobs.categorical_values(good, CONNECTION_ROLES).collect()}
    assert card == {"protocol_type": 2, "service": 2, "flag": 1}


def test_logistic_jobs(spark, conn_path):
    good = well_formed(read_records(spark, conn_path))
    path = scratch_path(spark, "conn-lr")
    model = jobs.logreg_binary_train(good, CONNECTION_ROLES, path, max_iter=10)
    r = jobs.logreg_binary_test(spark, good, CONNECTION_ROLES, path).first()
    assert r.n == 82 and r.tp + r.tn + r.fp + r.fn == 82
    # only the "newattack." row (normal-shaped features, attack label) can be wrong
    assert r.fp + r.fn <= 1
    s = jobs.training_summary(model, good, CONNECTION_ROLES).first()
    assert s.n_pos == 42 and s.n_neg == 40 and s.auc > 0.9
    jobs.logreg_multiclass_train(good, CONNECTION_ROLES, scratch_path(spark, "c-ovr"), max_iter=5)


def test_tree_jobs(spark, conn_path):
    good = well_formed(read_records(spark, conn_path))
    path = scratch_path(spark, "conn-tree")
    model = jobs.tree_train(good, CONNECTION_ROLES, path, "binary", 4)
    assert model.stages[-1].numFeatures == 41
    r = jobs.tree_test(spark, good, CONNECTION_ROLES, path).first()
    assert r.fp + r.fn <= 1
    mc_path = scratch_path(spark, "conn-mc")
    mc = jobs.tree_train(good, CONNECTION_ROLES, mc_path, "multiClass", 4)
    assert mc.stages[-1].numClasses == 24    # 23 classes + unknown
    r = jobs.tree_test(spark, good, CONNECTION_ROLES, mc_path, "multiClass").first()
    assert r.n == 82


def test_kmeans_jobs(spark, conn_path):
    good = well_formed(read_records(spark, conn_path))
    mp, dp = scratch_path(spark, "conn-km"), scratch_path(spark, "conn-dict")
    sweep = jobs.kmeans_train(spark, good, CONNECTION_ROLES, mp, dp, min_k=2, max_k=2)
    assert sweep.count() == 1
    r = jobs.kmeans_test(spark, good, CONNECTION_ROLES, mp, dp).first()
    assert r.n == 82
    assert r.tp + r.tn + r.fp + r.fn == 82


def test_statistics_from_raw_lines(spark, conn_path):
    counts = {r.label: r.n for r in jobs.statistics_from_lines(spark, conn_path).collect()}
    # raw-line statistics count every line, malformed ones included
    assert counts["normal."] == 41 and counts["neptune."] == 40
    assert sum(counts.values()) == 84


def test_multiclass_per_class_metrics(spark, conn_path):
    good = well_formed(read_records(spark, conn_path))
    path = scratch_path(spark, "conn-mc-per-class")
    jobs.tree_train(good, CONNECTION_ROLES, path, "multiClass", 4)
    per = {r.cls: r for r in jobs.multiclass_per_class_test(spark, good, CONNECTION_ROLES,
                                                            path).collect()}
    # classes: normal 0, neptune 10, smurf 18, unknown 23
    assert per[0.0].n_actual == 40 and per[10.0].n_actual == 40
    assert per[18.0].n_actual == 1 and per[23.0].n_actual == 1
    assert sum(r.n_predicted for r in per.values()) == 82
