"""Ranks, vocabularies, frequency indexes and running sums without a one-task step; lifetime of written tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

from connscore.operators import metrics as M
from connscore.operators import profile as PR
from connscore.operators.ranking import ranked, running_sums, sorted_blocks
from connscore.session import checkpoint_root
from connscore.sources.scratch import _paths, release_scratch, scratch_scope, scratch_table


def files_left(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    return {p for p in _paths(spark) if os.path.exists(p.removeprefix("file:"))}, root


@pytest.mark.parametrize("blocks", [1, 3, 7])
def test_ranks_equal_a_sorted_list(spark, blocks):
    random.seed(blocks)
    rows = list({(random.choice(["a", "b", None, "c"]), random.randrange(200)) for _ in range(400)}) + [("d", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = {(r.g, r.v): r.place for r in
           ranked(df, ["g"], [F.col("v").asc_nulls_last()], "place", blocks).collect()}
    for g in {g for g, _ in rows}:
        mine = sorted((v for h, v in rows if h == g), key=lambda v: (v is None, v))
        assert [got[g, v] for v in mine] == list(range(len(mine)))


@pytest.mark.parametrize("blocks", [1, 4])
def test_running_sums_equal_a_loop(spark, blocks):
    rows = [(k * 7 % 101, k % 5) for k in range(101)]
    out = running_sums(spark.createDataFrame(rows, "k int, v long"), [F.col("k").desc()], ["v"], blocks)
    total = 0
    for r in sorted(out.collect(), key=lambda r: -r.k):
        total += r.v
        assert r.cum_v == total and r.total_v == sum(v for _, v in rows)
    assert running_sums(spark.createDataFrame([], "k int, v long"), [F.col("k")], ["v"]).count() == 0


def test_a_million_values_of_one_column_meet_in_no_task(spark):
    n = 1_000_000
    values = spark.range(n).select(F.lit("c").alias("column_name"), F.hex("id").alias("value"))
    with scratch_scope(spark):
        blocks = sorted_blocks(values, [F.col("column_name"), F.col("value")])
        sizes = [r["count"] for r in blocks.groupBy("__b").count().collect()]
        assert len(sizes) == 20 and max(sizes) < 100_000 and sum(sizes) == n
        vocabulary = PR.category_vocabulary(spark.range(n).select(F.hex("id").alias("x")), ["x"])
        plan = vocabulary._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan.split("BroadcastExchange")[0]      # only the block table has one
        assert "collect_list" not in plan and "SinglePartition" not in plan
        got = vocabulary.agg(F.count_distinct("value_idx").alias("n"), F.min("value_idx").alias("low"),
                             F.max("value_idx").alias("high")).first()
        assert tuple(got) == (n, 0, n - 1)
        listing = PR.vocabulary_listing(vocabulary)
        assert listing.agg(F.max("n_values"), F.sum("n_values")).first()[:] == (10_000, n)


def test_vocabulary_is_written_in_order(spark, tmp_path):
    df = spark.createDataFrame([(str(i % 50), f"v{i:03d}") for i in range(300)] + [(None, None)], "a string, b string")
    vocabulary = PR.category_vocabulary(df, ["a", "b"], block_rows=40)
    path = PR.write_vocabulary(vocabulary, str(tmp_path / "vocabulary"))
    for c, want in (("a", sorted(str(i) for i in range(50))), ("b", [f"v{i:03d}" for i in range(300)])):
        folder = f"{path}/column_name={c}"
        lines = [x for f in sorted(os.listdir(folder)) if f.startswith("part-")
                 for x in open(os.path.join(folder, f)).read().splitlines()]
        assert lines == want


def test_cardinality_with_nulls_and_empty_values(spark):
    df = spark.createDataFrame([("", "x"), (None, "y"), ("a", None)], "a string, b string")
    got = {r.column_name: (r.n_values, r.values_joined) for r in PR.category_cardinality(df, ["a", "b"]).collect()}
    assert got == {"a": (3, '","a'), "b": (3, 'x","y')}


@pytest.mark.parametrize("frequent", [1, 3, 1000])
def test_frequency_index_ties_nulls_and_rare_labels(spark, frequent):
    labels = ["hot"] * 50 + ["b"] * 3 + ["a"] * 3 + ["z"] + [None] * 4 + ["y"]
    df = spark.createDataFrame(list(enumerate(labels)), "id int, `my.label` string").withColumnRenamed("my.label", "label")
    out = PR.label_index_by_frequency(df, "label", "idx", frequent)
    got = {(r.label, r.idx) for r in out.collect()}
    assert got == {("hot", 0.0), ("a", 1.0), ("b", 2.0), ("y", 3.0), ("z", 4.0), (None, 5.0)}
    assert out.count() == len(labels) and out.columns == ["id", "label", "idx"]


def test_frequency_index_equals_the_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "event_type")
    theirs = StringIndexer(inputCol="event_type", outputCol="i", stringOrderType="frequencyDesc").fit(df).transform(df)
    ours = PR.label_index_by_frequency(df, "event_type", "i")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_curve_tables_are_removed(spark):
    release_scratch(spark)
    df = spark.createDataFrame([(i / 100, float(i % 3 == 0)) for i in range(500)] + [(None, 1.0)], "score double, label double")
    auc, best, whole = M.area_under_roc(df, "score"), M.best_threshold(df, "score"), M.threshold_summary(df, "score")
    assert files_left(spark)[0] == set()
    assert auc.first()["auc"] == whole.first()["auc"] and whole.first()["n_unscored"] == 1
    assert best.first()["f_measure"] == whole.first()["best_f_measure"]
    with M.ThresholdCurve(df, "score") as c:
        assert c.curve().count() == 500 and files_left(spark)[0]
    assert files_left(spark)[0] == set()
    curve = M.f_measure_by_threshold(df, "score", n_buckets=3)
    assert curve.count() == 500
    assert release_scratch(spark) > 0 and files_left(spark)[0] == set()


def test_scopes_remove_their_own_tables_only(spark):
    release_scratch(spark)
    outer = scratch_table(spark.range(3), "outer")
    with pytest.raises(ValueError):
        with scratch_scope(spark):
            scratch_table(spark.range(5), "inner")
            raise ValueError
    assert len(files_left(spark)[0]) == 1 and outer.count() == 3
    release_scratch(spark)


def test_auc_of_groups_equals_each_alone(spark):
    random.seed(3)
    rows = [(g, round(random.random(), 2), float(random.random() < 0.4)) for g in ("a", "b", "c") for _ in range(200)]
    rows += [("ties", 0.5, float(i % 2)) for i in range(20)] + [("one", 0.1, 1.0)]
    df = spark.createDataFrame(rows, "g string, score double, label double")
    got = {r.g: (r.n_pos, r.n_neg, r.auc) for r in M.area_under_roc_by(df, "g", "score").collect()}
    for g in ("a", "b", "c", "ties"):
        want = M.area_under_roc(df.filter(F.col("g") == g), "score").first()
        assert got[g][:2] == want[:2] and got[g][2] == pytest.approx(want["auc"], abs=1e-12)
    assert got["ties"][2] == 0.5 and got["one"] == (1, 0, None)
