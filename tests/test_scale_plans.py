"""Plan properties that matter at scale, and whole results under a hot key."""

import re

from pyspark.sql import functions as F

from connscore.operators import clusters as C
from connscore.operators import metrics as M
from connscore.operators import profile as PR


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot(spark, n=30_000):
    """One label and one cluster hold a third of all rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("label"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise((F.col("id") % 11).cast("int"))
         .alias("prediction"),
        (F.col("id") % 2).cast("double").alias("y"),
        (F.col("id") % 5).cast("double").alias("p"),
    ).repartition(8)


def test_aggregates_combine_before_the_shuffle(spark):
    df = _hot(spark)
    for out in (PR.label_counts(df, "label"),
                C.cluster_label_counts(df),
                M.per_class_metrics(df, "y", "p"),
                M.confusion_counts(df, "y", "p")):
        plan = _plan(out)
        assert "partial_" in plan, plan
    majority = _plan(C.cluster_majority(df))
    assert majority.index("partial_count") < majority.rindex("Exchange")


def test_hot_key_results_are_whole(spark):
    n = 30_000
    df = _hot(spark, n)
    counts = {r.label: r.n for r in PR.label_counts(df, "label").collect()}
    assert counts["hot"] == n // 3 and sum(counts.values()) == n
    sizes = {r.prediction: r.size for r in C.cluster_sizes(df).collect()}
    assert sum(sizes.values()) == n
    maj = {r.prediction: r.label for r in C.cluster_majority(df).collect()}
    assert maj[0] == "hot"


def test_session_defaults_keep_aqe_and_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.ui.enabled") == "false"


def test_threshold_window_is_per_bucket(spark):
    df = _hot(spark).select(F.col("p").alias("score"), F.col("y").alias("label"))
    plan = _plan(M.threshold_table(df, "score", n_buckets=4))
    # the window over score rows is partitioned by the bucket id; the bucket
    # offsets (one row per bucket) are broadcast back
    assert re.search(r"windowspecdefinition\(knownfloatingpointnormalized\(normalizenanandzero\(__b"
                     r"|windowspecdefinition\(__b", plan), plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
