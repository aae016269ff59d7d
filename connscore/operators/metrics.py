"""One-pass evaluation metrics over (label, prediction) or (label, score).

* ``confusion_counts`` -- tp / tn / fp / fn, row count and mismatch count in
  a single aggregate (partial aggregation on every partition, one tiny
  final merge).  ``mode="binary"`` treats exactly 1.0 as positive;
  ``mode="collapsed"`` treats any class >= 1.0 as positive (normal vs not).
* ``prf1`` -- precision, recall, F1, error and accuracy from those counts;
  division by zero gives NULL instead of failing the job.
* ``per_class_metrics`` -- one row per class (micro precision = accuracy).
* ``threshold_table`` -- exact cumulative counts per distinct score, the
  basis of the F-measure-by-threshold curve and of the area under ROC.
  The running sum over a global order is computed without a
  single-partition window: scores are cut into range blocks whose number
  follows the number of distinct scores (``ranking.running_sums``).
* ``ThresholdCurve`` -- one written threshold table for the curve, the best
  F-measure, the area under ROC and the summary, removed when it is closed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connscore.functions.ratios import f_measure, ratio
from connscore.operators.ranking import running_sums
from connscore.sources.scratch import scratch_scope, scratch_table


def _pair_cols(label_col: str, prediction_col: str) -> tuple[Column, Column]:
    return F.col(label_col).cast("double"), F.col(prediction_col).cast("double")


def confusion_counts(df: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction",
                     mode: str = "binary", rows: Column | None = None,
                     extra: Sequence[Column] = (), weight: str | None = None) -> DataFrame:
    """tp, tn, fp, fn, n, n_mismatch of the rows (of those that ``rows`` holds for), beside ``extra`` aggregates.

    With ``weight`` a row stands for so many (a whole number).
    """
    def count_if(condition: Column) -> Column:
        if weight is None:
            return F.count_if(condition)
        return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("long")

    v, p = _pair_cols(label_col, prediction_col)
    if rows is not None:
        v, p = F.when(rows, v), F.when(rows, p)
    if mode == "binary":
        v_pos, p_pos = v == 1.0, p == 1.0
    elif mode == "collapsed":
        v_pos, p_pos = v >= 1.0, p >= 1.0
    else:
        raise ValueError(f"unknown mode {mode!r}")
    v_neg, p_neg = v == 0.0, p == 0.0
    return df.agg(
        count_if(v_pos & p_pos).alias("tp"),
        count_if(v_neg & p_neg).alias("tn"),
        count_if(v_neg & p_pos).alias("fp"),
        count_if(v_pos & p_neg).alias("fn"),
        count_if(F.lit(True) if rows is None else rows).alias("n"),
        # a row without a prediction or label is an error, not a hit
        count_if(~v.eqNullSafe(p)).alias("n_mismatch"),
        *extra,
    )


def prf1(counts: DataFrame) -> DataFrame:
    """Add precision, recall, f1, error, accuracy to a confusion-count row."""
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    error = ratio("n_mismatch", "n")
    return (counts
            .withColumn("precision", precision)
            .withColumn("recall", recall)
            .withColumn("f1", f_measure("precision", "recall"))
            .withColumn("error", error)
            .withColumn("accuracy", F.lit(1.0) - F.col("error")))


def binary_metrics(df: DataFrame, label_col: str = "label",
                   prediction_col: str = "prediction") -> DataFrame:
    return prf1(confusion_counts(df, label_col, prediction_col, "binary"))


def collapsed_metrics(df: DataFrame, label_col: str = "label",
                      prediction_col: str = "prediction", weight: str | None = None) -> DataFrame:
    return prf1(confusion_counts(df, label_col, prediction_col, "collapsed", weight=weight))


def error_rate(df: DataFrame, label_col: str = "label",
               prediction_col: str = "prediction") -> DataFrame:
    v, p = _pair_cols(label_col, prediction_col)
    return (df.agg(F.count(F.lit(1)).alias("n"), F.count_if(~v.eqNullSafe(p)).alias("n_mismatch"))
            .withColumn("error", ratio("n_mismatch", "n"))
            .withColumn("accuracy", F.lit(1.0) - F.col("error")))


def per_class_metrics(df: DataFrame, label_col: str = "label",
                      prediction_col: str = "prediction") -> DataFrame:
    """Per class c: actual / predicted / true-positive counts and P, R, F1.

    Each row emits two tagged entries (its actual class and its predicted
    class); one grouped aggregate then counts both sides.  Hot classes are
    combined map-side before the shuffle.
    """
    v, p = _pair_cols(label_col, prediction_col)
    hit = F.when(v == p, F.lit(1)).otherwise(F.lit(0))
    entries = F.array(
        F.struct(v.alias("cls"), F.lit(1).alias("a"), F.lit(0).alias("p"), hit.alias("h")),
        F.struct(p.alias("cls"), F.lit(0).alias("a"), F.lit(1).alias("p"), F.lit(0).alias("h")),
    )
    g = (df.select(F.inline(entries))
         .groupBy("cls")
         .agg(F.sum("a").cast("long").alias("n_actual"),
              F.sum("p").cast("long").alias("n_predicted"),
              F.sum("h").cast("long").alias("tp")))
    return (g.withColumn("precision", ratio("tp", "n_predicted"))
             .withColumn("recall", ratio("tp", "n_actual"))
             .withColumn("f1", f_measure("precision", "recall")))


def running_totals(df: DataFrame, key: str, value_cols: Sequence[str],
                   descending: bool = False, n_buckets: int | None = None) -> DataFrame:
    """Exact inclusive running sums of ``value_cols`` in the order of ``key``.

    ``df`` must hold one row per distinct key.  Adds ``cum_<v>`` (sum over
    rows at or before this key) and ``total_<v>`` (grand total).  The number of
    range blocks follows the number of rows unless ``n_buckets`` sets it.
    """
    order = F.col(key).desc() if descending else F.col(key).asc()
    return running_sums(df, [order], value_cols, n_buckets)


def threshold_table(df: DataFrame, score_col: str, label_col: str = "label",
                    n_buckets: int | None = None) -> DataFrame:
    """Per distinct score t: pos/neg at t and cumulative counts for score >= t.

    A row is positive when its label > 0.5.  Scores are first reduced to one
    row per distinct value (partial aggregation), so repeated scores never
    form a hot group downstream; that table is written once.
    """
    lab = F.col(label_col).cast("double")
    # rows without a score take no part in the curve or its totals
    g = (df.filter(F.col(score_col).isNotNull())
         .groupBy(F.col(score_col).cast("double").alias("threshold"))
         .agg(F.count_if(lab > 0.5).alias("pos"), F.count_if(lab <= 0.5).alias("neg")))
    return running_totals(g, "threshold", ["pos", "neg"], descending=True, n_buckets=n_buckets)


def _curve(t: DataFrame) -> DataFrame:
    precision = ratio("cum_pos", F.col("cum_pos") + F.col("cum_neg"))
    recall = ratio("cum_pos", "total_pos")
    return t.select(
        "threshold",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        precision.alias("precision"),
        recall.alias("recall"),
    ).withColumn("f_measure", f_measure("precision", "recall"))


def _summary(t: DataFrame) -> DataFrame:
    """n_pos, n_neg, auc, best_threshold, best_f_measure of a threshold table, one row.

    AUC = sum over scores s of pos(s) * (negatives below s + neg(s)/2) / (P*N),
    with negatives below s = N - (negatives at or above s); ties count one half.
    """
    f = f_measure(ratio("cum_pos", F.col("cum_pos") + F.col("cum_neg")), ratio("cum_pos", "total_pos"))
    below = F.col("total_neg") - F.col("cum_neg")
    contrib = F.col("pos").cast("double") * (below + F.col("neg") / F.lit(2.0))
    agg = t.agg(F.sum(contrib).alias("s"), F.max("total_pos").alias("n_pos"),
                F.max("total_neg").alias("n_neg"),
                F.max(F.struct(f.alias("f_measure"), F.col("threshold"))).alias("best"))
    return agg.select(
        F.col("n_pos").cast("long").alias("n_pos"),
        F.col("n_neg").cast("long").alias("n_neg"),
        F.try_divide(F.col("s"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"),
        F.col("best.threshold").alias("best_threshold"),
        F.col("best.f_measure").alias("best_f_measure"),
    )


class ThresholdCurve:
    """One threshold table, written once, for every figure that is read from it.

    ``with ThresholdCurve(df, "score") as c: c.curve(); c.best(); c.auc(); c.summary()``.
    Leaving the block removes all tables that it has written, so rows of ``curve``
    have to be read inside; the one-row results hold their values and stay.
    ``n_unscored`` rows have no score and take no part.
    """

    def __init__(self, df: DataFrame, score_col: str, label_col: str = "label", n_buckets: int | None = None):
        self._df, self._args = df, (score_col, label_col, n_buckets)
        self._scope = scratch_scope(df.sparkSession)

    def __enter__(self) -> "ThresholdCurve":
        self._scope.__enter__()
        self.table = scratch_table(threshold_table(self._df, *self._args), "thresholds")
        return self

    def __exit__(self, *error) -> None:
        self._scope.__exit__(*error)

    def _held(self, one_row: DataFrame) -> DataFrame:
        return one_row.sparkSession.createDataFrame(one_row.collect(), one_row.schema)

    def curve(self) -> DataFrame:
        return _curve(self.table)

    def best(self) -> DataFrame:
        return self._held(best_f_measure(self.curve()))

    def summary(self) -> DataFrame:
        unscored = self._df.filter(F.col(self._args[0]).isNull()).count()
        return self._held(_summary(self.table).withColumn("n_unscored", F.lit(unscored).cast("long")))

    def auc(self) -> DataFrame:
        return self._held(_summary(self.table).select("n_pos", "n_neg", "auc"))


def f_measure_by_threshold(df: DataFrame, score_col: str, label_col: str = "label",
                           n_buckets: int | None = None) -> DataFrame:
    """The whole curve; its table stays until ``release_scratch``, as the rows are read later."""
    return _curve(threshold_table(df, score_col, label_col, n_buckets))


def best_f_measure(curve: DataFrame) -> DataFrame:
    """Largest F-measure and its threshold (ties -> larger threshold)."""
    best = curve.agg(F.max(F.struct("f_measure", "threshold")).alias("b"))
    return best.select(F.col("b.threshold").alias("threshold"),
                       F.col("b.f_measure").alias("f_measure"))


def best_threshold(df: DataFrame, score_col: str, label_col: str = "label") -> DataFrame:
    """(threshold, f_measure) of the largest F-measure, one row; leaves no table behind."""
    with ThresholdCurve(df, score_col, label_col) as c:
        return c.best()


def area_under_roc(df: DataFrame, score_col: str, label_col: str = "label",
                   n_buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve (ties count one half), one row; leaves no table behind."""
    with ThresholdCurve(df, score_col, label_col, n_buckets) as c:
        return c.auc()


def area_under_roc_by(df: DataFrame, group: str, score_col: str, label_col: str = "label") -> DataFrame:
    """(group, n_pos, n_neg, auc): the exact area under the curve of every group, in one pass for all.

    The running sums go over all groups in order; what a group's own sums lack
    is the negatives of its own before, so the sum up to its first score is taken off.
    """
    lab = F.col(label_col).cast("double")
    with scratch_scope(df.sparkSession):
        g = (df.filter(F.col(score_col).isNotNull()).groupBy(group, F.col(score_col).cast("double").alias("threshold"))
             .agg(F.count_if(lab > 0.5).alias("pos"), F.count_if(lab <= 0.5).alias("neg")))
        t = running_sums(g, [F.col(group).asc_nulls_first(), F.col("threshold").desc()], ["neg"])
        # sum of pos * (negatives of the group at or above, less half of those that tie)
        sums = t.groupBy(group).agg(
            F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / F.lit(2.0))).alias("above"),
            F.min(F.col("cum_neg") - F.col("neg")).alias("before"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
        wrong = F.col("above") - F.col("n_pos").cast("double") * F.col("before")
        out = sums.select(group, F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"),
                          (F.lit(1.0) - F.try_divide(wrong, F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc"))
        return df.sparkSession.createDataFrame(out.collect(), out.schema)    # one row a group


def threshold_summary(df: DataFrame, score_col: str, label_col: str = "label",
                      n_buckets: int | None = None) -> DataFrame:
    """AUC, best F-measure threshold and rows without a score from one threshold table, one row."""
    with ThresholdCurve(df, score_col, label_col, n_buckets) as c:
        return c.summary()
