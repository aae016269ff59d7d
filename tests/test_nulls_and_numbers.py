"""Rows without score, prediction or label, and numbers that are not plain."""

import pytest

from connscore.operators import metrics as M
from connscore.sources.records import parse_lines
from conftest import LINE_A


def test_rows_without_prediction_or_label_are_errors(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0), (1.0, None), (None, 0.0)], "label double, prediction double")
    row = M.error_rate(df).first()
    assert (row["n"], row["n_mismatch"], row["error"], row["accuracy"]) == (4, 2, 0.5, 0.5)
    assert M.binary_metrics(df).first()["error"] == 0.5


def test_rows_without_score_stay_out_of_the_curve(spark):
    rows = [(0.9, 1.0), (0.8, 1.0), (0.2, 0.0), (0.1, 0.0), (None, 0.0), (None, 0.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    assert M.area_under_roc(df, "score").first()["auc"] == pytest.approx(1.0)


@pytest.mark.parametrize("number, bad", [("8d", True), ("1f", True), ("NaN", True), ("Infinity", True), ("1e999", True),
                                         ("-2.5e3", False), (".5", False), ("7.", False)])
def test_numbers(spark, number, bad):
    line = number + LINE_A[LINE_A.index(","):]
    df = spark.createDataFrame([(line,)], "value string")
    assert parse_lines(df).first()["malformed"] is bad
