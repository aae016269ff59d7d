"""Null-safe ratios for metric formulas (division by zero gives NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column | str, den: Column | str) -> Column:
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def f_measure(precision: Column | str, recall: Column | str) -> Column:
    p = F.col(precision) if isinstance(precision, str) else precision
    r = F.col(recall) if isinstance(recall, str) else recall
    return F.try_divide(F.lit(2.0) * p * r, p + r)
