"""Column-expression helpers (all built-in, JVM-side)."""

from connscore.functions.labels import binary_label, clean_label, vocabulary_index
from connscore.functions.vectors import (
    argmax_index, linear_margin, sigmoid, squared_distance, nearest_center_struct,
)
from connscore.functions.ratios import f_measure, ratio

__all__ = [
    "binary_label", "clean_label", "vocabulary_index",
    "argmax_index", "linear_margin", "sigmoid", "squared_distance",
    "nearest_center_struct", "f_measure", "ratio",
]
