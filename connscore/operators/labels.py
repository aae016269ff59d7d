"""Label and category coding operators.

* ``with_binary_label``   -- 0.0 normal / 1.0 attack by substring token.
* ``with_class_index``    -- cleaned label's position in a class list;
  unknown labels get the list length (always a double).
* ``category_indexer``    -- a ``StringIndexerModel`` built from a fixed
  vocabulary (``handleInvalid="keep"``: unknown -> vocabulary length).  Its
  output carries nominal ML metadata, so trees treat the slot as categorical
  with arity len(vocabulary) + 1.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connscore.functions.labels import binary_label, clean_label, vocabulary_index


def with_binary_label(df: DataFrame, label_col: str, normal_token: str = "normal",
                      out_col: str = "label") -> DataFrame:
    return df.withColumn(out_col, binary_label(label_col, normal_token))


def with_clean_label(df: DataFrame, label_col: str, strip_chars: str = ".",
                     out_col: str | None = None) -> DataFrame:
    return df.withColumn(out_col or label_col, clean_label(label_col, strip_chars))


def with_class_index(df: DataFrame, label_col: str, classes: Sequence[str],
                     strip_chars: str = ".", out_col: str = "label") -> DataFrame:
    cleaned = clean_label(label_col, strip_chars) if strip_chars else F.col(label_col)
    return df.withColumn(out_col, vocabulary_index(cleaned, classes))


def category_indexer(input_col: str, vocabulary: Sequence[str],
                     output_col: str | None = None) -> StringIndexerModel:
    return StringIndexerModel.from_labels(
        list(vocabulary), inputCol=input_col, outputCol=output_col or f"{input_col}_idx",
        handleInvalid="keep")


def category_indexers(vocabularies: Mapping[str, Sequence[str]],
                      suffix: str = "_idx") -> list[StringIndexerModel]:
    return [category_indexer(c, v, f"{c}{suffix}") for c, v in vocabularies.items()]


def index_categories(df: DataFrame, vocabularies: Mapping[str, Sequence[str]],
                     suffix: str = "_idx") -> DataFrame:
    """Index-code every category column by its fixed vocabulary."""
    return PipelineModel(stages=category_indexers(vocabularies, suffix)).transform(df)
