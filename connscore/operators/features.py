"""Feature operators: projection, vector assembly, scaling, vector indexing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def numeric_projection(df: DataFrame, numeric_cols: Sequence[str],
                       keep: Sequence[str] = ()) -> DataFrame:
    """Keep the numeric feature columns (as double) and drop the rest."""
    return df.select(*keep, *[F.col(c).try_cast("double").alias(c) for c in numeric_cols])


def assembler(cols: Sequence[str], out_col: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out_col,
                           handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols: Sequence[str], out_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return assembler(cols, out_col, handle_invalid).transform(df)


def with_vector(df: DataFrame, array_col: str, out_col: str = "features") -> DataFrame:
    """array<float|double> column -> ML dense vector column."""
    return df.withColumn(out_col, array_to_vector(F.col(array_col).cast("array<double>")))


def vector_columns(df: DataFrame, vec_col: str, names: Sequence[str],
                   keep: Sequence[str] = ()) -> DataFrame:
    arr = vector_to_array(F.col(vec_col))
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])


def scaler(in_col: str = "raw_features", out_col: str = "features") -> StandardScaler:
    """Centre and scale to unit sample standard deviation."""
    return StandardScaler(inputCol=in_col, outputCol=out_col, withMean=True, withStd=True)


def fit_scaler(df: DataFrame, cols: Sequence[str], out_col: str = "features") -> PipelineModel:
    stages = [assembler(cols, "raw_features"), scaler("raw_features", out_col)]
    return Pipeline(stages=stages).fit(df)


def scaler_moments(spark: SparkSession, model: PipelineModel,
                   names: Sequence[str]) -> DataFrame:
    """(feature, mean, std) of the fitted scaler: one row per feature.

    The moments are the fitted model's parameters (d numbers, computed by a
    distributed tree aggregation during ``fit``).
    """
    sm = model.stages[-1]
    rows = [(n, float(m), float(s)) for n, m, s in zip(names, sm.mean.toArray(), sm.std.toArray())]
    return spark.createDataFrame(rows, "feature string, mean double, std double")


def vector_index(df: DataFrame, cols: Sequence[str], max_categories: int = 10,
                 out_col: str = "indexed") -> DataFrame:
    """VectorIndexer: slots with <= max_categories distinct values -> codes."""
    assembled = assemble(df, cols, "__vi_in")
    model = VectorIndexer(inputCol="__vi_in", outputCol=out_col,
                          maxCategories=max_categories, handleInvalid="keep").fit(assembled)
    return model.transform(assembled).drop("__vi_in")
