"""Cluster dictionary sink and source: CSV with header, declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_cluster_dict(df: DataFrame, path: str) -> str:
    (df.write.mode("overwrite").option("header", True).csv(path))
    return path


def read_cluster_dict(spark: SparkSession, path: str,
                      schema: str = "prediction INT, label DOUBLE") -> DataFrame:
    """Read back with a declared schema: no inference pass over the files."""
    return spark.read.schema(schema).option("header", True).csv(path)


def checked_cluster_dict(dictionary: DataFrame, k: int) -> DataFrame:
    """The dictionary if it fits a model of ``k`` clusters, else a ValueError that says why.

    Every id is a cluster of the model and has one row, so the dictionary has
    at most ``k`` rows and a join with it keeps the number of rows.  One aggregate.
    """
    found = dictionary.agg(
        F.count("*").alias("rows"), F.count_distinct("prediction").alias("ids"),
        F.count_if(F.col("prediction").isNull() | (F.col("prediction") < 0) | (F.col("prediction") >= k)).alias("strange"),
    ).first()
    if found["strange"]:
        raise ValueError(f"{found['strange']} rows of the cluster dictionary name no cluster of the model (0 to {k - 1})")
    if found["rows"] != found["ids"]:
        raise ValueError(f"the cluster dictionary has {found['rows']} rows for {found['ids']} clusters")
    return dictionary
