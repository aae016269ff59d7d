"""Written intermediate tables and their lifetime.

A table written under the shared scratch folder cuts lineage, survives lost
executors and can be read by several branches of a plan.  It has to go again:
``scratch_scope`` removes what was written inside it, ``release_scratch``
whatever of a session is still there (results that are read lazily need their
table until then).  Removal goes through the folder's Hadoop file system, so it works
wherever the cluster keeps its scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from connscore.session import scratch_path

_written: dict[str, list[str]] = {}


def _paths(spark: SparkSession) -> list[str]:
    return _written.setdefault(spark.sparkContext.applicationId, [])


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh scratch path that is removed with its scope or by ``release_scratch``."""
    path = scratch_path(spark, name)
    _paths(spark).append(path)
    return path


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a Parquet table in the scratch folder."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    hadoop = spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(hadoop).delete(place, True)


def release_scratch(spark: SparkSession) -> int:
    """Remove every table that this session has written here; returns how many."""
    paths = _paths(spark)
    _remove(spark, paths)
    removed = len(paths)
    paths.clear()
    return removed


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are removed at the end; only for results that are read inside."""
    paths = _paths(spark)
    before = len(paths)
    try:
        yield
    finally:
        _remove(spark, paths[before:])
        del paths[before:]
