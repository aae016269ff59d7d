"""Row identity, written intermediate tables and distributed numbering."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from connscore.session import scratch_path

#: One run of the white space that separates words.
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Rows under which a counted side may be broadcast; larger sides are shuffled.
BROADCAST_ROWS = 1_000_000

#: Columns that say where a row lies.
FILE, ROW = "__llm_file", "__llm_row"

#: Rows of one numbering bucket.
NUMBERING_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def located(df: DataFrame, name: str = "located") -> DataFrame:
    """``df`` with the place of each row: hash of its file, row index in it.

    A frame that does not come straight from files is written first, so the
    place stays the same however often the rows are read.
    """
    place = [F.xxhash64("_metadata.file_path").alias(FILE),
             F.col("_metadata.row_index").alias(ROW)]
    try:
        return df.select("*", *place)
    except AnalysisException:
        return written(df, name).select("*", *place)


def plain_names(docs: DataFrame, read: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` under names that no operator uses, but for the columns ``read``, and what gives the names back.

    Whatever other columns are called (names of an operator's own columns, names
    with dots, names that differ in case alone), they come through unchanged.
    """
    inner = [c if c in read else f"__llm_column_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*inner), lambda rows: rows.select(*inner).toDF(*docs.columns)


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to be small, else as it is (shuffle join)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; a null counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(modulus)


def numbered(df: DataFrame, group: list[str], order: list[str], out: str,
             rows: int | None = None) -> DataFrame:
    """``df`` with gapless numbers from 0 within each ``group``, no group in one task.

    Rows are dealt into hash buckets that grow in number with the table, each
    (group, bucket) is numbered by itself, and the bucket sizes give the start.
    ``df`` must give the same rows whenever it is read (a written table).
    """
    rows = df.count() if rows is None else rows
    buckets = max(1, math.ceil(rows / NUMBERING_ROWS))
    dealt = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(*group, "__b").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)], F.col("__b").alias("__gb"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(*group, "__b").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    same = F.col("__b") == F.col("__gb")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    return (dealt.withColumn("__rn", F.row_number().over(within) - 1)
            .join(sized_broadcast(starts), same)
            .withColumn(out, (F.col("__rn") + F.col("__start")).cast("long"))
            .drop("__b", "__gb", "__start", "__rn", *[f"__g{i}" for i in range(len(group))]))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
