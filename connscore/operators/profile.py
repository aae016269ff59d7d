"""Profiling: label frequencies, category vocabularies, frequency indexing.

All results stay distributed DataFrames; nothing is printed or collected.  A
column may have any number of distinct values: they are ranked over range
blocks (``ranking``), listed block by block and joined back by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connscore.operators.ranking import BLOCK_ROWS, ranked
from connscore.sources.scratch import scratch_scope, scratch_table

#: Most frequent labels that are broadcast to the rows; the rest is joined by a shuffle.
FREQUENT_LABELS = 1_000

#: Values of a vocabulary that make one row of a listing.
LISTED_VALUES = 10_000


def label_counts(df: DataFrame, label_col: str, trim: bool = True,
                 out_label: str = "label", out_count: str = "n") -> DataFrame:
    """Count per label, highest count first (ties by label).

    The label is whitespace-trimmed but otherwise kept as is (a trailing
    dot stays).  groupBy combines map-side, so a label holding a third of
    all rows costs one partial-aggregate row per partition.
    """
    lab = F.trim(F.col(label_col)) if trim else F.col(label_col)
    return (df.groupBy(lab.alias(out_label))
            .agg(F.count(F.lit(1)).alias(out_count))
            .orderBy(F.col(out_count).desc(), F.col(out_label).asc()))


# ASCII whitespace, as stripped by the source format's line handling
_WHITESPACE = " \t\n\r\x0b\x0c"


def label_counts_from_lines(lines: DataFrame, line_col: str = "value", sep: str = ",",
                            out_label: str = "label", out_count: str = "n") -> DataFrame:
    """Label frequency straight from raw lines: the text after the last
    separator of the whitespace-stripped line, highest count first.

    Only the label is extracted (``substring_index``, no split array, no
    record parse), so the statistics pass over a large log touches nothing
    else; malformed lines are counted like the others.
    """
    line = F.btrim(F.col(line_col), F.lit(_WHITESPACE))
    lab = F.substring_index(line, sep, -1)
    return (lines.groupBy(lab.alias(out_label))
            .agg(F.count(F.lit(1)).alias(out_count))
            .orderBy(F.col(out_count).desc(), F.col(out_label).asc()))


def top_labels(df: DataFrame, label_col: str, n: int = 3, trim: bool = True) -> DataFrame:
    """The ``n`` most frequent labels (a top-k report: the limit is the feature)."""
    return label_counts(df, label_col, trim).limit(n)


def _distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value) for every distinct value of every column, one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.inline(pairs)).distinct()


def category_vocabulary(df: DataFrame, cols: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(column_name, value, value_idx): each column's sorted vocabulary, a null last.

    One scan for all columns; distinct is combined map-side, and the distinct
    values are ranked over range blocks, so no task holds a column.
    """
    return ranked(_distinct_values(df, cols), ["column_name"], [F.col("value").asc_nulls_last()], "value_idx",
                  block_rows=block_rows)


def vocabulary_listing(vocabulary: DataFrame, sep: str = '","', values: int = LISTED_VALUES) -> DataFrame:
    """(column_name, block, n_values, n_listed, values_joined): a vocabulary in order, ``values`` of them a row.

    The blocks of a column joined by ``sep`` in the order of ``block`` are its listing.
    A null is counted, not listed; a block of nothing but null lists nothing.
    """
    block = F.floor(F.col("value_idx") / values).cast("long")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("value_idx", "value"))), lambda x: x["value"])
    return (vocabulary.groupBy("column_name", block.alias("block"))
            .agg(F.count("*").alias("n_values"), F.count("value").alias("n_listed"),
                 F.array_join(listed, sep).alias("values_joined")))


def write_vocabulary(vocabulary: DataFrame, path: str) -> str:
    """The values as text, one a line, in a folder for each column; files and lines in the vocabulary's order.

    Range blocks of (column, place) are written by as many tasks; nothing is gathered.
    """
    blocks = max(1, -(-vocabulary.count() // BLOCK_ROWS))
    (vocabulary.filter("value is not null")
     .repartitionByRange(blocks, "column_name", "value_idx").sortWithinPartitions("column_name", "value_idx")
     .select("column_name", "value").write.mode("overwrite").partitionBy("column_name").text(path))
    return path


def category_cardinality(df: DataFrame, cols: Sequence[str], sep: str = '","') -> DataFrame:
    """(column_name, n_values, values_joined): vocabulary size and listing.

    A column's listing is one string by definition; it is put together from
    the blocks of ``vocabulary_listing``.  Use those, or ``write_vocabulary``, where a column may be
    too large for that.
    """
    blocks = vocabulary_listing(category_vocabulary(df, cols), sep)
    text = F.when(F.col("n_listed") > 0, F.struct("block", "values_joined"))
    whole = F.transform(F.array_sort(F.collect_list(text)), lambda b: b["values_joined"])
    return blocks.groupBy("column_name").agg(F.sum("n_values").cast("long").alias("n_values"),
                                             F.array_join(whole, sep).alias("values_joined"))


def learned_vocabularies(df: DataFrame, cols: Sequence[str],
                         max_values: int = 100_000) -> dict[str, list[str]]:
    """Sorted vocabulary of each category column, learned from the data.

    The distinct values are found in one scan and written; a column with more
    than ``max_values`` of them is refused (it is not a category: an index
    coding in the plan would not hold it) instead of being truncated.
    """
    spark = df.sparkSession
    with scratch_scope(spark):
        distinct = scratch_table(_distinct_values(df, cols).filter("value is not null"), "vocabulary")
        sizes = {r["column_name"]: r["n"] for r in
                 distinct.groupBy("column_name").agg(F.count("*").alias("n")).collect()}
        too_big = {c: n for c, n in sizes.items() if n > max_values}
        if too_big:
            raise ValueError(f"not category columns (over {max_values} values): {too_big}")
        out: dict[str, list[str]] = {c: [] for c in cols}
        for r in distinct.orderBy("column_name", "value").collect():
            out[r["column_name"]].append(r["value"])
    return out


def label_frequency_index(df: DataFrame, label_col: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(label, n, label_idx): labels by descending frequency, ties by label, from 0."""
    counts = (df.filter(F.col(label_col).isNotNull()).groupBy(F.col(label_col).cast("string").alias("label"))
              .agg(F.count("*").alias("n")))
    return ranked(counts, [], [F.col("n").desc(), F.col("label").asc()], "label_idx", block_rows=block_rows)


def label_index_by_frequency(df: DataFrame, label_col: str, out_col: str = "label_idx",
                             frequent: int = FREQUENT_LABELS) -> DataFrame:
    """``df`` with each label's index (double) by descending frequency, ties alphabetical.

    A null label gets the number of labels.  The index is a table: its
    ``frequent`` first labels, which hold the hot keys, are broadcast, the others
    (if there are more) are joined by a shuffle.  No value comes to the driver.
    """
    index = scratch_table(label_frequency_index(df, label_col), "label-index")
    labels = index.count()
    key = F.col(label_col).cast("string")
    head = index.filter(F.col("label_idx") < frequent).select(
        F.col("label").alias("__label"), F.col("label_idx").alias("__idx"))
    out = df.join(F.broadcast(head), key == F.col("__label"), "left")
    found = F.col("__idx")
    if labels > frequent:
        tail = index.filter(F.col("label_idx") >= frequent).select(
            F.col("label").alias("__rare"), F.col("label_idx").alias("__rare_idx"))
        # rows that are done, and nulls, are dealt evenly instead of meeting under one key
        salt = F.concat(F.lit("\u0000"), F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("string"))
        out = out.withColumn("__key", F.when(found.isNull() & key.isNotNull(), key).otherwise(salt))
        out = out.join(tail, F.col("__key") == F.col("__rare"), "left")
        found = F.coalesce("__idx", "__rare_idx")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      F.coalesce(found.cast("double"), F.lit(float(labels))).alias(out_col))
