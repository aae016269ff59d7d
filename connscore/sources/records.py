"""Record ingest: comma-separated connection lines into typed DataFrames.

* ``read_records`` -- text scan of headerless files, then ``parse_lines``.
* ``read_numbered`` -- the same with each line's file and number in it, so a
  quarantined line can be found again.
* ``parse_lines``  -- the parse as column expressions over a string column
  (``spark.read.text`` output, or lines formatted from a table).  Every
  comma splits (no quoting), as in the source format.

The parse adds a boolean ``malformed`` column: a row is malformed when its field
count is wrong or a numeric field does not parse.  Malformed rows are kept
(quarantined), never silently dropped; ``well_formed`` / ``quarantined``
split them and ``write_with_quarantine`` writes both sides in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from connscore.operators.joins import sized_broadcast
from connscore.schema import CONNECTION_LAYOUT, NUMERIC, Layout

MALFORMED = "malformed"

#: A plain decimal number, with or without an exponent.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def read_records(spark: SparkSession, path: str | Sequence[str],
                 layout: Layout = CONNECTION_LAYOUT, keep_line: bool = False) -> DataFrame:
    """Scan headerless comma-separated files into the layout's typed columns.

    A text scan plus the expression parser: the ``malformed`` flag is
    computed from the whole line, so it stays correct whatever columns a
    later query selects (CSV column pruning would only check the columns it
    parses, and Spark rejects queries over the corrupt-record column alone).
    """
    return parse_lines(read_lines(spark, path), layout, keep_line=keep_line)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value`` (the text scan)."""
    return spark.read.text(path)


def read_numbered(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value, file, line_no): every line with its file and its number there, from 1.

    Files are read in splits by many tasks.  A line's place in its split is
    known where it is read; what a split's first line is follows from the line
    counts of the splits before it in the file, a table of one row a split.
    The scan has the same splits both times it is read.
    """
    here = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__start")]
    lines = read_lines(spark, path).select("value", *here, F.monotonically_increasing_id().alias("__at"))
    splits = lines.groupBy("file", "__start").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "__start", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1)
                           .alias("__shift"))
    return (lines.join(sized_broadcast(starts), ["file", "__start"])
            .select("value", "file", (F.col("__at") + F.col("__shift")).cast("long").alias("line_no")))


def read_numbered_records(spark: SparkSession, path: str | Sequence[str],
                          layout: Layout = CONNECTION_LAYOUT) -> DataFrame:
    """The records of ``read_records`` with line, n_fields, reason, file and line_no."""
    return parse_lines(read_numbered(spark, path), layout, keep_cols=["file", "line_no"], keep_line=True)


def split_fields(line: str | Column, sep: str = ",") -> Column:
    """Split on every separator; empty trailing fields are kept."""
    c = F.col(line) if isinstance(line, str) else line
    return F.split(c, sep, -1)


def parse_lines(df: DataFrame, layout: Layout = CONNECTION_LAYOUT,
                line_col: str = "value", keep_cols: Sequence[str] = (),
                keep_line: bool = False, sep: str = ",") -> DataFrame:
    """Parse a string column of separated fields into the layout's columns.

    Numeric fields are trimmed and ``try_cast`` to double; other fields are
    trimmed strings.  ``malformed`` is true when the field count differs
    from the layout or any numeric field fails to parse.
    """
    parts = split_fields(line_col, sep)
    n_expected = len(layout.fields)
    tmp = df.select(*keep_cols, F.col(line_col).alias("__line"), parts.alias("__parts"))
    out_cols = []
    bad_numbers = []
    for i, (name, role) in enumerate(layout.fields):
        raw = F.trim(F.try_element_at(F.col("__parts"), F.lit(i + 1)))
        if role == NUMERIC:
            # plain decimal numbers only: the cast alone takes 8d, NaN and Infinity
            val = F.when(raw.rlike(NUMBER), raw.try_cast("double"))
            val = F.when(F.abs(val) < float("inf"), val)
            bad_numbers.append(val.isNull())
        else:
            val = raw
        out_cols.append(val.alias(name))
    wrong_count = F.size("__parts") != F.lit(n_expected)
    malformed = wrong_count
    for b in bad_numbers:
        malformed = malformed | b
    select = [*keep_cols, *out_cols, malformed.alias(MALFORMED)]
    if keep_line:
        select += [F.col("__line").alias(line_col), F.size("__parts").alias("n_fields"),
                   F.when(wrong_count, F.lit("field_count"))
                    .when(malformed, F.lit("bad_number")).alias("reason")]
    return tmp.select(*select)


def to_lines(df: DataFrame, cols: Sequence[str | Column], sep: str = ",",
             line_col: str = "value", keep_cols: Sequence[str] = ()) -> DataFrame:
    """Format columns as one separated line per row (NULL -> empty field)."""
    fields = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
              for c in cols]
    return df.select(*keep_cols, F.concat_ws(sep, *fields).alias(line_col))


def well_formed(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(MALFORMED)).drop(MALFORMED)


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.col(MALFORMED))


def write_with_quarantine(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write accepted and quarantined rows in one scan, split by folder."""
    (df.write.mode("overwrite").partitionBy(MALFORMED).format(fmt).save(path))
