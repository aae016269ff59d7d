"""Global order without a one-task step: ranks and running sums over sorted blocks.

Rows are cut into range blocks of about ``BLOCK_ROWS`` (their number follows
the number of rows), sorted inside, and written with their place.  A rank is
the place in the block plus the sizes of the blocks before, a running sum the
sum in the block plus the totals before.  What is small are the blocks: one row
for each block, and for ranks within groups one more for each group that
begins inside a block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connscore.operators.joins import sized_broadcast
from connscore.sources.scratch import scratch_table

#: Rows of a block.
BLOCK_ROWS = 50_000


def sorted_blocks(df: DataFrame, order: Sequence[Column], blocks: int | None = None,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` written in range blocks of the order, with ``__b`` (block) and ``__at`` (place in it, from 0).

    Blocks and places rise with the order.  Rows that are equal in the order
    share a block; give an order without ties to keep blocks even.
    """
    rows = scratch_table(df, "unsorted")
    if blocks is None:
        blocks = max(1, math.ceil(rows.count() / block_rows))
    place = F.monotonically_increasing_id()   # partition in the upper bits, row in the lower 33
    return scratch_table(
        rows.repartitionByRange(blocks, *order).sortWithinPartitions(*order).withColumn("__place", place)
        .select(*df.columns, F.shiftright("__place", 33).alias("__b"),
                F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)).alias("__at")),
        "sorted")


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str,
           blocks: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with the rank of each row in its group (long, from 0) by ``order``.

    Group columns may be null.  Rows equal in group and order get any of their ranks.
    """
    placed = sorted_blocks(df, [*[F.col(g).asc_nulls_first() for g in group], *order], blocks, block_rows)
    cells = placed.groupBy(*group, "__b").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__g{i}" for i in range(len(group))]
    starts = cells.select(*[F.col(g).alias(n) for g, n in zip(group, names)], F.col("__b").alias("__gb"),
                          (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__start"))
    same = F.col("__b") == F.col("__gb")
    for g, n in zip(group, names):
        same = same & F.col(g).eqNullSafe(F.col(n))
    return (placed.join(sized_broadcast(starts), same)
            .select(*df.columns, (F.col("__at") + F.col("__start")).cast("long").alias(out)))


def running_sums(df: DataFrame, order: Sequence[Column], values: Sequence[str],
                 blocks: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``cum_<v>`` (sum up to and with the row) and ``total_<v>`` of each value, in the given order.

    The order must have no ties.  The columns of the result come from a written
    table, so branches of a plan read them and nothing else again.
    """
    placed = sorted_blocks(df, order, blocks, block_rows)
    inside = Window.partitionBy("__b").orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = placed.groupBy("__b").agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    one = F.lit(0)    # one row a block, numbered by the driver's own choice of blocks
    earlier = Window.partitionBy(one).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__b", *[F.coalesce(F.sum(f"__t_{v}").over(earlier), F.lit(0)).alias(f"__o_{v}") for v in values],
                            *[F.sum(f"__t_{v}").over(Window.partitionBy(one)).alias(f"total_{v}") for v in values])
    return (placed.select(*df.columns, "__b", *[F.sum(v).over(inside).alias(f"__in_{v}") for v in values])
            .join(sized_broadcast(offsets), "__b")
            .select(*df.columns, *[(F.col(f"__in_{v}") + F.col(f"__o_{v}")).alias(f"cum_{v}") for v in values],
                    *[f"total_{v}" for v in values]))
