"""Input preparation for iterative fits.

Iterative estimators (logistic regression, k-means, trees) pass over their
input once per iteration or level.  Two things decide their speed:

* parallelism -- a narrow input (few files / row groups) gives few scan
  tasks, and every later pass inherits that.  The caller, who knows the size,
  gives a ``Spread``: so many partitions, dealt by these keys and sorted by
  them inside.  Without one the input's own partitions stay (the normal case
  on large data: no shuffle is added).
* reuse -- the prepared input is persisted with MEMORY_AND_DISK: a lost
  executor's blocks are recomputed from the scan lineage, and partitions
  that do not fit in memory spill to local disk instead of failing.

Estimators that draw from their input partition by partition (k-means) follow
the partitioning.  A ``Spread`` fixes it, rows in order, whatever the number of
cores or shuffle partitions, so a fit can be repeated elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from connscore.session import checkpoint_root


@dataclass(frozen=True)
class Spread:
    """Number of partitions and the key columns that rows are dealt and sorted by.

    The keys must be columns of the input; with keys that name a row, a
    partition holds the same rows in the same order every time.
    """
    partitions: int
    keys: tuple[str, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.partitions, *self.keys).sortWithinPartitions(*self.keys)


def spread_by_rows(rows: int, keys: tuple[str, ...], rows_per_partition: int = 100_000) -> Spread:
    """A spread whose number of partitions follows the number of rows."""
    return Spread(max(8, -(-rows // rows_per_partition)), tuple(keys))


@contextmanager
def persisted(df: DataFrame, spread: Spread | None = None) -> Iterator[DataFrame]:
    prepared = (spread.apply(df) if spread else df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield prepared
    finally:
        prepared.unpersist()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    The rows are written to the shared checkpoint folder (``spark.checkpoint.
    dir``), so several later branches read them instead of recomputing the
    plan, and a lost executor does not force a recomputation from the scan.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def spread_input(df: DataFrame, spread: Spread | None = None) -> Iterator["_Handle"]:
    """Yield a handle on ``df``, spread when the caller asks for it.

    A spread copy is cached while the caller reads it more than once
    (feature-stage fit, then feature caching); an input that stays as it is is
    never cached here.  The copy is dropped when the block exits, or earlier
    through ``release()`` on the handle.
    """
    handle = _Handle(spread.apply(df).persist(StorageLevel.MEMORY_AND_DISK) if spread else df, spread is not None)
    try:
        yield handle
    finally:
        handle.release()


class _Handle:
    def __init__(self, df: DataFrame, cached: bool):
        self.df = df
        self._cached = cached

    def release(self) -> None:
        if self._cached:
            self.df.unpersist()
            self._cached = False
