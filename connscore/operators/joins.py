"""Broadcasts only behind a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows under which a counted side is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to be small, else as it is."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
