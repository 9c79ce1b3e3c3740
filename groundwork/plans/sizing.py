"""Broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """Mark `df` for broadcast only when it has at most `max_rows` rows.

    The check reads at most max_rows+1 rows (a bounded job); above the bound
    the DataFrame is returned unmarked and Spark/AQE pick a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
