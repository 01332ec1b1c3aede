"""Join help."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def sized(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a narrow, aggregated table for broadcast, but only after counting its rows.

    The table is kept in memory (it is recomputed if an executor is lost), so that counting it
    does not cost a second pass. Above ``max_rows`` it comes back without a hint, and the join
    is planned as a shuffle join.
    """
    kept = df.persist()
    return F.broadcast(kept) if kept.count() <= max_rows else kept
