"""Joining search results with other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .search import MAX_BROADCAST_HITS


def join_hits(hits: DataFrame, other: DataFrame, key: str, n_hits: int) -> DataFrame:
    """Hits with the rows of another table that carry their id, compared as text.

    The hits, not the table, are what is sent around: there are at most `n_hits` of them.
    """
    side = F.broadcast(hits) if n_hits <= MAX_BROADCAST_HITS else hits
    return other.join(side, F.col(key).cast("string") == F.col("ID"))
