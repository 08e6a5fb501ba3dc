"""Last row wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(rows: DataFrame, key: str, seq: str = "seq", seen: str | None = None) -> DataFrame:
    """One row per key: the one with the greatest `seq`.

    An aggregate, not a window: each task first reduces its own rows, so a key held by a third of
    all rows ships one row per task. The remaining columns break a tie in `seq`, which keeps the
    outcome fixed. `seen` names an extra column with the number of rows per key.
    """
    rest = [c for c in rows.columns if c not in (key, seq)]
    aggregates = [F.max(F.struct(seq, *rest)).alias("last")]
    if seen:
        aggregates.append(F.count(F.lit(1)).alias(seen))
    kept = rows.groupBy(key).agg(*aggregates)
    return kept.select(key, "last.*", *([seen] if seen else []))


def overlay(older: DataFrame, newer: DataFrame, key: str) -> DataFrame:
    """`newer` on top of `older`; each side holds a key at most once."""
    survivors = older.join(newer.select(key), key, "left_anti").select(*older.columns)
    return survivors.unionByName(newer.select(*older.columns))


def upsert(existing: DataFrame, new: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Overwrite rows of the same key; the last of several new rows wins."""
    return overlay(existing, keep_last(new, key, seq), key)
