"""What happens to rows before they are embedded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_id(original_id: Column) -> Column:
    return F.coalesce(original_id != "", F.lit(False))


def id_and_text(
    df: DataFrame, id_col: Column, text_col: Column, seq_col: Column | None = None
) -> DataFrame:
    """(original_id, text, seq) from any table.

    `seq` says which of two rows with one id is the later. Without a column for it the order of
    arrival is used, which is only repeatable if the source hands out its rows in a fixed order.
    """
    return df.select(
        id_col.cast("string").alias("original_id"),
        text_col.cast("string").alias("text"),
        (F.monotonically_increasing_id() if seq_col is None else seq_col).alias("seq"),
    )


def clean(rows: DataFrame) -> DataFrame:
    """Drop rows without an id; turn a missing text into an empty one."""
    return rows.filter(has_id(F.col("original_id"))).withColumn(
        "text", F.coalesce("text", F.lit(""))
    )


def missing_id_counts() -> list[Column]:
    """Aggregates over rows before cleaning."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~has_id(F.col("original_id"))).alias("without_id"),
    ]


def require_some_ids(rows: int, without_id: int) -> None:
    """The whole input is looked at, so the outcome does not depend on how rows were placed."""
    if without_id and without_id == rows:
        raise ValueError(f"none of the {rows} rows has an id")


def wrong_size(embedding: Column, vector_size: int) -> Column:
    """True where a vector is missing or has another number of elements."""
    return F.coalesce(F.size(embedding) != vector_size, F.lit(True)) | embedding.isNull()
