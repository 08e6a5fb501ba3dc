"""Exact duplicates by radix partitioning of the texts' bytes, most significant first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farsight.llm.common import broadcast_if_small, keyed, saved

#: Bytes looked at in the first pass, and how much more each later pass looks at.
FIRST_BYTES, GROWTH = 64, 16


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_bytes: int = FIRST_BYTES,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their bytes are; no digest decides it (the one returned is for the reader). Rows are split by
    the length in bytes, then by runs of successive bytes, longer at each pass; a group is done when it has one row
    or its text has ended, and only the rest goes through the next pass. A pass counts within map tasks before its
    shuffle, so a text that a third of all rows hold is no hot spot; the groups of two or more are then joined back,
    broadcast where small and else by a join of two tables, which Spark splits where it is skewed.

    The row with the largest id stays (of rows that share it, one; null ids are lowest). A null text counts as empty,
    and all empty texts are equal. An empty table gives no rows. Other columns are neither read nor returned.
    """
    rows = keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "row")
    body = F.coalesce("text", F.lit("")).cast("binary")
    live = rows.select("row", "id", F.lit(0).cast("long").alias("group"), F.length(body).alias("left"), body.alias("rest"))
    done, step = [], first_bytes
    while True:
        cut = live.withColumn("run", F.substring("rest", 1, step))
        keys = ["group", "left", "run"]
        counts = cut.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "row")).alias("keep")
        )
        several = saved(counts.filter("n > 1"), "radix-groups")
        split = cut.join(broadcast_if_small(several, F.length("run") + 64), keys)
        split = saved(
            split.select(
                "row",
                "id",
                F.col("keep.row").alias("group"),
                F.greatest(F.col("left") - step, F.lit(0)).alias("left"),
                F.expr(f"substring(rest, {step + 1})").alias("rest"),
                "n",
                F.col("keep.id").alias("keep_id"),
            ),
            "radix-rows",
        )
        done.append(split.filter("left = 0").select("row", "group", "keep_id", "n"))
        live = split.filter("left > 0").select("row", "id", "group", "left", "rest")
        if live.isEmpty():
            break
        step *= growth
    groups = reduce(DataFrame.unionAll, done)
    found = rows.select("row", "id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    return found.join(broadcast_if_small(groups, 40), "row", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("group") == F.col("row"))).alias("kept"),
        "text_sha256",
    )
