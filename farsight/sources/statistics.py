"""Small facts of a segment, gathered while it is written and merged when they are asked for; no point is read again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import wrong_size

#: Registers of the sketch of distinct ids, as a power of two, and its standard error.
HLL_BITS = 12
HLL_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
#: How many standard errors a count of ids may lie off.
ERRORS = 4

SCHEMA = (
    "points bigint, no_id bigint, no_vector bigint, wrong_size bigint, text_bytes bigint, longest bigint, ids binary, lengths binary"
)


def gathered(vector_size: int) -> list[Column]:
    """What is observed of the points (point_id, id, text, embedding) of a segment on their way to the files.

    Every number is a sum, a largest value or a sketch, so facts of segments merge into those of a collection.
    """
    chars = F.coalesce(F.length("text"), F.lit(0)).cast("bigint")
    return [
        F.count(F.lit(1)).alias("points"),
        F.count_if(F.col("id").isNull()).alias("no_id"),
        F.count_if(F.col("embedding").isNull()).alias("no_vector"),
        F.count_if(wrong_size(F.col("embedding"), vector_size)).alias("wrong_size"),
        F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0)).cast("bigint").alias("text_bytes"),
        F.coalesce(F.max(chars), F.lit(0)).cast("bigint").alias("longest"),
        F.hll_sketch_agg("point_id", F.lit(HLL_BITS)).alias("ids"),
        F.kll_sketch_agg_bigint(chars).alias("lengths"),
    ]


def write_statistics(spark: SparkSession, facts: dict, path: str) -> None:
    """The observed facts of one segment, as a table of one row."""
    names = [column.split()[0] for column in SCHEMA.split(", ")]
    row = [bytes(v) if isinstance(v := facts[name], bytearray) else v for name in names]
    spark.createDataFrame([tuple(row)], SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def merged(spark: SparkSession, paths: list[str], replaced: list[DataFrame]) -> DataFrame:
    """One row for segments with these facts: the summed columns, `longest`, `replaced` (how many of the points later segments
    replace, by the bitmaps (bitmap) noted about them), `distinct_ids` (estimated), and the median and 95th percentile of text lengths.

    Sums and lengths are over all points written, replaced ones too.
    """
    facts = spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("points", "no_id", "no_vector", "wrong_size", "text_bytes")]
    lengths = F.kll_merge_agg_bigint("lengths")
    total = facts.agg(
        *sums,
        F.coalesce(F.max("longest"), F.lit(0)).alias("longest"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("ids")), F.lit(0)).cast("bigint").alias("distinct_ids"),
        lengths.alias("lengths"),
    )
    quantile = lambda at: F.when(F.col("points") > 0, F.kll_sketch_get_quantile_bigint("lengths", F.lit(at)))
    total = total.select(
        *[c for c in total.columns if c != "lengths"], quantile(0.5).alias("median_length"), quantile(0.95).alias("p95_length")
    )
    if not replaced:
        return total.withColumn("replaced", F.lit(0).cast("bigint"))
    maps = reduce(DataFrame.unionByName, replaced)
    gone = maps.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint").alias("replaced"))
    return total.withColumn("one", F.lit(1)).join(F.broadcast(gone.withColumn("one", F.lit(1))), "one").drop("one")
