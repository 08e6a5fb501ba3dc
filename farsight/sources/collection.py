"""A collection as the search sees it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import check_metric
from ..functions.ids import point_id
from ..operators.cleaning import wrong_size
from ..session import fresh_folder

#: Ids that several rows have are broadcast up to this many bytes, which are counted.
MAX_REPEATED_BYTES = 16 * 1024 * 1024


def shard_of(point: Column, digits: int) -> Column:
    """The folder a point lies in: the first hex digits of its id, which is evenly spread."""
    return F.substring(point, 1, digits)


@dataclass(frozen=True)
class Collection:
    """Points with one text and one vector each, compared by one metric.

    `points` has id, text and embedding, and may have tokens (the text index). Where it is stored
    by shard, `shard_digits` says how and `layers` are its parts, later ones over earlier ones; the
    texts of hits are then read from their shards in each part only.
    """

    name: str
    points: DataFrame
    vector_size: int
    distance: str = "Cosine"
    model_name: str | None = None
    shard_digits: int = 0
    layers: tuple[DataFrame, ...] = ()
    #: Where there is a stored inverted index: the rows of each layer that later ones leave in place, and its postings.
    current: tuple[DataFrame, ...] = ()
    postings: tuple[DataFrame, ...] = ()

    def __post_init__(self) -> None:
        check_metric(self.distance)

    @classmethod
    def from_table(
        cls,
        name: str,
        df: DataFrame,
        vector_size: int,
        id_col: str = "id",
        text_col: str = "text",
        vector_col: str = "embedding",
        **settings,
    ) -> Collection:
        """A collection over any table that already has vectors, and perhaps tokens.

        A row without an id gets the point id of its text, as the ids of a collection name its points; so do rows with
        an empty one. Ids must then be unique: of rows with the same id one stays, that of the least text, then least vector
        (one count over the ids tells whether there are any; a table without them is not shuffled). Rows whose
        vector is missing, of another size or not finite stay, but no search finds them; `size_report` counts them.
        """
        text = F.coalesce(F.col(text_col), F.lit(""))
        points = df.select(
            F.coalesce(F.nullif(F.col(id_col).cast("string"), F.lit("")), point_id(text)).alias("id"),
            text.alias("text"),
            F.col(vector_col).cast("array<float>").alias("embedding"),
            *(["tokens"] if "tokens" in df.columns else []),
        )
        counts = points.agg(F.count("id").alias("rows"), F.count_distinct("id").alias("ids")).first()
        if counts["rows"] != counts["ids"]:
            points = cls._one_row_an_id(points)
        return cls(name, points, vector_size, **settings)

    @staticmethod
    def _one_row_an_id(points: DataFrame) -> DataFrame:
        """The repeated ids are written down, and their rows alone are shuffled; the others stay where they lie, unless the ids outgrow
        a broadcast."""
        spark = points.sparkSession
        folder = fresh_folder(spark, "repeated-ids")
        repeated = points.groupBy("id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
        repeated.select("id").write.parquet(folder)
        repeated = spark.read.schema("id string").parquet(folder)
        size = repeated.agg(F.sum(F.octet_length("id") + 32).cast("long")).first()[0] or 0
        if size <= MAX_REPEATED_BYTES:
            repeated = F.broadcast(repeated)
        rest = [c for c in points.columns if c != "id"]
        least = points.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct(*rest)).alias("row"))
        single = points.join(repeated, "id", "left_anti")
        return single.unionByName(least.select("id", "row.*"))

    def size_report(self) -> DataFrame:
        """How many points have a vector of the right size, and how many do not."""
        infinite = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        bad = wrong_size(F.col("embedding"), self.vector_size) | F.coalesce(infinite, F.lit(False))
        return self.points.agg(
            F.count_if(~bad).alias("fitting"), F.count_if(bad).alias("not_fitting")
        )

    def with_texts(self, hits: DataFrame, few: bool) -> DataFrame:
        """Hits (id, ...) with the texts of their points.

        `few` says that the hits are known to be few enough to be sent to every task; otherwise
        Spark chooses the join from their actual size.
        """
        if not self.shard_digits:
            return self.points.select("id", "text").join(F.broadcast(hits) if few else hits, "id")
        # Spark prunes partitions by a join only if the other side is filtered by something, and
        # does not see that a top-k is selective; hence a filter that keeps every hit.
        placed = hits.withColumn("shard", shard_of(point_id(F.col("id")), self.shard_digits))
        placed = placed.filter(F.col("shard") >= "")
        side = F.broadcast(placed) if few else placed
        found = [
            layer.select("id", "shard", "text")
            .join(side, ["id", "shard"])
            .select(*hits.columns, F.lit(age).alias("age"), "text")
            for age, layer in enumerate(self.layers or (self.points,))
        ]
        if len(found) == 1:
            return found[0].drop("age")
        # A hit is a current point, so the latest text found for it is its text.
        return (
            reduce(DataFrame.unionByName, found)
            .groupBy(*hits.columns)
            .agg(F.max(F.struct("age", "text")).alias("latest"))
            .select(*hits.columns, "latest.text")
        )
