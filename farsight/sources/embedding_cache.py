"""Vectors that were paid for once: kept by model and content hash, so that unchanged texts never reach the model again.

    <folder>/model=<hash of the model's name>/      (key, embedding); key: SHA-256 of the text
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import wrong_size
from ..operators.embedding import BATCH_SIZE, Embedder, embed_column
from . import commits

SCHEMA = "key string, embedding array<float>"


class EmbeddingCache:
    """A folder of vectors, which ingests into any number of collections may share.

    It grows only: one file or more for each run that met new texts. Two runs at the same moment may both ask the model for
    a text; the reader takes one of the answers.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, model: str) -> str:
        return f"{self.folder}/model={hashlib.sha256(model.encode()).hexdigest()[:32]}"

    def vectors(self, model: str) -> DataFrame:
        """(key, embedding) of all texts known for a model."""
        path = self._path(model)
        if not commits.exists(self.spark, path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(path)

    def fill(
        self, texts: DataFrame, text_col: str, embedder: Embedder, vector_size: int, batch_size: int = BATCH_SIZE
    ) -> None:
        """Ask the model for the texts that are not known, each once, and keep the answers that have `vector_size` elements.

        Equal texts are reduced to one within each task first; of what is known only the keys are read. A failed run
        keeps nothing, for Spark shows a write's files when it is complete.
        """
        asked = texts.select(F.coalesce(text_col, F.lit("")).alias("text"))
        asked = asked.groupBy(F.sha2("text", 256).alias("key")).agg(F.min("text").alias("text"))
        new = asked.join(self.vectors(embedder.model).select("key"), "key", "left_anti")
        answers = embed_column(new, "text", embedder, batch_size)
        kept = answers.filter(~wrong_size(F.col("embedding"), vector_size))
        kept.select("key", "embedding").write.mode("append").parquet(self._path(embedder.model))

    def embed(
        self, df: DataFrame, text_col: str, embedder: Embedder, vector_size: int, batch_size: int = BATCH_SIZE
    ) -> DataFrame:
        """Replace the text column by `embedding`, as `embed_column` does, but for texts met before without the model.

        `df` is evaluated twice, once for the texts that are new. Where the model's answer did not fit, the embedding is NULL.
        Texts are joined by their hashes; a text that a third of all rows share is a skewed key, which Spark splits.
        """
        self.fill(df, text_col, embedder, vector_size, batch_size)
        known = self.vectors(embedder.model).dropDuplicates(["key"])
        keyed = df.withColumn("key", F.sha2(F.coalesce(text_col, F.lit("")), 256)).drop(text_col)
        return keyed.join(known, "key", "left").drop("key")
