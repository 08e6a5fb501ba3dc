"""The training-data pipeline: its stages in order, each on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm import decontam, language, lines, mixing, near_dups
from farsight.llm.common import saved
from farsight.session import ship_package


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those the classifier rejects go. lang keeps what the table says."""
    ship_package(spark)
    learned = language.language_dictionaries(docs)
    return language.identify(docs, learned).filter("NOT rejected").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines met before; a document of which nothing is left goes. n_chars is counted anew."""
    ship_package(spark)
    found = lines.dedup_lines(docs).filter("n_dropped = 0 OR trim(text) != ''")
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship_package(spark)
    return near_dups.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, numbered by epoch from 1; those not taken go."""
    ship_package(spark)
    mixed = mixing.mix(docs).filter("copies > 0")
    epochs = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("epoch")
    return mixed.select(*docs.columns, "size", "source_size", "target", epochs)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: No SQL can express the stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over `documents`, each one's result written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = saved(docs, f"stage-{name}")
    return docs
