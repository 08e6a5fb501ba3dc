"""Creating collections: one job over a table of requests."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import METRICS

# Vector sizes of known models.
MODEL_DIMENSIONS = {
    "text-embedding-3-small": 1536,
    "text-embedding-3-large": 3072,
    "text-embedding-ada-002": 1536,
    "all-MiniLM-L6-v2": 384,
    "all-MiniLM-L12-v2": 384,
    "all-mpnet-base-v2": 768,
    "paraphrase-MiniLM-L6-v2": 384,
    "multi-qa-MiniLM-L6-cos-v1": 384,
    "nomic-embed-text": 768,
}

# A name is also a folder.
NAME_PATTERN = "[A-Za-z0-9_][A-Za-z0-9_.-]*"


def resolved_size(vector_size: Column, model_name: Column) -> Column:
    """The explicit size, else the size of a known model, else NULL."""
    known = F.create_map(*[F.lit(part) for part in chain(*MODEL_DIMENSIONS.items())])
    return F.coalesce(vector_size, F.try_element_at(known, model_name)).cast("int")


def request_problem(
    name: Column, distance: Column, size: Column, model_name: Column
) -> Column:
    """Why a request cannot be met, or NULL. The metric is looked at first."""
    return (
        F.when(~F.coalesce(distance.isin(*METRICS), F.lit(False)), F.lit("invalid distance"))
        .when(
            size.isNull() & (F.coalesce(model_name, F.lit("")) == ""),
            F.lit("no vector_size and no model_name"),
        )
        .when(size.isNull(), F.lit("unknown model and no explicit vector_size"))
        .when(
            ~F.coalesce(name.rlike(rf"\A{NAME_PATTERN}\z"), F.lit(False)),
            F.lit("this cannot name a collection"),
        )
    )


SALTS = 32


def plan_creation(requests: DataFrame, registered: DataFrame) -> DataFrame:
    """One status per request.

    `requests`: seq, name, vector_size, distance, model_name; `registered`: name. The first valid
    request for an unregistered name creates it; later ones and those for a registered name find
    it there and change nothing. A name differing from a present one only by case is refused.

    Names are first reduced to one row each, with map-side partial aggregation; the requests then meet them by name
    and by one of SALTS parts, so a name asked for very often is spread over as many tasks.
    """
    size = resolved_size(F.col("vector_size"), F.col("model_name"))
    checked = requests.select(
        "seq",
        "name",
        F.lower("name").alias("key"),
        size.alias("vector_size"),
        "distance",
        "model_name",
        request_problem(F.col("name"), F.col("distance"), size, F.col("model_name")).alias("problem"),
    )
    firsts = (
        checked.filter(F.col("problem").isNull())
        .groupBy("key")
        .agg(F.min(F.struct("seq", "name")).alias("first"))
    )
    present = registered.groupBy(F.lower("name").alias("key")).agg(
        F.min("name").alias("registered_name")
    )
    owners = (
        firsts.join(present, "key", "left")
        .select(
            "key",
            F.coalesce("registered_name", "first.name").alias("owner"),
            F.when(F.col("registered_name").isNull(), F.col("first.seq")).alias("creating_seq"),
        )
    )
    status = (
        F.when(F.col("problem").isNotNull(), F.concat(F.lit("error: "), "problem"))
        .when(F.col("owner") != F.col("name"), F.lit("error: name differs only by case"))
        .when(F.col("seq") == F.col("creating_seq"), F.concat(F.lit("created: "), "name"))
        .otherwise(F.concat(F.lit("exists: "), "name"))
    )
    salt = F.pmod(F.xxhash64("seq", "name"), F.lit(SALTS))
    salted = owners.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return checked.withColumn("salt", salt).join(salted, ["key", "salt"], "left").select(
        "seq", "name", "vector_size", "distance", "model_name", status.alias("status")
    )
