"""Is a collection fit to be searched?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import check_metric
from ..sources.statistics import ERRORS, HLL_ERROR


def health_report(
    points: DataFrame, registered: DataFrame, name: str, vector_size: int, probe_size: int
) -> DataFrame:
    """(place, check, status, detail) rows ending in a verdict; the names of the collections are rows of `list_tables`.

    Points are first reduced to one row per id with partial aggregation, so a point stored very
    often does not gather in one task, and everything else is counted on the way.
    """
    per_id = points.groupBy("id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(F.col("embedding").isNull()).alias("without_vector"),
        F.count_if(F.size("embedding") != vector_size).alias("wrong_size"),
    )
    counts = per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("points"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("copies"))), F.lit(0)).alias("no_id"),
        F.coalesce(F.sum("without_vector"), F.lit(0)).alias("no_vector"),
        F.coalesce(F.sum("wrong_size"), F.lit(0)).alias("wrong_size"),
        F.count_if(F.col("id").isNotNull() & (F.col("copies") > 1)).alias("duplicates"),
    )
    unique = (F.col("duplicates") == 0, F.concat(F.col("duplicates").cast("string"), F.lit(" ids stored more than once")))
    return _checked(counts, unique, registered, name, vector_size, probe_size)


def sketch_report(
    statistics: DataFrame, registered: DataFrame, name: str, vector_size: int, probe_size: int
) -> DataFrame:
    """The same report from the facts kept beside the segments (`CollectionStore.statistics`); no point is read.

    Ids count as unique if the number of points shown and the estimated number of different ids are no more than
    ERRORS standard errors of the sketch apart; vectors and ids missing are those of all points written, later replaced or not.
    """
    shown = F.col("points") - F.col("replaced")
    # Points replaced without a note are still counted; then the sketch is all that is known.
    shown = F.when(F.col("noted"), shown).otherwise(F.col("distinct_ids"))
    counts = statistics.withColumn("points", shown)
    apart = F.abs(F.col("points") - F.col("distinct_ids"))
    detail = F.concat(F.lit("about "), F.col("distinct_ids").cast("string"), F.lit(" different ids"))
    unique = (apart <= F.col("points") * (ERRORS * HLL_ERROR), detail)
    return _checked(counts, unique, registered, name, vector_size, probe_size)


def _checked(
    counts: DataFrame, unique: tuple[Column, Column], registered: DataFrame, name: str, vector_size: int, probe_size: int
) -> DataFrame:
    """The rows of a report on one row of counts."""
    # One row each, from a table of names and from an aggregate over the points.
    names = registered.agg(
        F.count(F.lit(1)).alias("collections"),
        F.count_if(F.lower("name") == name.lower()).alias("known"),
    ).withColumn("one", F.lit(1))
    facts = counts.withColumn("one", F.lit(1)).join(names, "one")

    def check(place: int, label: str, passed: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(place).alias("place"),
            F.lit(label).alias("check"),
            F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
            detail.alias("detail"),
        )

    def counted(column: str, text: str) -> Column:
        return F.concat(F.col(column).cast("string"), F.lit(f" {text}"))

    checks = [
        ("collection exists", F.col("known") > 0,
         counted("collections", "collection(s)")),
        ("has points", F.col("points") > 0, counted("points", "points")),
        ("ids present", F.col("no_id") == 0, counted("no_id", "points without id")),
        ("ids unique", *unique),
        ("vectors present", F.col("no_vector") == 0, counted("no_vector", "points without vector")),
        ("vector sizes", F.col("wrong_size") == 0,
         counted("wrong_size", f"vectors not of size {vector_size}")),
        ("embedding round trip", F.lit(probe_size == vector_size),
         F.lit(f"{probe_size}-dimensional vector returned")),
    ]
    everything = F.lit(True)
    for _, passed, _ in checks:
        everything = everything & passed
    rows = [check(n, *parts) for n, parts in enumerate(checks, start=1)]
    rows.append(
        check(
            len(rows) + 1,
            "verdict",
            everything,
            F.when(everything, F.lit("all checks passed")).otherwise(F.lit("some checks failed")),
        )
    )
    return facts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def collection_health(store, name: str, embedder, exact: bool = True) -> DataFrame:
    """The report for a stored collection and the embedder that is to be used with it; not `exact`: from sketches."""
    entry = store.entry(name)
    check_metric(entry["distance"])
    probe = embedder.embed(["preflight test"])
    if not exact:
        return sketch_report(store.statistics(name), store.registry(), name, entry["vector_size"], len(probe[0]))
    return health_report(
        store.points(name), store.registry(), name, entry["vector_size"], len(probe[0])
    )
