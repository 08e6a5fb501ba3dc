"""Searching a collection, for one query or for a table of queries."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.distance import best_first, score_against
from ..functions.text import MAX_KEYWORDS, extract_keywords
from ..session import fresh_folder
from ..sources.collection import Collection
from .embedding import Embedder, embed_column, embed_query
from .ranking import (
    DEFAULT_LIMIT,
    MAX_BLOCK_BYTES,
    RRF_CONSTANT,
    LegLimits,
    QueryBlock,
    candidates_broadcast,
    candidates_dealt,
    candidates_from_postings,
    dealing,
    fuse,
    query_blocks,
    rank_legs,
)

# Hits, an id and a score each, are broadcast to fetch their texts up to this many.
MAX_BROADCAST_HITS = 100_000
# Queries go through the driver to the points in up to so many blocks; more are dealt to tasks together with the points.
MAX_BROADCAST_BLOCKS = 4
# Texts of queries are broadcast up to this many bytes, which are counted.
MAX_BROADCAST_BYTES = 16 * 1024 * 1024


ONE_QUERY = "q"  # stands for the text of a search's only query until the end


def _check(limit: int, offset: int) -> None:
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")


def query_keywords(
    spark: SparkSession, query: str, unicode: bool = False, most: int | None = MAX_KEYWORDS
) -> list[str]:
    """The keywords of one query text; `most` of them, None: all."""
    row = spark.sql("SELECT :query AS query", args={"query": query})
    return row.select(extract_keywords(F.col("query"), unicode, most)).first()[0]


def query_vector_for(
    collection: Collection,
    query: str,
    query_vector: Sequence[float] | None,
    embedder: Embedder | None,
) -> list[float]:
    if query_vector is None:
        if embedder is None:
            raise ValueError("give a query_vector or an embedder")
        _check_model(collection, embedder)
        query_vector = embed_query(embedder, query)
    if len(query_vector) != collection.vector_size:
        raise ValueError(
            f"the query vector has {len(query_vector)} elements, "
            f"{collection.name!r} has {collection.vector_size}"
        )
    return [float(value) for value in query_vector]


def _check_model(collection: Collection, embedder: Embedder) -> None:
    if collection.model_name and collection.model_name != embedder.model:
        raise ValueError(
            f"{collection.name!r} holds vectors of {collection.model_name!r}, "
            f"not of {embedder.model!r}"
        )


def nearest(
    collection: Collection,
    query_vector: Sequence[float],
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> DataFrame:
    """(id, score) of the points nearest to a vector; each task keeps only its best rows."""
    _check(limit, offset)
    score = score_against(collection.distance, F.col("embedding"), list(query_vector))
    return (
        collection.points.select("id", score.alias("score"))
        .filter(F.col("score").isNotNull() & F.col("id").isNotNull())
        .orderBy(best_first(collection.distance, F.col("score")), "id")
        .offset(offset)
        .limit(limit)
    )


def result_id(original_id: Column, point_id: Column) -> Column:
    """The id shown for a hit: the one it came with, else the id of its point."""
    return F.coalesce(original_id, point_id, F.lit(""))


def result_rows(hits: DataFrame, *extra: str) -> DataFrame:
    """The four result columns; missing values become '' and 0."""
    return hits.select(
        *extra,
        F.coalesce("id", F.lit("")).alias("ID"),
        F.coalesce("text", F.lit("")).alias("TEXT"),
        F.coalesce("score", F.lit(0.0)).alias("SCORE"),
        F.col("query").alias("QUERY"),
    )


def in_order(found: DataFrame, at_most: int, *best: Column) -> DataFrame:
    """The rows, of which there are `at_most`, from the best on.

    Few rows are numbered in one partition: a sort over a sampled range would fetch their texts twice. The order comes
    from the numbering, which is used: a mere sort, of a limit or of a single partition, is dropped by the adaptive optimizer
    where it takes the join below for one row (its rule `OptimizeOneRowPlan`, by the row counts of finished stages).
    """
    if at_most > MAX_BROADCAST_HITS:
        return found.orderBy(*best)
    numbered = found.withColumn("place", F.row_number().over(Window.orderBy(*best)))
    return numbered.filter("place > 0").drop("place")


def vector_search(
    collection: Collection,
    query: str,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    query_vector: Sequence[float] | None = None,
    embedder: Embedder | None = None,
) -> DataFrame:
    """ID, TEXT, SCORE, QUERY of the nearest points; SCORE is the raw metric."""
    vector = query_vector_for(collection, query, query_vector, embedder)
    hits = nearest(collection, vector, limit, offset)
    found = collection.with_texts(hits, few=limit <= MAX_BROADCAST_HITS)
    found = in_order(found, limit, best_first(collection.distance, F.col("score")), F.col("id"))
    return result_rows(found.withColumn("query", F.lit(query)))


def leg_candidates(collection: Collection, block: QueryBlock, limits: LegLimits) -> DataFrame:
    """Candidates of all legs of a block of queries: one pass over the points, or, where the collection has postings, one
    over the vectors alone, the keyword legs coming from the points that the postings name."""
    metric = collection.distance
    if not collection.postings or not block.vocabulary():
        return candidates_broadcast(collection.points, block, metric, limits)
    vectors = candidates_broadcast(collection.points, block, metric, limits, keyword_legs=False)
    parts = list(zip(collection.current, collection.postings))
    return vectors.unionAll(candidates_from_postings(parts, collection.shard_digits, block, metric, limits))


def ranked_legs(
    collection: Collection,
    query: str,
    keywords: list[str],
    query_vector: Sequence[float],
    limits: LegLimits,
) -> DataFrame:
    """The legs of one query: (query_key, hybrid, leg, id, score, rank)."""
    block = QueryBlock(
        [ONE_QUERY], np.asarray([query_vector], dtype=np.float64), [list(keywords)]
    )
    return rank_legs(leg_candidates(collection, block, limits), collection.distance, limits)


def search(
    collection: Collection,
    query: str,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    query_vector: Sequence[float] | None = None,
    embedder: Embedder | None = None,
    rrf_constant: int = RRF_CONSTANT,
    unicode_keywords: bool = False,
    max_keywords: int | None = MAX_KEYWORDS,
) -> DataFrame:
    """Hybrid search: ID, TEXT, SCORE, QUERY, best first.

    Without any keyword in the query this is `vector_search`.
    """
    _check(limit, offset)
    if not query:
        raise ValueError("a search needs a query text")
    spark = collection.points.sparkSession
    keywords = query_keywords(spark, query, unicode_keywords, max_keywords)
    vector = query_vector_for(collection, query, query_vector, embedder)
    if not keywords:
        return vector_search(collection, query, limit, offset, vector)

    limits = LegLimits(limit + offset)
    ranked = ranked_legs(collection, query, keywords, vector, limits)
    fused = fuse(ranked, collection.distance, rrf_constant)
    hits = (
        fused.orderBy(F.desc("goodness"), "id")
        .offset(offset)
        .limit(limit)
        .select("id", "score")
    )
    found = collection.with_texts(hits, few=limit <= MAX_BROADCAST_HITS)
    found = in_order(found, limit, F.desc("score"), F.col("id"))
    return result_rows(found.withColumn("query", F.lit(query)))


def ranked_legs_of_many(
    collection: Collection,
    queries: DataFrame,
    limits: LegLimits,
    embedder: Embedder | None = None,
    unicode_keywords: bool = False,
    max_keywords: int | None = MAX_KEYWORDS,
    max_block_bytes: int = MAX_BLOCK_BYTES,
    dealt_blocks: int = 0,
    dealt_slices: int | None = None,
) -> DataFrame:
    """The legs of a table of queries (query_id, query[, query_vector]), as `ranked_legs` has them for one; the key of
    a query is its id as text. With `dealt_blocks` queries and points are dealt to tasks in so many blocks of queries
    and slices of points, not through the driver: points are saved for it at once, queries read when the result is."""
    given = "query_vector" in queries.columns
    worded = queries.select(
        F.col("query_id").cast("string").alias("query_key"),
        extract_keywords(F.col("query"), unicode_keywords, max_keywords).alias("keywords"),
        F.col("query_vector").cast("array<double>") if given else F.col("query"),
    )
    if given:
        prepared = worded
    else:
        _check_model(collection, embedder)
        prepared = embed_column(worded, "query", embedder).withColumnRenamed(
            "embedding", "query_vector"
        )

    metric, dim = collection.distance, collection.vector_size
    if dealt_blocks:
        dealt = candidates_dealt(collection.points, prepared, metric, dim, limits, dealt_blocks, dealt_slices)
        return rank_legs(dealt, metric, limits, dealt_slices)
    spark = collection.points.sparkSession
    folder = fresh_folder(spark, "queries")
    prepared.select("query_key", "keywords", "query_vector").write.parquet(folder)
    blocks = query_blocks(spark.read.parquet(folder), dim, max_block_bytes)
    passes = [leg_candidates(collection, block, limits) for block in blocks]
    candidates = reduce(DataFrame.unionAll, passes)
    return rank_legs(candidates, metric, limits)


def search_many(
    collection: Collection,
    queries: DataFrame,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    embedder: Embedder | None = None,
    rrf_constant: int = RRF_CONSTANT,
    unicode_keywords: bool = False,
    max_keywords: int | None = MAX_KEYWORDS,
    max_block_bytes: int = MAX_BLOCK_BYTES,
    dealt: bool | None = None,
) -> DataFrame:
    """Hybrid search for each row of a table (query_id, query[, query_vector]).

    Returns query_id, ID, TEXT, SCORE, QUERY. Queries without keywords keep the raw metric. Few queries are sent to the
    points, which then stay in place, in blocks of about `max_block_bytes`, one pass over the points each; where that makes
    more than MAX_BROADCAST_BLOCKS, or with `dealt`, queries and points are dealt to tasks and no query passes through
    the driver. Queries are counted at once, points too when dealt, and written once for their tasks; queries are then read, and
    embedded, as often as the result is.
    """
    _check(limit, offset)
    given = "query_vector" in queries.columns
    if not given and embedder is None:
        raise ValueError("give query vectors or an embedder")
    asked = queries.select(
        "query_id", "query", F.col("query_id").cast("string").alias("query_key")
    )
    sizes = asked.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("query_key").alias("ids"),
        F.sum(F.length(F.coalesce("query", F.lit(""))) + 64).alias("bytes"),
    ).first()
    if sizes["ids"] != sizes["rows"]:
        raise ValueError("query_id must be unique and not NULL")

    limits, metric = LegLimits(limit + offset), collection.distance
    size = (sizes["bytes"] or 0) + 8 * collection.vector_size * sizes["rows"]
    blocks = max(1, math.ceil(size / max_block_bytes))
    if dealt is None:
        dealt = blocks > MAX_BROADCAST_BLOCKS
    slices = None
    if dealt:
        points = collection.points.count()
        slices, blocks = dealing(collection.points.sparkSession, points, sizes["rows"], limits, blocks)
    ranked = ranked_legs_of_many(
        collection,
        queries,
        limits,
        embedder,
        unicode_keywords,
        max_keywords,
        max_block_bytes,
        dealt_blocks=blocks if dealt else 0,
        dealt_slices=slices,
    )
    fused = fuse(ranked, metric, rrf_constant)
    place = F.row_number().over(
        Window.partitionBy("query_key").orderBy(F.desc("goodness"), "id")
    )
    hits = (
        fused.withColumn("place", place)
        .filter((F.col("place") <= limit + offset) & (F.col("place") > offset))
        .select("query_key", "id", "score")
    )
    found = collection.with_texts(hits, few=sizes["rows"] * limit <= MAX_BROADCAST_HITS)
    return result_rows(
        found.join(
            F.broadcast(asked) if (sizes["bytes"] or 0) <= MAX_BROADCAST_BYTES else asked, "query_key"
        ),
        "query_id",
    )


def register_search_many(collection: Collection, queries: str, view: str, **settings) -> None:
    """Hybrid search from SQL for a column of queries: the hits of all rows of a table or view `queries` (query_id, query
    [, query_vector]) as the temporary view `view` of query_id, ID, TEXT, SCORE, QUERY.

    `settings` are those of `search_many`. Queries and points are dealt to tasks, so that the view is a plan like any other
    and its whole search is one pass of both. The rows of `queries` are counted now, to size the blocks: the view follows
    what the table holds when it is read, but one that has grown much is better registered anew.
    """
    asked = collection.points.sparkSession.table(queries)
    search_many(collection, asked, dealt=True, **settings).createOrReplaceTempView(view)
