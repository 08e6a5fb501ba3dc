"""A collection as a SQL table: `SELECT ... FROM search_docs('some words', 10) WHERE SCORE > 0.5`.

The functions are session-local SQL functions, so a call is inlined into the query around it and
planned with it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.embedding import embed_texts
from .distance import METRICS, check_metric, scores_against, to_matrix
from .text import (
    ASCII_UPPER,
    ASCII_WORD,
    INDEX_TOKEN_LENGTH,
    MAX_KEYWORDS,
    MIN_KEYWORD_LENGTH,
    STOP_WORDS,
    UNICODE_WORD,
)

_STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)

SCALAR_FUNCTIONS = {
    "farsight_text_words(t STRING) RETURNS ARRAY<STRING>": rf"""
        regexp_extract_all(lower(t), r'{UNICODE_WORD}', 0)
    """,
    "farsight_text_index_tokens(t STRING) RETURNS ARRAY<STRING>": f"""
        array_distinct(filter(farsight_text_words(t),
            w -> length(w) BETWEEN {INDEX_TOKEN_LENGTH[0]} AND {INDEX_TOKEN_LENGTH[1]}))
    """,
    f"farsight_query_keywords(t STRING, most INT DEFAULT {MAX_KEYWORDS}) RETURNS ARRAY<STRING>": f"""
        aggregate(
            regexp_extract_all(translate(t, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'),
                               '{ASCII_WORD}', 0),
            struct(CAST(array() AS ARRAY<STRING>) AS found, CAST(NULL AS STRING) AS previous),
            (acc, w) -> CASE
                WHEN size(acc.found) >= most THEN acc
                WHEN length(w) >= {MIN_KEYWORD_LENGTH} AND w NOT IN ({_STOP_LIST})
                     AND NOT array_contains(acc.found, w)
                THEN struct(
                    concat(acc.found, CASE
                        WHEN acc.previous IS NOT NULL
                             AND NOT array_contains(acc.found, acc.previous || w)
                        THEN array(w, acc.previous || w) ELSE array(w) END) AS found,
                    w AS previous)
                ELSE struct(acc.found AS found, CAST(NULL AS STRING) AS previous) END,
            acc -> if(most IS NULL, acc.found, slice(acc.found, 1, most)))
    """,
    "farsight_bucket_counts(hashes ARRAY<STRING>, dim INT) RETURNS ARRAY<DOUBLE>": """
        transform(sequence(0, dim - 1), d -> aggregate(
            filter(hashes, h -> CAST(conv(substr(h, 1, 8), 16, 10) AS BIGINT) % dim = d),
            0D,
            (s, h) -> s + CASE WHEN CAST(conv(substr(h, 9, 2), 16, 10) AS INT) % 2 = 1
                               THEN -1D ELSE 1D END))
    """,
    "farsight_unit_vector(a ARRAY<DOUBLE>, length DOUBLE) RETURNS ARRAY<FLOAT>": """
        transform(a, x -> CAST(coalesce(try_divide(x, length), 0D) AS FLOAT))
    """,
    "farsight_scaled_to_unit(a ARRAY<DOUBLE>) RETURNS ARRAY<FLOAT>": """
        farsight_unit_vector(a, sqrt(aggregate(a, 0D, (s, v) -> s + v * v)))
    """,
    "farsight_hashed_vector(t STRING, dim INT) RETURNS ARRAY<FLOAT>": """
        farsight_scaled_to_unit(farsight_bucket_counts(transform(farsight_text_words(t), w -> md5(w)), dim))
    """,
}


def register_functions(spark: SparkSession) -> None:
    """The text and vector functions, for use in SQL."""
    for signature, body in SCALAR_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def register_embedder(spark: SparkSession, function: str, embedder) -> None:
    """`function(text)` returns the vector an embedder gives, checked and in batches as for a table."""
    embed = embed_texts(embedder)

    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        return embed(texts)

    spark.udf.register(function, run)


def register_score(spark: SparkSession, function: str, metric: str, dim: int) -> None:
    """`function(embedding, vector)` is the score of each point against the one query vector; NULL where it has none."""

    @F.arrow_udf("double")
    def score(points: pa.Array, query: pa.Array) -> pa.Array:
        if not len(points):
            return pa.array([], pa.float64())
        return scores_against(metric, to_matrix(query[:1], dim), points)

    spark.udf.register(function, score)


def register_search_function(
    spark: SparkSession,
    function: str,
    view: str,
    dim: int,
    embedder=None,
    metric: str = "Cosine",
    rrf_constant: int = 60,
    task_groups: int = 256,
    default_limit: int = 10,
) -> None:
    """`function(query[, k[, offset[, keywords]]])` returns ID, TEXT, SCORE, QUERY by hybrid search in a view of points.

    The view has id, text, embedding and perhaps tokens, and is compared by `metric`. k is `default_limit` if left out, so many
    keywords count (twelve if left out, NULL: all); an empty or NULL query is refused. Without an embedder queries get hashed vectors, which plain SQL can work out.
    """
    check_metric(metric)
    register_functions(spark)
    register_score(spark, f"{function}_score", metric, dim)
    vector = f"farsight_hashed_vector(q, {dim})"
    if embedder is not None:
        register_embedder(spark, f"{function}_embed", embedder)
        vector = f"{function}_embed(q)"
    source = f"`{view}`"
    stored = "tokens" in spark.table(source).columns
    tokens = "tokens" if stored else "farsight_text_index_tokens(text)"
    sign = "" if METRICS[metric] else "-"
    wanted = "(k + skipped)"
    # Legs are cut within groups of tasks first, then over all, and the hits looked up last.
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {function}(
            q STRING, k INT DEFAULT {default_limit}, skipped INT DEFAULT 0,
            most_keywords INT DEFAULT {MAX_KEYWORDS})
        RETURNS TABLE(ID STRING, TEXT STRING, SCORE DOUBLE, QUERY STRING)
        RETURN
        SELECT p.id, p.text, best.score, q
        FROM (
            SELECT id, score, row_number() OVER (ORDER BY goodness DESC, id) AS place
            FROM (
                SELECT id, if(worded, fused, raw) AS score, if(worded, fused, {sign}raw) AS goodness
                FROM (
                    SELECT id, max(n_keywords) > 0 AS worded, max(score) AS raw,
                           aggregate(sort_array(collect_list(1D / ({rrf_constant} + place))), 0D,
                                     (total, term) -> total + term) AS fused
                    FROM (
                        SELECT id, leg, score, n_keywords, row_number() OVER (
                            PARTITION BY leg ORDER BY {sign}score DESC, id) AS place
                        FROM (
                            SELECT *, row_number() OVER (
                                PARTITION BY leg, tasks ORDER BY {sign}score DESC, id) AS task_place
                            FROM (
                                SELECT id, score, n_keywords, explode_outer(legs) AS leg,
                                       spark_partition_id() % {task_groups} AS tasks
                                FROM (
                                    SELECT id, size(keywords) AS n_keywords,
                                           {function}_score(embedding, vector) AS score,
                                           concat(array(''), array_intersect(keywords, {tokens}))
                                               AS legs
                                    FROM {source} JOIN (
                                        -- One row: the query, worked out once, not once per point.
                                        SELECT if(coalesce(q, '') = '',
                                                  CAST(raise_error('a search needs a query text') AS ARRAY<FLOAT>),
                                                  {vector}) AS vector,
                                               farsight_query_keywords(q, most_keywords) AS keywords
                                    ) ON true
                                )
                                WHERE score IS NOT NULL AND id IS NOT NULL
                            )
                        )
                        WHERE task_place <= greatest(10 * {wanted}, 50)
                          AND (leg = '' OR task_place <= greatest(4 * {wanted}, 20))
                    )
                    WHERE place <= greatest(10 * {wanted}, 50)
                      AND (leg = '' OR place <= greatest(4 * {wanted}, 20))
                    GROUP BY id
                )
            )
        ) best
        JOIN {source} p ON p.id = best.id
        WHERE best.place > skipped AND best.place <= {wanted}
        """
    )
