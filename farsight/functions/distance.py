"""The four metrics of a collection.

`distance(metric, a, b)` is a native expression over two array columns. `score_against` compares
an array column with one fixed query vector; it hands whole Arrow batches to numpy, because array
lambdas are interpreted element by element and dominate a scan. Both give the raw metric.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The metric names; True where a greater score is the better one.
METRICS = {"Cosine": True, "Dot": True, "Euclid": False, "Manhattan": False}

# Scores are equal if their first so many digits are, so that copies tie whatever the order of summation. The digits
# count from the first that is not 0: small vectors are told apart as well as large ones.
SCORE_DIGITS = 12


def check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(
            f"{metric!r} is not a distance metric; there are {', '.join(METRICS)}"
        )


def best_first(metric: str, score: Column) -> Column:
    """The sort expression that puts the best score first."""
    check_metric(metric)
    return score.desc() if METRICS[metric] else score.asc()


def _fold(a: Column, b: Column, term) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: term(x.cast("double"), y.cast("double")))
    return F.aggregate(pairs, F.lit(0.0), lambda total, value: total + value)


def dot(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: x * y)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0.0 when either vector has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    ratio = F.try_divide(dot(a, b), norms)
    return F.when(a.isNotNull() & b.isNotNull(), F.coalesce(ratio, F.lit(0.0)))


def euclid(a: Column, b: Column) -> Column:
    return F.sqrt(_fold(a, b, lambda x, y: (x - y) * (x - y)))


def manhattan(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: F.abs(x - y))


def distance(metric: str, a: Column, b: Column) -> Column:
    check_metric(metric)
    return {"Cosine": cosine, "Dot": dot, "Euclid": euclid, "Manhattan": manhattan}[metric](a, b)


def significant(scores: np.ndarray, digits: int = SCORE_DIGITS) -> np.ndarray:
    """Scores cut to their leading digits; NaN and infinities stay."""
    usable = np.isfinite(scores) & (np.abs(scores) > 1e-280) & (np.abs(scores) < 1e280)
    size = np.floor(np.log10(np.abs(scores), out=np.zeros_like(scores), where=usable))
    scale = np.power(10.0, digits - 1 - size)
    cut = np.divide(np.rint(scores * scale), scale, out=scores.copy(), where=usable)
    return cut + 0.0  # + 0.0 turns -0.0 into 0.0


def usable_rows(vectors: pa.Array, dim: int) -> np.ndarray:
    """Which vectors can be compared: those that are there, have `dim` elements and only finite ones."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    usable = sizes == dim
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(vectors)), np.maximum(sizes, 0))
    usable[row[~np.isfinite(values)]] = False
    return usable


def to_matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """An Arrow list array as a (rows, dim) matrix of doubles."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten()
    if vectors.null_count or flat.null_count or len(flat) != len(vectors) * dim:
        raise ValueError(f"vectors must be non-null and have {dim} elements")
    sizes = np.diff(vectors.offsets.to_numpy())
    if len(sizes) and (sizes != dim).any():
        raise ValueError(f"vectors must have {dim} elements")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def raw_scores(metric: str, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Scores before they are cut to SCORE_DIGITS digits, one row per query, one column per point."""
    if metric in ("Cosine", "Dot"):
        scores = queries @ points.T
        if metric == "Cosine":
            norms = np.outer(np.linalg.norm(queries, axis=1), np.linalg.norm(points, axis=1))
            scores = np.divide(scores, norms, out=np.zeros_like(scores), where=norms > 0)
    else:
        scores = np.empty((len(queries), len(points)))
        for row, query in enumerate(queries):
            gap = points - query
            if metric == "Euclid":
                scores[row] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            else:
                scores[row] = np.abs(gap).sum(axis=1)
    return scores


def score_matrix(metric: str, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Scores of SCORE_DIGITS digits, one row per query, one column per point."""
    return significant(raw_scores(metric, queries, points))


def score_against(metric: str, embedding: Column, query_vector: list[float]) -> Column:
    """The score of each vector in a column against one query vector; NULL if they cannot be compared.

    Declared nondeterministic, so that a filter on the score does not make Spark work it out a second time.
    """
    check_metric(metric)
    query = np.asarray([query_vector], dtype=np.float64)

    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        return scores_against(metric, query, vectors)

    return score.asNondeterministic()(embedding)


def scores_against(metric: str, query: np.ndarray, vectors: pa.Array) -> pa.Array:
    """Scores of vectors against one query, a matrix of one row; NULL for those that cannot be compared."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    usable = usable_rows(vectors, query.shape[1])
    scores = np.zeros(len(vectors))
    chosen = vectors.filter(pa.array(usable))
    scores[usable] = score_matrix(metric, query, to_matrix(chosen, query.shape[1]))[0]
    return pa.array(scores, mask=~usable)
