"""Vectors in k-means cells, and an exact top-k that reads only the cells that can hold a hit.

    <folder>/cell=<number>/     (id, embedding)

Each cell keeps its centre and its radius, the greatest distance of a vector in it from the centre. For a query they bound the best
score any vector of the cell can have, for each of the four metrics; cells are visited from the best bound on, until none is
left that could hold a hit better than those found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import METRICS, best_first, score_against, to_matrix, usable_rows
from ..session import fresh_folder
from .collection import Collection

#: Cells are at most so many, since centres and radii go to the driver; each is fitted on about so many vectors of a sample.
MAX_CELLS, SAMPLE_PER_CELL = 16_384, 64
#: Cells read in the first round; each later one reads twice as many.
FIRST_CELLS = 4
#: Bounds are widened by this share, for what rounding may take from them.
SLACK = 1e-9
_ROWS_AT_ONCE = 4096


@dataclass
class CellHits:
    """Hits (id, score), best first, and how many of the cells that hold points were read for them."""

    hits: DataFrame
    cells_read: int
    cells: int


@dataclass(frozen=True)
class CellIndex:
    """The cells of a collection. For Cosine, distances to centres are those of vectors scaled to unit length."""

    collection: Collection
    vectors: DataFrame
    numbers: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    counts: np.ndarray

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """For each cell, a value that the goodness (the score, negative for distances) of no vector in it exceeds."""
        metric = self.collection.distance
        gap = self.centres - query
        if metric == "Euclid":
            bound, size = self.radii - np.linalg.norm(gap, axis=1), np.abs(self.radii) + np.linalg.norm(gap, axis=1)
        elif metric == "Manhattan":
            bound, size = self.radii - np.abs(gap).sum(axis=1), np.abs(self.radii) + np.abs(gap).sum(axis=1)
        else:
            norm = np.linalg.norm(query)
            if metric == "Cosine":
                query, norm = query / (norm or 1.0), 1.0 if norm else 0.0
            bound = self.centres @ query + norm * self.radii
            size = norm * (np.linalg.norm(self.centres, axis=1) + self.radii)
        bound = bound + SLACK * (1 + size)
        return np.minimum(bound, 0.0) if metric in ("Euclid", "Manhattan") else bound

    def topk(self, query_vector: Sequence[float], limit: int, offset: int = 0, probes: int | None = None) -> CellHits:
        """The nearest points, equal scores by id: the same as a scan of all gives.

        `probes` reads so many cells, those of the best bounds, and no more: an approximation, whose recall depends on the data.
        """
        wanted = limit + offset
        query = np.asarray(query_vector, dtype=np.float64)
        bounds = self.bounds(query)
        order = np.argsort(-bounds, kind="stable")
        most = len(order) if probes is None else min(probes, len(order))
        metric, spark = self.collection.distance, self.vectors.sparkSession
        sign, score = (1.0 if METRICS[metric] else -1.0), score_against(metric, F.col("embedding"), list(query))
        best = [best_first(metric, F.col("score")), F.col("id")]
        found = fresh_folder(spark, "cell-hits")
        read, step, floor = 0, max(1, FIRST_CELLS), -math.inf
        while read < most and bounds[order[read]] >= floor:
            cells = order[read : min(most, read + step)]
            cells = cells[bounds[cells] >= floor]
            rows = self.vectors.filter(F.col("cell").isin(self.numbers[cells].tolist()))
            rows = rows.select("id", score.alias("score")).filter("score IS NOT NULL").orderBy(*best).limit(wanted)
            rows.write.mode("append").parquet(found)
            read, step = read + len(cells), 2 * step
            so_far = spark.read.schema("id string, score double").parquet(found).orderBy(*best).limit(wanted)
            worst = so_far.agg(F.count(F.lit(1)), F.min(F.col("score") * sign)).first()
            floor = worst[1] if worst[0] == wanted and wanted else -math.inf
        if not read:
            return CellHits(spark.createDataFrame([], "id string, score double"), 0, len(order))
        hits = spark.read.schema("id string, score double").parquet(found)
        return CellHits(hits.orderBy(*best).offset(offset).limit(limit), read, len(order))


def build_cells(collection: Collection, folder: str | None = None, cells: int | None = None) -> CellIndex:
    """Cells of all points whose vectors can be compared; `cells` of them at most, by default half the root of the number of points.

    Centres are fitted on the different vectors of a sample of about SAMPLE_PER_CELL a cell, chosen by a hash of the id; every point is then
    put into the cell of the nearest centre. One pass finds the cells, with one shuffle by cell for the files.
    """
    points, dim, unit = collection.points, collection.vector_size, collection.distance == "Cosine"
    spark = points.sparkSession
    folder = folder or fresh_folder(spark, "cells")
    usable = points.select("id", "embedding").filter(F.col("id").isNotNull())

    def vectors_of(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
        batch = batch.filter(pa.array(usable_rows(batch.column("embedding"), dim)))
        matrix = to_matrix(batch.column("embedding"), dim)
        if unit:
            norms = np.linalg.norm(matrix, axis=1, keepdims=True)
            matrix = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
        return batch, matrix

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, matrix = vectors_of(batch)
            yield pa.RecordBatch.from_arrays([pa.array(list(matrix), pa.list_(pa.float64()))], ["v"])

    n = usable.count()
    wanted = min(MAX_CELLS, max(1, round(math.sqrt(n) / 2) if cells is None else cells))
    share = min(1.0, wanted * SAMPLE_PER_CELL / max(1, n))
    chosen = usable.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    sample = chosen.mapInArrow(prepare, "v array<double>").distinct().select(array_to_vector("v").alias("features"))
    fitted = min(wanted, sample.count())  # no more cells than different vectors
    centres = np.zeros((1, dim))
    if fitted > 1:
        centres = np.array(KMeans(k=fitted, maxIter=10, seed=1).fit(sample).clusterCenters())
    shared = spark.sparkContext.broadcast(centres)
    order = 1 if collection.distance == "Manhattan" else 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        squares = (centres**2).sum(axis=1)
        for batch in batches:
            batch, matrix = vectors_of(batch)
            for start in range(0, len(batch), _ROWS_AT_ONCE):
                part = matrix[start : start + _ROWS_AT_ONCE]
                cell = np.argmin(squares - 2 * part @ centres.T, axis=1)
                gap = np.linalg.norm(part - centres[cell], ord=order, axis=1)
                rows = batch.slice(start, _ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(cell.astype(np.int32)), pa.array(gap)], ["id", "embedding", "cell", "gap"]
                )

    placed = usable.mapInArrow(place, "id string, embedding array<float>, cell int, gap double")
    # A cell may hold a third of all points: each is dealt over several tasks.
    spread = F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(8 * n / wanted / 1_000_000))))
    placed.repartition("cell", spread).write.partitionBy("cell").parquet(folder)
    stored = spark.read.schema("id string, embedding array<float>, gap double, cell int").parquet(folder)
    sizes = stored.groupBy("cell").agg(F.max("gap"), F.count(F.lit(1))).orderBy("cell").collect()
    numbers = np.array([row[0] for row in sizes], int)
    radii, counts = (np.array([row[at] for row in sizes], float) for at in (1, 2))
    return CellIndex(collection, stored.select("id", "embedding", "cell"), numbers, centres[numbers], radii, counts)
