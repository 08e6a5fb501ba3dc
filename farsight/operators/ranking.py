"""Ranking points for queries: one vector leg per query and one leg per keyword.

A leg is a ranking of points by their distance to the query vector; a keyword leg ranks only the
points whose index tokens contain the keyword. All legs of all queries come out of one pass over
the points: each task scores its Arrow batches with a matrix product and keeps the best few rows
per leg, so what is shuffled depends on the number of legs, not on the number of points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.distance import METRICS, best_first, raw_scores, significant, to_matrix, usable_rows
from ..functions.text import index_tokens
from ..session import fresh_folder, shuffles_deleted
from ..sources.postings import points_with

VECTOR_LEG = ""  # no keyword is empty
DEFAULT_LIMIT = 10
RRF_CONSTANT = 60

# Queries are sent to the tasks in blocks of about this size; more queries are more passes over the points, which stay
# where they are.
MAX_BLOCK_BYTES = 8 * 1024 * 1024
SCORES_PER_BLOCK = 4_000_000
# Queries of one tile of scores, and candidates that may wait for their legs to be cut, or as many as the legs have.
TILE_QUERIES = 512
WAITING = 500_000
# The pairs of a point and a query that are worth a task, and the points of a packed row, at most.
PAIRS_PER_TASK = 100_000_000
PACKED_POINTS = 4096
# Packed rows of a file: a reader holds as many at once.
PACKED_ROWS = 8
# The legs of a query from up to so many slices are sorted at once.
MAX_SLICES_AT_ONCE = 64
# Points named by postings are broadcast up to this many bytes, which are counted.
MAX_NAMED_BYTES = 16 * 1024 * 1024

CANDIDATE_SCHEMA = (
    "query_key string, hybrid boolean, leg string, id string, score double, task int"
)


@dataclass(frozen=True)
class LegLimits:
    """How many rows of each leg take part in the fusion, given the rows wanted in the end."""

    wanted: int

    @property
    def vector(self) -> int:
        return max(10 * self.wanted, 50)

    @property
    def keyword(self) -> int:
        return max(4 * self.wanted, 20)


@dataclass
class QueryBlock:
    """A bounded number of queries: keys, vectors and keywords."""

    keys: list[str]
    vectors: np.ndarray
    keywords: list[list[str]]

    @classmethod
    def from_arrow(cls, table: pa.Table, dim: int) -> QueryBlock:
        return cls(
            table.column("query_key").to_pylist(),
            to_matrix(table.column("query_vector"), dim),
            table.column("keywords").to_pylist(),
        )

    def vocabulary(self) -> list[str]:
        return sorted({word for words in self.keywords for word in words})


def _margin(goodness: np.ndarray) -> np.ndarray:
    """What raw scores may lack and still equal this goodness once both are cut to their digits, and more."""
    return np.abs(goodness) * 1e-10


class LegRanker:
    """The best points of each leg over a stream of blocks; equal scores go by id.

    Scores are worked out tile by tile, TILE_QUERIES queries by as many points as SCORES_PER_BLOCK allow. What reaches
    a leg's floor, the score of its last place, is set aside; now and then all that was set aside is sorted by leg, score and
    id, cut to the legs' limits, and the floors rise. Only scores that reach a floor are cut to their digits.
    """

    def __init__(self, queries: QueryBlock, metric: str, limits: LegLimits, vector_legs: bool = True):
        self.queries = queries
        self.metric = metric
        self.sign = 1.0 if METRICS[metric] else -1.0
        self.vocabulary = pa.array(queries.vocabulary(), pa.string())
        place = {word: at for at, word in enumerate(self.vocabulary.to_pylist())}
        ranked = len(queries.keys) if vector_legs else 0
        asked = [(q // TILE_QUERIES, place[word], q) for q, words in enumerate(queries.keywords) for word in words]
        tile, word, query = np.array(sorted(asked), np.int64).reshape(-1, 3).T
        self.has_vector_legs = vector_legs
        self.query_of = np.concatenate([np.arange(ranked), query])
        self.word_of = np.concatenate([np.full(ranked, -1), word])
        self.limit = np.where(self.word_of < 0, limits.vector, limits.keyword)
        #: For each tile of queries: the legs of each word.
        self.keyword_legs: list[dict[int, np.ndarray]] = [{} for _ in range(0, len(queries.keys), TILE_QUERIES)]
        starts = np.flatnonzero((np.diff(tile, prepend=-1) != 0) | (np.diff(word, prepend=-1) != 0))
        for start, legs in zip(starts, np.split(ranked + np.arange(len(query)), starts[1:])):
            self.keyword_legs[tile[start]][int(word[start])] = legs
        self.floor = np.full(len(self.limit), -math.inf)
        #: (leg, goodness, number of the point), those set aside last; the first is what the last cut has left.
        self.held = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
        self.waiting = 0
        self.ids, self.numbered = [pa.array([], pa.string())], 0

    def add(self, ids: pa.Array, vectors: pa.Array, tokens: pa.Array | None) -> None:
        """Rank these points too; those whose vector cannot be compared, or who have no id, are in no leg."""
        usable = usable_rows(vectors, self.queries.vectors.shape[1])
        usable &= ids.is_valid().to_numpy(zero_copy_only=False)
        if not usable.all():
            usable = pa.array(usable)
            ids, vectors = ids.filter(usable), vectors.filter(usable)
            tokens = None if tokens is None else tokens.filter(usable)
        step = SCORES_PER_BLOCK // max(1, min(TILE_QUERIES, len(self.queries.keys)))
        for start in range(0, len(ids), step):
            part = slice(start, start + step)
            self._add_block(ids[part], vectors[part], None if tokens is None else tokens[part])

    def add_packed(self, packed: pa.RecordBatch) -> None:
        """Rank points from `_packed_points` too."""
        ids, vectors, words, ends, rows = (packed.column(name).flatten() for name in ("ids", "vectors", "words", "ends", "rows"))
        dim, step = self.queries.vectors.shape[1], SCORES_PER_BLOCK // max(1, min(TILE_QUERIES, len(self.queries.keys)))
        points = vectors.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)
        ends, rows = ends.to_numpy(), rows.to_numpy()
        found = pc.index_in(words, value_set=self.vocabulary)
        known = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        of = found.drop_null().to_numpy().tolist()
        lists = [(word, rows[ends[at - 1] if at else 0 : ends[at]]) for word, at in zip(of, known.tolist())]
        for start in range(0, len(ids), step):
            own = lists
            if len(ids) > step:
                bounds = [(word, each, *np.searchsorted(each, (start, start + step))) for word, each in lists]
                own = [(word, each[lo:hi] - start) for word, each, lo, hi in bounds if lo < hi]
            self._add_points(ids[start : start + step], points[start : start + step], own)

    def _add_block(self, ids: pa.Array, vectors: pa.Array, tokens: pa.Array | None) -> None:
        points = to_matrix(vectors, self.queries.vectors.shape[1])
        by_word = [] if tokens is None or not len(self.vocabulary) else list(self._rows_by_keyword(tokens))
        self._add_points(ids, points, by_word)

    def _add_points(self, ids: pa.Array, points: np.ndarray, by_word: list[tuple[int, np.ndarray]]) -> None:
        """Rank these points too, given the rows of them that hold each keyword."""
        self.ids.append(ids)
        first, self.numbered = self.numbered, self.numbered + len(ids)
        numbers = np.arange(first, self.numbered)
        for at, legs_of in enumerate(self.keyword_legs):
            start = at * TILE_QUERIES
            vectors_of = self.queries.vectors[start : start + TILE_QUERIES]
            goodness = self.sign * raw_scores(self.metric, vectors_of, points)
            if self.has_vector_legs:
                self._offer(np.arange(start, start + len(vectors_of)), numbers, goodness)
            for word, rows in by_word:
                legs = legs_of.get(word)
                if legs is not None:
                    self._offer(legs, numbers[rows], goodness[np.ix_(self.query_of[legs] - start, rows)])
        if self.waiting > max(WAITING, len(self.held[0][0])) or self.numbered > 4 * SCORES_PER_BLOCK:
            self._cut()

    def _offer(self, legs: np.ndarray, numbers: np.ndarray, goodness: np.ndarray) -> None:
        """Set aside, of points by their numbers, what may belong to the best; one row of raw `goodness` per leg."""
        floor, limit = self.floor[legs], self.limit[legs[0]]
        enough = goodness >= (floor - _margin(floor))[:, None]
        many = np.flatnonzero(np.count_nonzero(enough, axis=1) > limit)
        if len(many):
            some = goodness[many]
            last = np.partition(some, len(numbers) - limit, axis=1)[:, len(numbers) - limit]
            enough[many] &= some >= (last - _margin(last))[:, None]
        leg, point = np.nonzero(enough)
        if not len(leg):
            return
        exact = significant(goodness[leg, point])
        keep = exact >= floor[leg]
        self.held.append((legs[leg[keep]], exact[keep], numbers[point[keep]]))
        self.waiting += len(self.held[-1][0])

    def _cut(self) -> None:
        """Keep of each leg the best of what was set aside."""
        leg, goodness, number = (np.concatenate(parts) for parts in zip(*self.held))
        used, number = np.unique(number, return_inverse=True)
        ids = pa.concat_arrays(self.ids).take(pa.array(used))
        by_id = np.empty(len(ids), np.int64)
        by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        order = np.lexsort((by_id[number], -goodness, leg))
        leg, goodness, number = leg[order], goodness[order], number[order]
        place = np.arange(len(leg)) - np.searchsorted(leg, leg)
        last = place == self.limit[leg] - 1
        self.floor[leg[last]] = goodness[last]
        kept = place < self.limit[leg]
        used, number = np.unique(number[kept], return_inverse=True)
        self.ids, self.numbered = [ids.take(pa.array(used))], len(used)
        self.held, self.waiting = [(leg[kept], goodness[kept], number)], 0

    def _rows_by_keyword(self, tokens: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        word = pc.index_in(tokens.flatten(), value_set=self.vocabulary)
        sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(tokens)), sizes)
        known = word.is_valid().to_numpy(zero_copy_only=False)
        word, row = word.drop_null().to_numpy(), row[known]
        order = np.argsort(word, kind="stable")
        word, row = word[order], row[order]
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        for start, rows in zip(starts, np.split(row, starts[1:])):
            yield int(word[start]), rows

    def result(self) -> pa.RecordBatch:
        return pa.concat_batches(list(self.results()))

    def results(self, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        """The best of all legs, so many rows at a time; one batch at least."""
        self._cut()
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        keys = pa.array(self.queries.keys, pa.string())
        hybrid = np.array([bool(words) for words in self.queries.keywords], bool)
        names = pa.concat_arrays([self.vocabulary, pa.array([VECTOR_LEG])])
        for start in range(0, max(1, len(self.held[0][0])), rows):
            leg, goodness, number = (part[start : start + rows] for part in self.held[0])
            query = self.query_of[leg]
            columns = [
                keys.take(pa.array(query)),
                pa.array(hybrid[query]),
                names.take(pa.array(self.word_of[leg] % len(names))),
                self.ids[0].take(pa.array(number)),
                # + 0.0 turns -0.0 into 0.0
                pa.array(self.sign * goodness + 0.0),
                pa.array(np.full(len(leg), task, np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query_key", "hybrid", "leg", "id", "score", "task"])


def _feed(ranker: LegRanker, batch: pa.RecordBatch | pa.Table, prefix: str = "") -> None:
    if isinstance(batch, pa.Table):
        for part in batch.to_batches():
            _feed(ranker, part, prefix)
        return
    has_tokens = f"{prefix}tokens" in batch.schema.names
    ranker.add(
        batch.column(f"{prefix}id"),
        batch.column(f"{prefix}embedding"),
        batch.column(f"{prefix}tokens") if has_tokens else None,
    )


def with_tokens(points: DataFrame) -> DataFrame:
    """`points` with the text index, worked out where it is not stored."""
    if "tokens" in points.columns:
        return points
    return points.withColumn("tokens", index_tokens(F.col("text")))


def candidates_broadcast(
    points: DataFrame,
    queries: QueryBlock,
    metric: str,
    limits: LegLimits,
    vector_legs: bool = True,
    keyword_legs: bool = True,
) -> DataFrame:
    """Candidates of all legs, or of one kind only, for a block of queries small enough to send to every task."""
    vocabulary = queries.vocabulary()
    # Only what ranking needs; texts stay behind until the hits are known.
    columns = ["id", "embedding", "tokens"]
    if not vocabulary or not keyword_legs:
        columns.remove("tokens")
    else:
        points = with_tokens(points)
    shared = points.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = LegRanker(shared.value, metric, limits, vector_legs)
        for batch in batches:
            _feed(ranker, batch)
        yield from ranker.results()

    return points.select(*columns).mapInArrow(run, CANDIDATE_SCHEMA)


def candidates_from_postings(
    parts: Sequence[tuple[DataFrame, DataFrame]],
    shard_digits: int,
    queries: QueryBlock,
    metric: str,
    limits: LegLimits,
) -> DataFrame:
    """Candidates of the keyword legs: of each part of a collection (points, postings of the same rows), only the points that
    the postings name are looked at, with the keywords they hold; no point's own tokens are read.

    The points named go to the points' tasks if they are few enough to be broadcast (they are counted), else both are shuffled
    by id, of which there is one a point.
    """
    words, found = queries.vocabulary(), []
    for points, postings in parts:
        spark = points.sparkSession
        folder = fresh_folder(spark, "named")
        with shuffles_deleted(spark):
            points_with(postings, words).write.parquet(folder)
        named = spark.read.schema("point_id string, tokens array<string>").parquet(folder)
        size = named.agg(F.sum(F.lit(64) + F.length(F.array_join("tokens", " ")))).first()[0] or 0
        # The filter keeps every point; without one Spark does not prune shards by a join.
        placed = named.filter("point_id >= ''")
        if shard_digits:
            placed = placed.withColumn("shard", F.substring("point_id", 1, shard_digits))
        side = F.broadcast(placed) if size <= MAX_NAMED_BYTES else placed
        keys = [key for key in ("point_id", "shard") if key in placed.columns]
        chosen = points.drop("tokens").join(side, keys).select("id", "embedding", "tokens")
        found.append(candidates_broadcast(chosen, queries, metric, limits, vector_legs=False))
    return reduce(DataFrame.unionAll, found)


def query_blocks(queries: DataFrame, dim: int, max_bytes: int = MAX_BLOCK_BYTES) -> Iterator[QueryBlock]:
    """The queries (query_key, keywords, query_vector; saved) in blocks of about `max_bytes`, brought one by one.

    Queries are dealt by a hash of their key, so that blocks are alike in size; the number follows from a sum of sizes.
    """
    size = F.length("query_key") + F.length(F.array_join("keywords", " ")) + F.lit(16 + 8 * dim)
    total = queries.agg(F.sum(size.cast("long"))).first()[0] or 0
    count = max(1, math.ceil(total / max_bytes))
    block = F.pmod(F.xxhash64("query_key"), F.lit(count))
    for number in range(count):
        yield QueryBlock.from_arrow(queries.filter(block == number).toArrow(), dim)


def dealing(spark: SparkSession, points: int, queries: int, limits: LegLimits, blocks: int) -> tuple[int, int]:
    """(slices of points, blocks of queries, at least so many) for `candidates_dealt`.

    A task is a slice and a block. Each slice gives every leg its best again, a block costs no more than another reading of the points:
    so there are slices only where the queries are too few to give each task a tile of its own.
    """
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(most, max(spark.sparkContext.defaultParallelism, points * queries // PAIRS_PER_TASK), max(1, points))
    blocks = max(blocks, min(tasks, queries // TILE_QUERIES), 1)
    return min(math.ceil(tasks / blocks), max(1, points // PACKED_POINTS)), blocks


def _streamed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _one_list(values: pa.Array) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array([0, len(values)], pa.int64()), values)


def _packed_points(points: DataFrame, dim: int) -> DataFrame:
    """(points) of points (id, embedding, tokens), saved: PACKED_POINTS or fewer in a row, as an Arrow stream of one row: ids, vectors,
    and of each word the points that hold it. Points that no leg can have are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), PACKED_POINTS):
                part = batch.slice(start, PACKED_POINTS)
                part = part.filter(pa.array(usable_rows(part.column(1), dim)))
                if not len(part):
                    continue
                tokens = part.column(2)
                flat = tokens.flatten().dictionary_encode()
                code = flat.indices.to_numpy(zero_copy_only=False)
                sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(part), dtype=np.int32), sizes)[np.argsort(code, kind="stable")]
                ends = np.cumsum(np.bincount(code, minlength=len(flat.dictionary))).astype(np.int32)
                parts = {"ids": part.column(0), "vectors": part.column(1).flatten(), "words": flat.dictionary, "ends": pa.array(ends), "rows": pa.array(row)}
                packed = pa.RecordBatch.from_pydict({name: _one_list(values) for name, values in parts.items()})
                yield pa.RecordBatch.from_arrays([pa.array([_streamed(packed)], pa.binary())], ["points"])

    spark = points.sparkSession
    folder = fresh_folder(spark, "packed-points")
    with shuffles_deleted(spark):
        packed = points.select("id", "embedding", "tokens").mapInArrow(run, "points binary")
        packed.write.option("maxRecordsPerFile", PACKED_ROWS).parquet(folder)
    return spark.read.schema(packed.schema).parquet(folder)


def _packed_queries(queries: DataFrame) -> DataFrame:
    """One row (queries) of each partition of queries that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [batch for batch in batches if len(batch)]
        if asked:
            columns = [pa.concat_arrays([batch.column(at) for batch in asked]) for at in range(3)]
            whole = pa.RecordBatch.from_arrays(columns, asked[0].schema.names)
            yield pa.RecordBatch.from_arrays([pa.array([_streamed(whole)], pa.binary())], ["queries"])

    return queries.select("query_key", "keywords", "query_vector").mapInArrow(run, "queries binary")


def _read_back(data: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(data.as_buffer()).read_next_batch()


def candidates_dealt(
    points: DataFrame, queries: DataFrame, metric: str, dim: int, limits: LegLimits, blocks: int = 1, slices: int | None = None
) -> DataFrame:
    """Candidates of all legs for a table of queries (query_key, keywords, query_vector), none of which the driver sees.

    Points are packed, some thousands a row, and saved at once, in place; they are read in `slices`, at most, and queries are dealt by a
    hash of their key to `blocks`. Each pair of a slice and a block is a task. However many tasks there are, points are written once and
    queries shuffled once, when the result is read; tasks read them there as often as they need. A task holds one block of queries
    and the best of their legs, and streams its points.
    """
    slices = slices or int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asking = queries.select("query_key", "keywords", F.col("query_vector").cast("array<double>").alias("query_vector"))
    asking = asking.withColumn("block", F.pmod(F.xxhash64("query_key"), F.lit(blocks)).cast("int"))
    asking = _packed_queries(asking.repartitionById(blocks, "block"))
    asked = _packed_points(with_tokens(points.filter("id IS NOT NULL")), dim).coalesce(slices)
    # The pairs are made where they are ranked; a broadcast would pass through the driver.
    pairs = asked.hint("shuffle_replicate_nl").crossJoin(asking)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = None
        for batch in batches:
            for packed, asking in zip(batch.column(0), batch.column(1)):
                if ranker is None:
                    ranker = LegRanker(QueryBlock.from_arrow(pa.Table.from_batches([_read_back(asking)]), dim), metric, limits)
                ranker.add_packed(_read_back(packed))
        if ranker is not None:
            yield from ranker.results()

    return pairs.mapInArrow(run, CANDIDATE_SCHEMA)


def rank_legs(candidates: DataFrame, metric: str, limits: LegLimits, slices: int | None = None) -> DataFrame:
    """Number the rows of each leg from 1 and cut the leg.

    Where each leg comes from few `slices`, all legs of a query go to one task, and stay there for what follows. Else
    twice: first within groups of map tasks, then over all, so that the final sort of a leg sees a
    bounded number of rows however many tasks there were. The cut is written so that Spark can
    also limit each group before the shuffle.
    """
    groups = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [best_first(metric, F.col("score")), F.col("id")]

    def cut(rows: DataFrame, *keys: str) -> DataFrame:
        window = Window.partitionBy("query_key", "leg", *keys).orderBy(*order)
        return rows.withColumn("rank", F.row_number().over(window)).filter(
            (F.col("rank") <= limits.vector)
            & ((F.col("leg") == VECTOR_LEG) | (F.col("rank") <= limits.keyword))
        )

    columns = ["query_key", "hybrid", "leg", "id", "score", "rank"]
    if slices is not None and slices <= MAX_SLICES_AT_ONCE:
        return cut(candidates.drop("task").repartition("query_key")).select(*columns)
    salted = candidates.withColumn("salt", F.col("task") % groups).drop("task")
    return cut(cut(salted, "salt").drop("salt", "rank")).select(*columns)


def fuse(ranked: DataFrame, metric: str, rrf_constant: int = RRF_CONSTANT) -> DataFrame:
    """One score per (query, point): reciprocal ranks summed over the legs the point is in.

    A query without keywords has one leg only and keeps the raw metric. `goodness` sorts both
    kinds best-first when descending. The sum is taken from the smallest term on, so that points of the same ranks,
    whatever the legs, tie exactly; nothing is rounded.
    """
    reciprocal = F.lit(1.0) / (F.lit(float(rrf_constant)) + F.col("rank"))
    sign = 1.0 if METRICS[metric] else -1.0
    return (
        ranked.groupBy("query_key", "id", "hybrid")
        .agg(
            F.aggregate(
                F.sort_array(F.collect_list(reciprocal)), F.lit(0.0), lambda total, term: total + term
            ).alias("fused"),
            F.max("score").alias("raw"),
        )
        .select(
            "query_key",
            "id",
            F.when(F.col("hybrid"), F.col("fused")).otherwise(F.col("raw")).alias("score"),
            F.when(F.col("hybrid"), F.col("fused"))
            .otherwise(F.col("raw") * sign)
            .alias("goodness"),
        )
    )
