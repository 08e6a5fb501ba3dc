"""Hard negatives: exact windowed rankings over blocks of candidates along a Hilbert curve, chosen by interval bounds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farsight.llm.common import Tables, broadcast_if_small
from farsight.session import fresh_folder

#: Rows of a block, which has one zone map.
BLOCK_ROWS = 256
#: Blocks of about this many bytes of vectors share a folder, the unit that is read or not.
FOLDER_BYTES = 2 << 20
#: The curve runs through this many dimensions, those of most spread, each cut to this many bits: 60 bits in all.
CURVE_DIMS, CURVE_BITS = 12, 5
#: Anchors go to the blocks in slabs of about this many bytes, one after the other; each counts this much besides its vector.
SLAB_BYTES, ANCHOR_BYTES = 8 << 20, 200
#: Doubles hold integers below this exactly, whatever the order of a sum.
EXACT = 1 << 53
_ANCHORS_AT_ONCE = 2048
_NONE = -np.iinfo(np.int64).max  # below all scores; can be negated


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of points (rows) with coordinates of `bits` bits each, as 64-bit integers.

    Each level turns one bit of every coordinate into one digit: the Gray code of the bits, seen from the way the
    curve enters the cell; the lower bits are then mirrored and exchanged to fit the next level.
    """
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        high, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for at in range(len(x)):
            mirrored = (x[at] & high) != 0
            apart = (x[0] ^ x[at]) & low
            x[0] ^= np.where(mirrored, low, apart)
            if at:
                x[at] ^= np.where(mirrored, np.uint64(0), apart)
    for at in range(1, len(x)):
        x[at] ^= x[at - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn ^= np.where((x[-1] & bit) != 0, bit - one, np.uint64(0))
    x ^= turn
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for row in x:
            place = (place << one) | ((row >> np.uint64(level)) & one)
    return place.astype(np.int64)


def products(left: np.ndarray, right: np.ndarray, exact_doubles: bool) -> np.ndarray:
    """left @ right.T of whole numbers as 64-bit integers, by BLAS where doubles hold every partial sum exactly."""
    if exact_doubles:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


def bounds(
    anchors: np.ndarray, low: np.ndarray, high: np.ndarray, exact_doubles: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible inner product of each anchor (row) with a vector within each box (column)."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return (
        products(plus, low, exact_doubles) + products(minus, high, exact_doubles),
        products(plus, high, exact_doubles) + products(minus, low, exact_doubles),
    )


class Best:
    """The k best (score, id) of each of n searches: higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), _NONE)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def rows(self) -> pa.RecordBatch:
        """What was found: search, id, score, task."""
        search, at = np.nonzero(self.scores != _NONE)
        context = TaskContext.get()
        task = np.full(len(search), context.partitionId() if context else 0, np.int32)
        columns = [search, self.ids[search, at], self.scores[search, at], task]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["search", "id", "score", "task"])

    def offer(self, which: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Rows of `scores` belong to the searches `which`; only what is `allowed` counts."""
        allowed = allowed & (scores >= self.scores[which, -1][:, None])
        some = np.flatnonzero(allowed.any(axis=1))
        if not len(some):
            return
        which, k = which[some], self.scores.shape[1]
        all_scores = np.concatenate([self.scores[which], np.where(allowed[some], scores[some], _NONE)], axis=1)
        new = np.where(allowed[some], ids[None, :], np.iinfo(np.int64).max)
        all_ids = np.concatenate([self.ids[which], new], axis=1)
        if all_scores.shape[1] > 4 * k:  # all that reach the k-th best score, ties at the border included
            border = -np.partition(-all_scores, k - 1, axis=1)[:, k - 1]
            width = int((all_scores >= border[:, None]).sum(axis=1).max())
            if width < all_scores.shape[1]:
                part = np.argpartition(-all_scores, width - 1, axis=1)[:, :width]
                all_scores, all_ids = np.take_along_axis(all_scores, part, 1), np.take_along_axis(all_ids, part, 1)
        order = np.lexsort((all_ids, -all_scores), axis=-1)[:, :k]
        self.scores[which] = np.take_along_axis(all_scores, order, 1)
        self.ids[which] = np.take_along_axis(all_ids, order, 1)


@dataclass
class Slab:
    """A bounded number of anchors, with what is known of their scores so far.

    `floors`: no positive of the anchor is below. `low`, `high`: the windows of its positives, none where low > high.
    """

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    floors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    exact: bool

    def for_positives(self, label: int, low: np.ndarray, high: np.ndarray, floors: np.ndarray) -> tuple:
        """Anchors of this label, and which of the boxes (columns) may hold one of their positives."""
        own = np.flatnonzero(self.labels == label)
        _, most = bounds(self.vectors[own], low, high, self.exact)
        return own, most >= floors[own, None]

    def for_windows(self, label: int, low: np.ndarray, high: np.ndarray, floors: np.ndarray) -> tuple:
        """Anchors of other labels, and which of the boxes may hold a row inside one of their windows, from `floors` on."""
        others = np.flatnonzero((self.labels != label) & (self.low <= self.high).any(axis=1))
        least, most = bounds(self.vectors[others], low, high, self.exact)
        met = np.zeros(least.shape, bool)
        for slot in range(self.low.shape[1]):
            bottom = np.maximum(self.low[others, slot], floors[others, slot])
            top = self.high[others, slot]
            met |= (bottom <= top)[:, None] & (most >= bottom[:, None]) & (least <= top[:, None])
        return others, met


def _matrix(values: list[bytes], dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(-1, dim).astype(np.int64)


def _participants(
    rows: DataFrame, chosen: Column, id_col: str, label_col: str, vector_col: str, scale: float
) -> DataFrame:
    """(id, label, v, anchor): rows that take part, components as whole numbers; of rows with one id the least stays."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    taking = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        whole.alias("v"),
        F.coalesce(chosen, F.lit(False)).alias("anchor"),
    )
    counts = taking.agg(F.count("id"), F.count_distinct("id")).first()
    if counts[0] == counts[1]:
        return taking
    least = F.min(F.struct("label", "v", "anchor")).alias("row")
    return taking.groupBy("id").agg(least).select("id", "row.*")


def _padded(lists: pa.Array, dim: int) -> np.ndarray:
    """Lists of whole numbers as rows; shorter ones end in zeros."""
    sizes = lists.value_lengths().to_numpy()
    out = np.zeros((len(lists), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _spread(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Variance, least and greatest component of each dimension; every task sends one row a dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, np.zeros(dim), np.zeros(dim)
        low, high = np.full(dim, np.iinfo(np.int64).max), np.full(dim, _NONE)
        for batch in batches:
            if not len(batch):
                continue
            part = _padded(batch.column("v"), dim)
            n += len(part)
            total += part.sum(axis=0, dtype=float)
            squares += (part.astype(float) ** 2).sum(axis=0)
            low, high = np.minimum(low, part.min(axis=0)), np.maximum(high, part.max(axis=0))
        if n:
            columns = [np.arange(dim), np.full(dim, n), total, squares, low, high]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["d", "n", "s", "q", "l", "h"])

    found = rows.select("v").mapInArrow(run, "d long, n long, s double, q double, l long, h long").groupBy("d")
    found = found.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.min("l"), F.max("h"))
    _, n, total, squares, low, high = (np.array(c) for c in zip(*sorted(found.collect())))
    return squares / n - (total / n) ** 2, low, high


class BlockIndex:
    """Candidates in Parquet blocks, each of one label and a stretch of the Hilbert curve, with zone maps beside them.

    `blocks` (folder, block, label, low, high, ids, anchors, vectors) lies in one folder for about FOLDER_BYTES of
    vectors; `zones` (folder, label, low, high) holds the least and greatest component of each dimension and no more. Arrays
    are binaries of whole numbers, of the narrowest width that all components fit (`kind`).
    """

    def __init__(self, tables: Tables, rows: DataFrame, dim: int, block_rows: int, folder_bytes: int = FOLDER_BYTES):
        self.dim = dim
        variance, least, greatest = _spread(rows, dim)
        most = max(abs(int(least.min())), abs(int(greatest.max())))
        if dim * most**2 >= 2**63:
            raise ValueError("inner products of these vectors do not fit 64 bits")
        self.exact = dim * most**2 < EXACT
        self.kind = kind = next(k for k in ("<i2", "<i4", "<i8") if most < np.iinfo(k).max)
        block_rows = max(1, min(block_rows, folder_bytes // (dim * 8)))
        folder_blocks = max(1, folder_bytes // (block_rows * dim * np.dtype(kind).itemsize))
        chosen = np.argsort(-variance, kind="stable")[:CURVE_DIMS]
        base, step = least[chosen], (greatest[chosen] - least[chosen]) / 2**CURVE_BITS + 1e-9

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = _padded(batch.column("v"), dim)
                cells = np.clip((vectors[:, chosen] - base) // step, 0, 2**CURVE_BITS - 1)
                packed = pa.array([row.tobytes() for row in vectors.astype(kind)], pa.binary())
                columns = [batch.column(c) for c in ("id", "label", "anchor")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, packed, pa.array(hilbert(cells, CURVE_BITS))], ["id", "label", "anchor", "v", "place"]
                )

        placed = rows.mapInArrow(place, "id long, label long, anchor boolean, v binary, place long")
        order = ["label", "place", "id"]
        dealt = tables.save(placed, "placed").repartitionByRange(*order).sortWithinPartitions(*order)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            context = TaskContext.get()
            first = (context.partitionId() if context else 0) << 32
            made, held, label = 0, [], None

            def block() -> pa.RecordBatch:
                ids, anchors, vectors = zip(*held)
                matrix = np.frombuffer(b"".join(vectors), kind).reshape(-1, dim)
                row = {
                    "folder": first + made // folder_blocks,
                    "label": label,
                    "low": matrix.min(axis=0).tobytes(),
                    "high": matrix.max(axis=0).tobytes(),
                    "ids": np.array(ids, np.int64).tobytes(),
                    "anchors": np.array(anchors, bool).tobytes(),
                    "vectors": matrix.tobytes(),
                }
                return pa.RecordBatch.from_pylist([row])

            for batch in batches:
                for id_, own, anchor, vector in zip(*(column.to_pylist() for column in batch.columns)):
                    if held and (own != label or len(held) == block_rows):
                        yield block()
                        made, held = made + 1, []
                    label = own
                    held.append((id_, anchor, vector))
            if held:
                yield block()

        schema = "folder long, label long, low binary, high binary, ids binary, anchors binary, vectors binary"
        packed = dealt.select("id", "label", "anchor", "v").mapInArrow(pack, schema)
        self.blocks = tables.save(packed, "blocks", "folder")
        self.zones = tables.save(self.blocks.select("folder", "label", "low", "high"), "zones")

    def anchors(self, k: int) -> DataFrame:
        """(folder, id, label, v, floor) of the anchors; floor: a score that k other rows of their block, and so of their
        label, reach, or the number below all scores if the block has fewer rows."""
        dim, kind, exact = self.dim, self.kind, self.exact

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for folder, label, ids, chosen, vectors in zip(*(column.to_pylist() for column in batch.columns)):
                    at = np.flatnonzero(np.frombuffer(chosen, bool))
                    if not len(at):
                        continue
                    ids, own = np.frombuffer(ids, np.int64), _matrix([vectors], dim, kind)
                    floors = np.full(len(at), _NONE)
                    if len(ids) > k:
                        scores = products(own[at], own, exact)
                        scores[np.arange(len(at)), at] = _NONE
                        floors = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
                    packed = pa.array([row.tobytes() for row in own[at].astype(kind)], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(np.full(len(at), x)) for x in (folder, label)), pa.array(ids[at]), packed, pa.array(floors)],
                        ["folder", "label", "id", "v", "floor"],
                    )

        columns = self.blocks.select("folder", "label", "ids", "anchors", "vectors")
        return columns.mapInArrow(run, "folder long, label long, id long, v binary, floor long")

    def slab(self, anchors: DataFrame, positives: int) -> Slab:
        """These anchors, of which there are a bounded number, without windows."""
        found = anchors.select("id", "label", "v", "floor").orderBy("id").toArrow()
        ids, labels, floors = (found.column(c).to_numpy() for c in ("id", "label", "floor"))
        vectors = _matrix(found.column("v").to_pylist(), self.dim, self.kind)
        none = np.full((len(ids), positives), _NONE)
        return Slab(ids, labels, vectors, floors, none + 1, none, self.exact)

    def _needed(self, tables: Tables, slab: Broadcast, which: str) -> DataFrame:
        """The blocks of the folders that at least one anchor of the slab must look into, read from those folders only."""
        dim, kind = self.dim, self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors, needed = slab.value, set()
            floors = anchors.floors if which == "for_positives" else anchors.low
            for batch in batches:
                folder, label = (batch.column(c).to_numpy() for c in ("folder", "label"))
                low, high = (_matrix(batch.column(c).to_pylist(), dim, kind) for c in ("low", "high"))
                for each in np.unique(label):
                    at = np.flatnonzero(label == each)
                    for start in range(0, len(at), BLOCK_ROWS):
                        part = at[start : start + BLOCK_ROWS]
                        _, met = getattr(anchors, which)(each, low[part], high[part], floors)
                        needed.update(folder[part[met.any(axis=0)]].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(sorted(needed), pa.int64())], ["folder"])

        found = self.zones.mapInArrow(run, "folder long").distinct()
        chosen = broadcast_if_small(tables.save(found, "needed"), 16)
        # The filter keeps every folder; without one Spark does not prune folders by a join.
        return self.blocks.join(chosen.filter("folder >= 0"), "folder")

    def positives(self, tables: Tables, slab: Broadcast, k: int) -> DataFrame:
        """(search, id, score, task): within each task, the k best other rows of each anchor's label; search is its number."""
        dim, kind = self.dim, self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors = slab.value
            best = Best(len(anchors.ids), k)
            for label, low, high, ids, vectors in _blocks_of(batches, dim, kind):
                floors = np.maximum(anchors.floors, best.scores[:, -1])
                own, met = anchors.for_positives(label, low, high, floors)
                own = own[met[:, 0]]
                for start in range(0, len(own), _ANCHORS_AT_ONCE):
                    part = own[start : start + _ANCHORS_AT_ONCE]
                    scores = products(anchors.vectors[part], vectors, anchors.exact)
                    best.offer(part, scores, ids[None, :] != anchors.ids[part, None], ids)
            yield best.rows()

        blocks = self._needed(tables, slab, "for_positives")
        return blocks.select("label", "low", "high", "ids", "vectors").mapInArrow(run, _FOUND)

    def negatives(self, tables: Tables, slab: Broadcast, k: int) -> DataFrame:
        """(search, id, score, task): within each task, the k best rows of other labels in each window; search is the
        number of the anchor times the number of positives, plus that of the positive."""
        dim, kind = self.dim, self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors = slab.value
            slots = anchors.low.shape[1]
            best = Best(len(anchors.ids) * slots, k)
            for label, low, high, ids, vectors in _blocks_of(batches, dim, kind):
                floors = best.scores[:, -1].reshape(-1, slots)
                others, met = anchors.for_windows(label, low, high, floors)
                others = others[met[:, 0]]
                for start in range(0, len(others), _ANCHORS_AT_ONCE):
                    part = others[start : start + _ANCHORS_AT_ONCE]
                    scores = products(anchors.vectors[part], vectors, anchors.exact)
                    for slot in range(slots):
                        inside = (scores >= anchors.low[part, slot, None]) & (scores <= anchors.high[part, slot, None])
                        best.offer(part * slots + slot, scores, inside, ids)
            yield best.rows()

        blocks = self._needed(tables, slab, "for_windows")
        return blocks.select("label", "low", "high", "ids", "vectors").mapInArrow(run, _FOUND)


_FOUND = "search long, id long, score long, task int"


def _blocks_of(batches: Iterator[pa.RecordBatch], dim: int, kind: str) -> Iterator[tuple]:
    for batch in batches:
        for label, low, high, ids, vectors in zip(*(column.to_pylist() for column in batch.columns)):
            low, high = _matrix([low], dim, kind), _matrix([high], dim, kind)
            yield label, low, high, np.frombuffer(ids, np.int64), _matrix([vectors], dim, kind)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each search with their ranks: within groups of tasks, then over all."""
    groups = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.withColumn("salt", F.col("task") % groups)
    for keys in (["search", "salt"], ["search"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
        found = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return found.select("search", "id", "score", "rank")


def _percent(values: np.ndarray, percent: int) -> np.ndarray:
    """values * percent div 100, rounded down, without leaving 64 bits."""
    return (values // 100) * percent + (values % 100) * percent // 100


def mine_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    block_rows: int = BLOCK_ROWS,
    slab_bytes: int = SLAB_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row that meets the condition
    `anchors` and each of its best `positives` other rows of its label, the best `negatives` rows of another label whose
    score lies between window[0] and window[1] percent of the positive's.

    Scores are inner products of components floor(scale * x), whole numbers; equal scores go by smaller id. The result is exact.
    Rows without id, label or vector, or with a component that is null or not finite, take no part. Of rows with the same id
    the one with the least label, then vector, takes part. Vectors shorter than the longest end in zeros; an empty one scores 0. Scores that
    do not fit 64 bits raise ValueError. Other columns are not read; an empty table, one without anchors and one of a single
    label give no rows.

    The candidates lie in blocks along a Hilbert curve (`BlockIndex`). Anchors go to them in slabs of bounded size, in the order
    of the curve: for each slab, the zone maps say by interval arithmetic which folders can hold a positive (the floor is what the anchor's own
    block gives), those are read, then the same for the windows. Nothing else is shuffled than each task's best few rows.
    """
    spark = rows.sparkSession
    low_percent, high_percent = window
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    found = fresh_folder(spark, "negatives")
    spark.createDataFrame([], result).write.parquet(found)
    with Tables(spark) as tables:
        taking = tables.save(_participants(rows, anchors, id_col, label_col, vector_col, scale), "candidates")
        sizes = taking.agg(F.max(F.size("v")), F.count_if("anchor")).first()
        if not sizes[1]:
            return spark.read.schema(result).parquet(found)
        dim = max(1, sizes[0])
        index = BlockIndex(tables, taking, dim, block_rows)
        chosen = tables.save(index.anchors(positives), "anchors")
        in_folders = sorted(chosen.groupBy("folder").count().collect())
        for first, last in _slabs(in_folders, (dim * np.dtype(index.kind).itemsize + ANCHOR_BYTES), slab_bytes):
            with Tables(spark) as here:
                slab = index.slab(chosen.filter(F.col("folder").between(first, last)), positives)
                best = here.save(_first(index.positives(here, here.share(slab), positives), positives), "positives")
                search, id_, score, rank = zip(*best.collect()) if not best.isEmpty() else [()] * 4
                search, slot, score = np.array(search, int), np.array(rank, int) - 1, np.array(score, np.int64)
                slab.low[search, slot] = -_percent(-score, low_percent)
                slab.high[search, slot] = _percent(score, high_percent)
                hard = _first(index.negatives(here, here.share(slab), negatives), negatives)
                slots = F.lit(positives)
                named = best.select(
                    (F.col("search") * slots + F.col("rank") - 1).alias("search"),
                    F.col("search").alias("anchor"),
                    F.col("id").alias("positive_id"),
                    F.col("score").alias("positive_score"),
                )
                ids = spark.createDataFrame(pa.table({"anchor": np.arange(len(slab.ids)), "anchor_id": slab.ids}))
                hard.join(F.broadcast(named), "search").join(F.broadcast(ids), "anchor").select(
                    "anchor_id",
                    "positive_id",
                    "rank",
                    F.col("id").alias("negative_id"),
                    "positive_score",
                    F.col("score").alias("negative_score"),
                ).write.mode("append").parquet(found)
    return spark.read.schema(result).parquet(found)


def _slabs(in_folders: list[tuple[int, int]], each: int, most: int) -> Iterator[tuple[int, int]]:
    """Runs of folders, first to last, whose anchors together take about `most` bytes; a folder holds a bounded number."""
    first, size = None, 0
    for folder, count in in_folders:
        if first is not None and size + count * each > most:
            yield first, last
            first, size = None, 0
        first, last, size = folder if first is None else first, folder, size + count * each
    if first is not None:
        yield first, last
