"""Ranked lexical search: items' terms times documents' impacts, as blocked dense matrix products that are exact."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farsight.llm.common import Tables

#: Items are searched for in blocks of about this many bytes of text, one after the other.
MAX_BLOCK_BYTES = 8 << 20
#: Items and documents of a tile, and the most terms multiplied at once.
TILE_ITEMS, TILE_DOCS, TILE_TERMS = 256, 2048, 4096
#: Doubles hold integers below this exactly, whatever the order of a sum.
EXACT = 1 << 53
#: An impact is below this: (10^9 tf) div (1000 tf + 20 m) with m > 0.
IMPACT = 1_000_000

# Terms are runs of ASCII letters and digits and of all that is not ASCII; letters A-Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TERM_BYTES).split()


class ItemBlock:
    """Some items: their distinct terms, numbered, and for each item the numbers of its terms."""

    def __init__(self, ids: list, texts: list[bytes | None]):
        self.ids = ids
        self.number: dict[bytes, int] = {}
        self.terms = [
            sorted({self.number.setdefault(t, len(self.number)) for t in terms_of(text or b"")}) for text in texts
        ]


class ItemTiles:
    """Up to TILE_ITEMS items each, with the weights of their terms: a compact vocabulary and rows (term, item, weight)."""

    def __init__(self, block: ItemBlock, weights: np.ndarray):
        self.tiles = []
        self.weights = weights
        for start in range(0, len(block.terms), TILE_ITEMS):
            lists = block.terms[start : start + TILE_ITEMS]
            term = np.fromiter((t for each in lists for t in each), np.int64)
            item = np.repeat(np.arange(len(lists)), [len(each) for each in lists])
            order = np.argsort(term, kind="stable")
            vocabulary, first = np.unique(term[order], return_index=True)
            self.tiles.append((start, len(lists), vocabulary, np.append(first, len(term)), item[order]))


def tile_scores(
    tile: tuple, weights: np.ndarray, docs: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray
) -> np.ndarray | None:
    """Scores (documents, items) of a tile as 64-bit integers, or None if no term of the items occurs.

    Terms that do not occur in these documents are left out; the rest is multiplied in pieces so narrow that no partial sum
    reaches 2^53, whatever its order, and pieces are added as integers.
    """
    _, items, vocabulary, first, item = tile
    at = np.searchsorted(vocabulary, term)
    met = at < len(vocabulary)
    met[met] = vocabulary[at[met]] == term[met]
    if not met.any():
        return None
    row, impact = row[met], impact[met]
    used, column = np.unique(at[met], return_inverse=True)
    heaviest = int(weights[vocabulary[used]].max(initial=1))
    width = max(1, min(TILE_TERMS, (EXACT - 1) // (IMPACT * max(1, heaviest))))
    total = np.zeros((docs, items), np.int64)
    for low in range(0, len(used), width):
        piece = used[low : low + width]
        sizes = first[piece + 1] - first[piece]
        cells = np.repeat(first[piece], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        right = np.zeros((len(piece), items))
        right[np.repeat(np.arange(len(piece)), sizes), item[cells]] = np.repeat(weights[vocabulary[piece]], sizes)
        here = (column >= low) & (column < low + width)
        left = np.zeros((docs, len(piece)))
        left[row[here], column[here] - low] = impact[here]
        total += (left @ right).astype(np.int64)
    return total


class TopDocuments:
    """The best documents of one item: by score, then id, ids that are null last. Ties at the border are settled by id."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.scores, self.ids, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def offer(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        keep = scores >= self.floor
        self.scores = np.concatenate([self.scores, scores[keep]])
        self.ids, self.null = np.concatenate([self.ids, ids[keep]]), np.concatenate([self.null, null[keep]])
        if len(self.scores) >= self.k:
            best = np.lexsort((self.ids, self.null, -self.scores))[: self.k]
            self.scores, self.ids, self.null = self.scores[best], self.ids[best], self.null[best]
            self.floor = int(self.scores[-1])


def _item_blocks(items: DataFrame, max_bytes: int) -> Iterator[ItemBlock]:
    """Items (item, text), dealt by hash into blocks of about `max_bytes`, which are brought one at a time."""
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(64))).first()[0] or 0
    count = max(1, math.ceil(size / max_bytes))
    for number in range(count):
        block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == number).toArrow()
        texts = block.column("text").combine_chunks().cast(pa.binary()).to_pylist()
        yield ItemBlock(block.column("item").to_pylist(), texts)


def _count_terms(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """(doc, n, terms, counts) of every document with a term: n counts all its terms, the lists hold those of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column("text").cast(pa.large_binary()):
                words = terms_of(text.as_py() or b"")
                found = Counter(map(number.get, words))
                found.pop(None, None)
                sizes.append(len(words))
                terms.append(list(found.keys()))
                counts.append(list(found.values()))
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int32())),
                ],
                ["doc", "n", "terms", "counts"],
            )
            yield out.filter(pa.array(np.array(sizes) > 0))

    return docs.mapInArrow(run, "doc long, n long, terms array<int>, counts array<int>")


def _best_of_tasks(counted: DataFrame, shared: Broadcast, documents: int, all_terms: int, k: int) -> DataFrame:
    """(item, doc, score, task): the best k documents of each item within each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, top = shared.value, {}
        for batch in batches:
            for low in range(0, len(batch), TILE_DOCS):
                part = batch.slice(low, TILE_DOCS)
                doc, n, terms, counts = part.columns
                null = doc.is_null().to_numpy(zero_copy_only=False)
                ids = doc.fill_null(0).to_numpy()
                row = np.repeat(np.arange(len(part)), terms.value_lengths().to_numpy())
                tf = counts.flatten().to_numpy().astype(np.int64)
                m = 50 + (50 * n.to_numpy() * documents) // all_terms
                impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[row])
                term = terms.flatten().to_numpy().astype(np.int64)
                for tile in tiles.tiles:
                    scores = tile_scores(tile, tiles.weights, len(part), row, term, impact)
                    if scores is None:
                        continue
                    for item in np.flatnonzero(scores.any(axis=0)):
                        top.setdefault(tile[0] + int(item), TopDocuments(k)).offer(scores[:, item], ids, null)
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        for item, best in top.items():
            order = np.lexsort((best.ids, best.null, -best.scores))[:k]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(order), item, np.int32)),
                    pa.array(best.ids[order], mask=best.null[order]),
                    pa.array(best.scores[order]),
                    pa.array(np.full(len(order), task, np.int32)),
                ],
                ["item", "doc", "score", "task"],
            )

    return counted.mapInArrow(run, "item int, doc long, score long, task int")


def search_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 50,
    max_block_bytes: int = MAX_BLOCK_BYTES,
) -> DataFrame:
    """The k best documents of each item: item id, rank (from 1), document id, score; ties by ascending document id.

    An item's score for a document sums, over the item's distinct terms, an idf weight floor(1000 ln((2N+2)/(2df+1))) times an
    impact (10^9 tf) div (1000 tf + 20 m), m = 50 + (50 n N) div L: whole numbers. Only scores above 0 count. A null text
    has no terms; a document without terms takes no part, not even in N. Rows of one document id are documents of their own, and so are
    rows of one item id, each with ranks of its own; a null document id comes after all others of its score. Ids of documents must be whole
    numbers; other columns are not read. Empty tables give no rows.

    Items come in blocks of `max_block_bytes`. For each, the documents are read once; what they hold of the block's terms is written as
    lists of numbers, from which N, L and df are counted, and which a second pass multiplies with the weights. Each
    task keeps k rows an item, ties settled by id; these are cut once more by groups of tasks before all meet, so no task gathers more than k
    rows of each of a bounded number of parts.
    """
    spark = docs.sparkSession
    words = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    kinds = docs.schema[id_col].dataType, items.schema[item_col].dataType
    if kinds[0].typeName() not in ("long", "integer", "short", "byte"):
        raise ValueError(f"{id_col} must hold whole numbers")
    wanted = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    found = []
    for block in _item_blocks(wanted, max_block_bytes):
        with Tables(spark) as tables:
            counted = tables.save(_count_terms(words, tables.share(block.number)), "terms")
            sizes = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
            documents, all_terms = sizes[0], sizes[1] or 0
            held = counted.select(F.explode("terms").alias("term")).groupBy("term").count()
            df = np.zeros(len(block.number), np.int64)
            for term, count in held.toLocalIterator():
                df[term] = count
            weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
            best = _best_of_tasks(counted, tables.share(ItemTiles(block, weights)), documents, all_terms, k)
            groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
            order = [F.desc("score"), F.asc_nulls_last("doc")]
            for keys in (["item", "salt"], ["item"]):
                best = best.withColumn("salt", F.col("task") % groups) if "salt" in keys else best
                place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
                best = best.withColumn("rank", place).filter(F.col("rank") <= k)
            names = spark.createDataFrame(
                pa.table({"item": pa.array(range(len(block.ids)), pa.int32()), "id": _as(block.ids, kinds[1])})
            )
            best = best.join(F.broadcast(names), "item").select(
                F.col("id").cast(kinds[1]).alias(item_col), "rank", F.col("doc").cast(kinds[0]).alias(id_col), "score"
            )
            found.append(tables.keep(best, "ranked"))
    return reduce(DataFrame.unionAll, found)


def _as(values: list, kind) -> pa.Array:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.array(values, to_arrow_type(kind))
