"""Benchmark decontamination: fingerprints of item-sized windows, Hamming search, exact shingle similarity."""

from __future__ import annotations

import functools
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from farsight.llm.common import broadcast_if_small, fresh_name, keyed, saved
from farsight.llm.tokens import GOLDEN, SHINGLE, Words, mixed, pieces, words_of

#: Bits of a fingerprint, in so many blocks; every fingerprint within RADIUS has a block within RADIUS // BLOCKS.
BITS, BLOCKS, RADIUS, THRESHOLD = 64, 4, 11, 0.8
#: Windows begin at each STRIDE-th word; items are indexed without their first 0 .. STRIDE - 1 words, so none is passed
#: over. For items of fewer than 2 * STRIDE words windows begin at every word.
STRIDE = 4
#: Words of the items that are sought at once; more items take more passes over the documents.
ITEM_WORDS = 200_000
_SPAN = 16384


def _pairs(words: np.ndarray) -> np.ndarray:
    """Hash of each word with the next; a fingerprint's features."""
    with np.errstate(over="ignore"):
        return mixed(words[:-1] * GOLDEN + words[1:])


def _signs(hashes: np.ndarray, kind: type) -> np.ndarray:
    signs = np.unpackbits(hashes.view(np.uint8)).view(np.int8)
    signs += signs
    signs -= 1
    return signs.reshape(-1, BITS).astype(kind)


def _running(rows: np.ndarray, block: int = 32) -> np.ndarray:
    """Running sums down the rows, by blocks of rows: whole-row additions instead of steps down each column."""
    n = len(rows)
    out = np.zeros((-(-n // block), block, rows.shape[1]), rows.dtype)
    out.reshape(-1, rows.shape[1])[:n] = rows
    for k in range(1, block):
        out[:, k] += out[:, k - 1]
    before = np.zeros((len(out), 1, rows.shape[1]), rows.dtype)
    np.add.accumulate(out[:-1, -1], axis=0, out=before[1:, 0])
    out += before
    return out.reshape(-1, rows.shape[1])[:n]


def fingerprint(words: np.ndarray) -> int:
    """SimHash of a window's word pairs; of a single word, its hash."""
    if len(words) < 2:
        return int(words[0])
    sums = _signs(_pairs(words), np.int32).sum(axis=0)
    return int(np.packbits(sums > 0).view(np.uint64)[0])


def _near_blocks(value: int, radius: int) -> list[int]:
    width = BITS // BLOCKS
    return [value ^ sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


class ItemIndex:
    """Items by window size: their fingerprints, and for each block which values come near one of them."""

    def __init__(self, items: tuple[tuple[int, str], ...], radius: int = RADIUS, stride: int = STRIDE):
        self.radius, self.stride = radius, stride
        words = words_of(pa.array([text for _, text in items], pa.string()))
        self.items = [(item, words.hashes[a:b]) for (item, _), a, b in zip(items, words.first, words.first[1:]) if b > a]
        self.shingles = [window_shingles(own) for _, own in self.items]
        sizes = defaultdict(list)
        for at, (_, own) in enumerate(self.items):
            step = stride if len(own) >= 2 * stride else 1
            for skipped in range(step):
                sizes[len(own) - skipped, step].append((fingerprint(own[skipped:]), at, skipped))
        self.by_size = {}
        for size, entries in sorted(sizes.items()):
            prints = np.array([entry[0] for entry in entries], np.uint64)
            near = np.zeros(1 << (BITS // BLOCKS), np.uint8)  # bit b: near to block b of an item
            for block, values in enumerate(prints.view(np.uint16).reshape(-1, BLOCKS).T):
                for value in set(values.tolist()):
                    near[_near_blocks(value, radius // BLOCKS)] |= np.uint8(1 << block)
            self.by_size[size] = (prints, near, [entry[1:] for entry in entries])

    def candidates(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(start, item) of the windows of one or many texts whose fingerprint lies within the radius of the item's."""
        found: set[tuple[int, int]] = set()
        if not self.by_size:
            return found
        longest = max(size for size, _ in self.by_size)
        pairs = _pairs(words) if len(words) > 1 else np.zeros(0, np.uint64)
        kind = np.int16 if longest + _SPAN < 1 << 15 else np.int32
        flags = np.array([1 << block for block in range(BLOCKS)], np.uint8)
        for lo in range(0, len(words), _SPAN):
            sums = np.zeros((max(min(len(pairs) - lo, _SPAN + longest), 0) + 1, BITS), kind)
            if len(sums) > 1:
                sums[1:] = _running(_signs(pairs[lo : lo + len(sums) - 1], kind))
            parts = {step: [np.ascontiguousarray(sums[k::step]) for k in range(step)] for step in {s for _, s in self.by_size}}
            above = np.empty((_SPAN, BITS), bool)
            for (size, step), (prints, near, entries) in self.by_size.items():
                if size == 1:
                    windows = np.ascontiguousarray(words[lo : lo + _SPAN : step])
                else:
                    ends = parts[step][(size - 1) % step][(size - 1) // step :][: _SPAN // step]
                    if not len(ends):
                        continue
                    np.greater(ends, parts[step][0][: len(ends)], out=above[: len(ends)])
                    windows = np.packbits(above[: len(ends)]).view(np.uint64)
                blocks = windows.view(np.uint16).reshape(-1, BLOCKS)
                at = np.flatnonzero((near.take(blocks) & flags).view(np.uint32))
                if not len(at):
                    continue
                apart = np.bitwise_count(windows[at, None] ^ prints[None, :])
                for row, entry in zip(*np.nonzero(apart <= self.radius)):
                    item, skipped = entries[entry]
                    found.add((lo + int(at[row]) * step - skipped, item))
        return found


def window_shingles(words: np.ndarray) -> Counter:
    """The multiset of five-word shingles of a window; of fewer words, one shingle of them all."""
    return Counter(tuple(words[k : k + SHINGLE].tolist()) for k in range(max(len(words) - SHINGLE + 1, 1)))


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


@functools.lru_cache(maxsize=1)
def _index(items: tuple[tuple[int, str], ...]) -> ItemIndex:
    return ItemIndex(items)


def matches(words: Words, index: ItemIndex, threshold: float) -> list[tuple[int, int, int, float, int]]:
    """(text, item, first word, similarity, words) of each item found in a text, at its best window, the first of equal ones."""
    text_of = np.repeat(np.arange(len(words.first) - 1), words.counts)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for start, at in index.candidates(words.hashes):
        item, own = index.items[at]
        size = len(own)
        if start < 0 or start + size > len(text_of) or text_of[start] != text_of[start + size - 1]:
            continue
        text = int(text_of[start])
        close = similarity(window_shingles(words.hashes[start : start + size]), index.shingles[at])
        key = (text, at)
        if close >= threshold and (close, -start) > best.get(key, (0.0, 0, 0))[:2]:
            best[key] = (close, -start, size)
    return [
        (text, at, int(-start - words.first[text]), close, size)
        for (text, at), (close, start, size) in sorted(best.items())
    ]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, item_id, similarity, start, n_words) for each row of `docs` and each item of `benchmark` that it holds.

    A text holds an item if one of its windows of as many words as the item has a weighted Jaccard similarity of
    five-word shingles (A-Z in lower case) of at least `threshold` and a fingerprint (SimHash of its word pairs, 64 bits)
    within RADIUS of the item's. All such windows are found: fingerprints within the radius have one of four blocks
    within a quarter of it, and every window's blocks are looked up in tables of all values so near to an item's. An exact copy has
    distance 0. The best window is reported, the first of equally good ones; start counts words from 0.

    Null or empty texts hold nothing, null or empty items are in nothing; repeated items are reported each. Items are taken in
    blocks of about ITEM_WORDS words, so what is sent to the tasks is bounded; documents are read once a block, whole, and
    are not shuffled. Rows with equal or null ids are reported as they are; other columns are not read.
    """
    items = benchmark.select(
        F.col(item_id_col).alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")
    ).filter(F.trim("text") != "")
    blocks: list[list[tuple]] = [[]]
    size = 0
    for row in items.orderBy("item", "text").toLocalIterator():
        if size > ITEM_WORDS:
            blocks.append([])
            size = 0
        blocks[-1].append((row["item"], row["text"]))
        size += row["text"].count(" ") + 1
    found = None
    for block in blocks:
        part = _search(docs, block, id_col, text_col, items.schema["item"].dataType, item_id_col, threshold)
        found = part if found is None else found.unionAll(part)
    return found


def _search(docs, block, id_col, text_col, item_type, item_name, threshold) -> DataFrame:
    items = docs.sparkSession.sparkContext.broadcast(tuple(block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(items.value)
        for batch in batches:
            for piece in pieces(batch, 1):
                hits = matches(words_of(piece.column(1)), index, threshold)
                rows = pa.array([hit[0] for hit in hits], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(rows),
                        pa.array([index.items[hit[1]][0] for hit in hits], arrow_type),
                        pa.array([hit[3] for hit in hits], pa.float64()),
                        pa.array([hit[2] for hit in hits], pa.int64()),
                        pa.array([hit[4] for hit in hits], pa.int64()),
                    ],
                    names=["id", "item", "similarity", "start", "n_words"],
                )

    arrow_type = to_arrow_type(item_type)
    schema = StructType().add("id", docs.schema[id_col].dataType).add("item", item_type)
    schema = schema.add("similarity", "double").add("start", "long").add("n_words", "long")
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    return found.select(
        F.col("id").alias(id_col), F.col("item").alias(item_name), "similarity", "start", "n_words"
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without those that hold an item of `benchmark`."""
    row = fresh_name("row", docs.columns)
    rows = keyed(docs, id_col, row)
    held = saved(contamination(rows, benchmark, row, text_col).select(row).distinct(), "contaminated")
    return rows.join(broadcast_if_small(held, 16), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
