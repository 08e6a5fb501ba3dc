"""Near duplicates by BagMinHash signatures of weighted shingle sets, bands, and exact multiset overlap."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farsight.llm.common import Tables, broadcast_if_small, fresh_name, in_few_files, keyed, saved
from farsight.llm.groups import linked_groups
from farsight.llm.tokens import SHINGLE, counted, mixed, overlap, pieces, shingles_of, words_of

#: A pair at the threshold shares no band with probability (1 - 0.8 ** 5) ** 25 = 5e-5.
BANDS, ROWS, THRESHOLD = 25, 5, 0.8
SKETCH_BITS = 128
#: Rows with whole texts, at least, for which a task is worth its start.
HEAVY_ROWS = 512

_U = np.uint64
_STEP, _LEVEL, _BAND = _U(0x9E3779B97F4A7C15), _U(0xD1B54A32D192ED03), _U(0x8CB92BA72F3D8DD7)


def _unit(bits: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((bits >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


def bag_minhash(text: np.ndarray, hashes: np.ndarray, times: np.ndarray, texts: int, size: int) -> np.ndarray:
    """Signatures (texts, size) of weighted sets, given as (text, hash, times), weight = times >= 1.

    Two signatures agree in a place with probability equal to the weighted Jaccard similarity. Weights are cut into
    levels 1, 2, ... and levels into the intervals 1, 2, 3-4, 5-8, ...; each element has, for each interval its weight
    reaches, one Poisson process, the same in every text. A point of it has a time, a place in the signature and a
    level within the interval, and counts where that level is at most the weight; so a heavier element has all points
    of a lighter one and more. A place keeps the earliest time. A process stops once it is later than every place of its
    text, after about one point an element in long texts, whatever the signature's size.
    """
    signature = np.full((texts, size), np.inf)
    if not len(text):
        return signature
    intervals = np.ceil(np.log2(times)).astype(np.int64) + 1
    of = np.repeat(np.arange(len(text)), intervals)
    interval = np.arange(len(of)) - np.repeat(np.cumsum(intervals) - intervals, intervals)
    length = np.where(interval > 0, 1 << np.maximum(interval - 1, 0), 1)
    below = np.where(interval > 0, length, 0)
    with np.errstate(over="ignore"):
        state = mixed(hashes[of] + interval.astype(_U) * _LEVEL)
    owner, most, clock = text[of], times[of], np.zeros(len(of))
    flat = signature.reshape(-1)
    latest = np.full(texts, np.inf)
    while len(owner):
        with np.errstate(over="ignore"):
            state = mixed(state + _STEP)
            clock = clock - np.log(_unit(state)) / length
            on = clock < latest[owner]
            state, clock, owner, most = state[on], clock[on], owner[on], most[on]
            length, below = length[on], below[on]
            if not len(owner):
                break
            other = mixed(state ^ _LEVEL)
        place = (other & _U(0xFFFFFFFF)).astype(np.int64) * size >> 32
        level = below + 1 + ((other >> _U(32)).astype(np.int64) * length >> 32)
        counts = level <= most
        np.minimum.at(flat, owner[counts] * size + place[counts], clock[counts])
        active = np.unique(owner)
        latest[active] = signature[active].max(axis=1)
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    bits = signature.view(_U).reshape(len(signature), bands, rows)
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(mixed(np.arange(bands, dtype=_U) * _BAND), bits.shape[:2]).copy()
        for row in range(rows):
            keys = mixed(keys * _STEP + bits[:, :, row])
    return keys.view(np.int64)


def bit_sketch(signature: np.ndarray) -> np.ndarray:
    """One bit of each of the first SKETCH_BITS places, as two 64-bit numbers."""
    bits = np.zeros((len(signature), SKETCH_BITS), bool)
    some = signature[:, :SKETCH_BITS]
    bits[:, : some.shape[1]] = (mixed(np.ascontiguousarray(some).view(_U)) >> _U(63)).astype(bool)
    return np.packbits(bits, axis=1).view(np.int64).reshape(len(signature), 2)


def most_apart(places: int, threshold: float) -> int:
    """Bits in which sketches of a pair at the threshold differ at most, but for one pair in some ten million.

    Each place differs with probability (1 - threshold) / 2; five standard deviations above the mean.
    """
    share = (1 - threshold) / 2
    return int(places * share + 5 * (places * share * (1 - share)) ** 0.5) + 1


def signatures(rows: DataFrame, bands: int = BANDS, rows_per_band: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """(row, key, bands, size, bits1, bits2) for `rows` (row, key, text); bands is empty for a text without a word.

    size is the number of shingles; the bits are one of each of the signature's first 128 places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                words = words_of(piece.column(2))
                text, hashes = shingles_of(words, shingle)
                signature = bag_minhash(*counted(text, hashes), piece.num_rows, bands * rows_per_band)
                sizes = np.bincount(text, minlength=piece.num_rows)
                some = words.counts > 0
                keys = band_keys(signature[some], bands, rows_per_band)
                ends = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1)))
                sketch = bit_sketch(signature)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), lists, pa.array(sizes), pa.array(sketch[:, 0]), pa.array(sketch[:, 1])],
                    names=["row", "key", "bands", "size", "bits1", "bits2"],
                )

    return rows.mapInArrow(run, "row long, key string, bands array<long>, size long, bits1 long, bits2 long")


def _elements(texts: DataFrame) -> DataFrame:
    """(node, elements) of (row, text): each shingle, the k-th time that it occurs, as a number of 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                text, hashes, times = counted(*shingles_of(words_of(piece.column(1))))
                of = np.repeat(np.arange(len(text)), times)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
                with np.errstate(over="ignore"):
                    numbers = (mixed(hashes[of] + nth.astype(_U) * _LEVEL) >> _U(32)).astype(np.uint32).view(np.int32)
                ends = np.searchsorted(text[of], np.arange(piece.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers))
                yield pa.RecordBatch.from_arrays([piece.column(0), lists], names=["node", "elements"])

    return texts.select("row", "text").mapInArrow(run, "node long, elements array<int>")


def _alike(pairs: DataFrame, threshold: float) -> DataFrame:
    """Of (a, b, text_a, text_b), the (a, b) whose shingle multisets overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                close = overlap(piece.column(2), piece.column(3)) >= threshold
                yield piece.select([0, 1]).filter(pa.array(close))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _classes(rows: DataFrame, tables: Tables, threshold: float, bands: int, rows_per_band: int) -> DataFrame:
    """(row, class_id) of the rows (row, text) whose text is not null: the least row of the class."""
    keyed_rows = rows.select("row", F.md5(F.col("text").cast("binary")).alias("key"), "text")
    marked = tables.save(signatures(keyed_rows.filter("text IS NOT NULL"), bands, rows_per_band), "signatures")
    first = tables.save(
        marked.groupBy("key").agg(F.min(F.struct("row", "bands", "size", "bits1", "bits2")).alias("one")).select(
            "key", "one.*"
        ),
        "different-texts",
    )
    members = first.select(F.explode("bands").alias("bucket"), F.col("row").alias("node"), "size", "bits1", "bits2")
    apart = most_apart(min(bands * rows_per_band, SKETCH_BITS), threshold)

    def may_link(a: str, b: str) -> Column:
        """Sizes and sketches allow the similarity."""
        sizes = F.least(f"{a}.size", f"{b}.size") >= F.greatest(f"{a}.size", f"{b}.size") * (threshold - 1e-9)
        bits = [F.bit_count(F.col(f"{a}.bits{k}").bitwiseXOR(F.col(f"{b}.bits{k}"))) for k in (1, 2)]
        return sizes & (bits[0] + bits[1] <= apart)

    def enrich(sides: list[DataFrame], own: Tables) -> list[DataFrame]:
        """Adds the bands before the bucket's own, so that a pair is made in the first bucket it shares, and the shingles."""
        nodes = reduce(DataFrame.unionAll, [side.select(F.col("node").alias("row")) for side in sides]).distinct()
        most = sum(side.count() for side in sides)
        nodes = broadcast_if_small(own.save(in_few_files(nodes, most), "nodes"), 16)
        found = _elements(rows.select("row", "text").join(nodes, "row"))
        bands_of = first.select(F.col("row").alias("node"), "bands").join(nodes.withColumnRenamed("row", "node"), "node")
        table = own.save(in_few_files(found.join(bands_of, "node"), most, HEAVY_ROWS), "shingles")
        table = broadcast_if_small(table, 4 * F.size("elements") + 8 * F.size("bands") + 64)
        before = F.slice("bands", 1, F.array_position("bands", F.col("bucket")).cast("int") - 1)
        return [side.join(table, "node").select(*side.columns, before.alias("before"), "elements") for side in sides]

    def must_link(a: str, b: str) -> Column:
        """No earlier bucket is shared, and the shingle sets overlap enough (as numbers of 32 bits, hence hardly less than
        they do; `verify` follows)."""
        both = F.size(F.array_intersect(f"{a}.elements", f"{b}.elements")) * (1 + 1 / threshold)
        enough = both >= F.size(f"{a}.elements") + F.size(f"{b}.elements") - 1e-6
        return ~F.arrays_overlap(f"{a}.before", f"{b}.before") & enough

    def verify(pairs: DataFrame, own: Tables) -> DataFrame:
        count = pairs.count()
        ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
        ends = own.save(in_few_files(ends, 2 * count), "ends")
        texts = own.save(rows.select("row", "text").join(broadcast_if_small(ends, 16), "row"), "linked-texts")
        a, b = (texts.select(F.col("row").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab")
        alike = _alike(pairs.join(b, "b").join(a, "a"), threshold)
        return own.save(in_few_files(alike, count, HEAVY_ROWS), "alike")

    roots = linked_groups(members, may_link, verify, tables, enrich, must_link)
    classes = tables.save(
        first.select("key", "row").join(roots, first["row"] == roots["node"]).select("key", "root"), "classes"
    )
    copies = marked.select("row", "key").join(first.select("key", F.col("row").alias("first")), "key")
    found = copies.join(broadcast_if_small(classes, 64), "key", "left").select(
        "row", F.coalesce("root", "first").alias("class_id")
    )
    return tables.keep(found, "near-classes")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows_per_band: int = ROWS,
) -> DataFrame:
    """One row per row of `docs`: id, class_id, kept.

    Texts are multisets of five-word shingles (A-Z in lower case; a shorter text is one shingle). Two texts are linked
    if the sum of the smaller counts over the sum of the larger ones is at least `threshold`; classes are the connected
    groups. Equal texts are one from the start, so that a text of very many copies costs as much as a single one; pairs are then
    sought bucket by bucket of equal bands (see linked_groups) and each is verified exactly.

    class_id is the least id of the class's rows where ids are unique and not null (else a number given to one of its
    rows); kept marks one row of each class, of least row number. Rows with null text are each a class of their own, so is
    a text without a word, with its exact copies. An empty table gives no rows. Other columns are not read.
    """
    rows = keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "row")
    with Tables(docs.sparkSession) as tables:
        found = _classes(rows, tables, threshold, bands, rows_per_band)
    # the root is the least row of the class, as every row met first for its text is the least of that text
    return rows.select("id", "row").join(found, "row", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("class_id", "row").alias("class_id"),
        (F.coalesce("class_id", "row") == F.col("row")).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without the near duplicates of a row that stays."""
    row = fresh_name("row", docs.columns)
    rows = keyed(docs, id_col, row)
    groups = near_groups(rows, row, text_col)
    gone = saved(groups.filter("NOT kept").select(F.col(row)), "near-duplicates")
    return rows.join(broadcast_if_small(gone, 16), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
