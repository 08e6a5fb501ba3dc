"""A stored inverted index: for each word of the text index, the points that hold it.

    <folder>/bucket=<hash of the word>/     (part, token, prefix, packed, others), sorted by token and prefix

A row holds the ids of one word's points whose id begins with `prefix`, sorted. Point ids are evenly spread, so such a list
has a bounded length however common the word is. A common word is many rows in many files, any other one row. Ids that are UUIDs, as ours are, lie in
`packed`, 16 bytes each; a row with other ids has all of its ids in `others`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffles_deleted

BUCKETS = 64
#: Ids in a row, about, and in what one task writes of a bucket.
ROW_IDS, TASK_IDS = 4096, 4_000_000
#: Words of so many rows are common; to find them, words are counted in so many points, or up to twice as many. Which words
#: are taken for common decides where ids lie, not which there are.
COMMON_ROWS, COUNTED_POINTS = 16, 1 << 16
#: Words and ids that a task makes lists of at once, and ids of lists that it hands on at once, about.
TOGETHER, HANDED_ON = 2_000_000, 250_000
#: So many words are looked up by a filter, which the scan itself applies; more by a join.
MAX_FILTERED_WORDS = 200
#: Hex digits between the dashes of a UUID.
_UUID = (8, 4, 4, 4, 12)
SCHEMA = "part int, token string, prefix string, packed binary, others array<string>, bucket int"


def bucket_of(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def _packed(point: Column) -> Column:
    """A point id in 16 bytes if it is a UUID in lower case, as ours are; else in more, and as it is after the first 17."""
    digits = F.replace(point, F.lit("-"), F.lit(""))
    other = F.concat(F.lit(bytes(17)), F.encode(point, "UTF-8"))
    return F.when(point.rlike("^" + "-".join(f"[0-9a-f]{{{n}}}" for n in _UUID) + "$"), F.unhex(digits)).otherwise(other)


def _unpacked(packed: Column) -> Column:
    digits, starts = F.lower(F.hex(packed)), [1 + sum(_UUID[:at]) for at in range(len(_UUID))]
    uuid = F.concat_ws("-", *[F.substring(digits, start, n) for start, n in zip(starts, _UUID)])
    return F.when(F.length(packed) == 16, uuid).otherwise(F.decode(F.substring(packed, 18, 1 << 30), "UTF-8"))


def _prefix(packed: Column, digits: int) -> Column:
    """The first characters of a packed id."""
    if not digits:
        return F.lit("")
    first = F.substring(F.lower(F.hex(F.substring(packed, 1, 4))), 1, digits)
    return F.when((F.length(packed) == 16) & F.lit(digits <= 8), first).otherwise(F.substring(_unpacked(packed), 1, digits))


def _digits_of(word: np.ndarray, row_ids: int) -> np.ndarray:
    """How many characters of each id its row's prefix has, of ids by the number of their word: enough for rows of about `row_ids`."""
    times = np.bincount(word)
    return np.ceil(np.log2(np.maximum(times / row_ids, 1)) / 4).astype(np.int64)[word]


def _uuid_lists(raw: np.ndarray, word: np.ndarray, row_ids: int) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
    """Of UUIDs in rows of 16 bytes, each with the number of its word: where the lists begin and the last ends, the order of ids
    in them, and their columns (prefix, packed, others)."""
    high, low = raw.view(">u8").astype(np.uint64).T
    order = np.lexsort((low, high, word))
    word, digits = word[order], np.minimum(_digits_of(word, row_ids)[order], 8)
    first = (high[order] >> np.uint64(32)) >> (32 - 4 * digits).astype(np.uint64)
    starts = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (word[1:] != word[:-1])))
    ends = np.append(starts, len(raw))
    prefixes = [f"{value:0{length}x}" if length else "" for value, length in zip(first[starts].tolist(), digits[starts].tolist())]
    offsets = pa.py_buffer(ends.astype(np.int32) * np.int32(16))
    packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(raw[order])])
    return ends, order, [pa.array(prefixes, pa.string()), packed, pa.nulls(len(starts), pa.list_(pa.string()))]


def _other_lists(packed: list[bytes], word: np.ndarray, row_ids: int) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
    """As `_uuid_lists`, of packed ids of any kind."""
    uuid = lambda p: "-".join(p.hex()[sum(_UUID[:at]) : sum(_UUID[: at + 1])] for at in range(len(_UUID)))
    ids = pa.array([uuid(p) if len(p) == 16 else p[17:].decode() for p in packed], pa.string())
    by_id = np.empty(len(ids), np.int64)
    by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    order = np.lexsort((by_id, word))
    ids = ids.take(pa.array(order))
    first = pa.array([each[:n] for each, n in zip(ids.to_pylist(), _digits_of(word, row_ids)[order].tolist())], pa.string())
    code = first.dictionary_encode().indices.to_numpy()
    starts = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(word[order], prepend=-1) != 0))
    ends = np.append(starts, len(ids))
    others = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids)
    return ends, order, [first.take(pa.array(starts)), pa.nulls(len(starts), pa.binary()), others]


def _lists(batches: list[pa.RecordBatch], row_ids: int) -> Iterator[pa.RecordBatch]:
    """The rows of the index, but for their order, of rows (bucket, part, token, packed)."""
    bucket, part, token, packed = (pa.concat_arrays([batch.column(at) for batch in batches]) for at in range(4))
    token = token.dictionary_encode()
    word = token.indices.to_numpy()
    if pc.all(pc.equal(pc.binary_length(packed), 16)).as_py():
        raw = np.frombuffer(packed.buffers()[2], np.uint8)[: len(packed) * 16].reshape(-1, 16)
        ends, order, lists = _uuid_lists(raw, word, row_ids)
    else:
        ends, order, lists = _other_lists(packed.to_pylist(), word, row_ids)
    starts = ends[:-1]
    at = order[starts]
    columns = [bucket.take(pa.array(at)), part.take(pa.array(at)), token.dictionary.take(pa.array(word[at])), *lists]
    rows = pa.RecordBatch.from_arrays(columns, ["bucket", "part", "token", "prefix", "packed", "others"])
    row = 0
    while row < len(starts):
        stop = max(row + 1, int(np.searchsorted(starts, starts[row] + HANDED_ON)))
        yield rows.slice(row, stop - row)
        row = stop


def _common_words(points: DataFrame, rows: int, most: int) -> list[str]:
    """Words that more than about `most` of the points hold, of which there are few."""
    if rows <= most:
        return []
    every = max(1, rows // COUNTED_POINTS)
    some = points.filter(F.pmod(F.xxhash64("point_id", F.lit("some")), F.lit(every)) == 0)
    times = some.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("times"))
    return [row["token"] for row in times.filter(F.col("times") * every > most).select("token").collect()]


def write_postings(points: DataFrame, folder: str, buckets: int = BUCKETS) -> None:
    """Index points (point_id, tokens). One shuffle: words are dealt by bucket, each bucket over as many tasks as keep their shares
    bounded, common words by the beginnings of ids, and the lists are made where they are written. A task holds TOGETHER words and ids at once; one that
    is dealt more makes several rows of a word and a prefix."""
    sizes = points.agg(F.count(F.lit(1)), F.sum(F.size("tokens").cast("long"))).first()
    digits = max(0, math.ceil(math.log(max(1, sizes[0] / ROW_IDS), 16)))
    parts = max(1, math.ceil((sizes[1] or 0) / TASK_IDS))
    # What is shuffled is a word and a packed id; all else follows from these.
    token, packed = F.col("token"), F.col("packed")
    bucket, row_ids = bucket_of(token, buckets), ROW_IDS
    common = _common_words(points, sizes[0], COMMON_ROWS * ROW_IDS) if parts > 1 else []
    dealt_by = F.when(token.isin(common), _prefix(packed, digits)).otherwise(token) if common else token
    part = F.pmod(F.xxhash64(dealt_by, F.lit("part")), F.lit(parts)).cast("int")
    words = points.select(_packed(F.col("point_id")).alias("packed"), "tokens").select("packed", F.explode("tokens").alias("token"))
    tasks, least = math.ceil((sizes[1] or 0) / TOGETHER), int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = words.repartition(tasks, bucket, part) if tasks > least else words.repartition(bucket, part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += len(batch)
            if size >= TOGETHER:
                yield from _lists(waiting, row_ids)
                waiting, size = [], 0
        if size:
            yield from _lists(waiting, row_ids)

    lists = dealt.select(bucket.alias("bucket"), part.alias("part"), "token", "packed").mapInArrow(
        run, "bucket int, part int, token string, prefix string, packed binary, others array<string>"
    )
    rows = lists.sortWithinPartitions("bucket", "token", "prefix")
    with shuffles_deleted(points.sparkSession):
        rows.write.mode("overwrite").partitionBy("bucket").option("compression", "zstd").parquet(folder)


def _ids() -> Column:
    """The packed ids of a row."""
    at = F.sequence(F.lit(0), F.octet_length("packed") - 16, F.lit(16))
    return F.coalesce(F.transform("others", _packed), F.transform(at, lambda place: F.substring("packed", place + 1, F.lit(16))))


def read_postings(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the index, with all ids as `point_ids`."""
    stored = spark.read.schema(SCHEMA).parquet(folder)
    return stored.withColumn("point_ids", F.coalesce("others", F.transform(_ids(), _unpacked)))


def points_with(postings: DataFrame, words: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(point_id, tokens): the points that hold at least one of these words, and which of them; read from the buckets
    of the words only."""
    spark = postings.sparkSession
    wanted = spark.createDataFrame([(word,) for word in words], "token string")
    placed = wanted.select("token", bucket_of(F.col("token"), buckets).alias("bucket"))
    if len(words) <= MAX_FILTERED_WORDS:
        numbers = sorted({row["bucket"] for row in placed.select("bucket").collect()})
        found = postings.filter(F.col("bucket").isin(numbers) & F.col("token").isin(words))
    else:
        found = postings.join(F.broadcast(placed.filter("bucket >= 0")), ["bucket", "token"])
    # Ids are unpacked of these rows only, and once a point.
    each = found.select(F.explode(_ids()).alias("id"), "token")
    return each.groupBy("id").agg(F.collect_set("token").alias("tokens")).select(_unpacked(F.col("id")).alias("point_id"), "tokens")
