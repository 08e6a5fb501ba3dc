"""Language-model scores: a hashed maximum-entropy model with class-factored softmax, trained on Spark."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farsight.llm.common import Tables, saved, shuffles_deleted
from farsight.llm.tokens import mixed, pieces, words_of

#: Words encoded together; each such chunk has a vocabulary of its own.
CHUNK_WORDS = 3_000_000
#: Single-word classes (the end of a text is one of them), and clusters of endings.
HEADS, CLUSTERS = 31, 8
#: Counts from which a word belongs to the next band of rarer or less rare words; below the first it is unknown.
BAND_FROM = (1, 2, 4, 16)
CLASSES = HEADS + len(BAND_FROM) * CLUSTERS + 1
UNKNOWN = CLASSES - 1
ENDINGS = 2048
#: Words met so often are told apart by their hashes wherever the model looks at them; rarer ones, which teach nothing of their
#: own, by ending and band.
OWN_FROM = 2
#: Rows for each kind of hashed features: they grow with the vocabulary, by powers of two, a row for WORDS_A_ROW different words,
#: from HASHED to MOST_HASHED.
HASHED, MOST_HASHED, WORDS_A_ROW = 1 << 13, 1 << 16, 128
#: Words of a class go by their hashes into groups.
GROUP_BITS = 5
GROUPS = 1 << GROUP_BITS
TOPIC_WINDOW = 16
#: Passes over disjoint parts of the training texts; weights are averaged after each.
ROUNDS, BATCH, RATE = 3, 16384, 0.25
_BLOCK_ROWS, _FAN_IN = 1024, 32
#: Tokens whose scores are worked out together: they stay in a processor's cache.
BLOCK = 1024
#: Feature rows that so many tokens of a batch have get their sum by a matrix product of their own.
MANY_ROWS = 32
_ONES = np.ones(BATCH, np.float32)


def encoded(docs: DataFrame) -> DataFrame:
    """`docs` (id, held_out, text) as numbers: a row a document, and a row with the vocabulary of each chunk of them.

    Rows of documents hold chunk, id, held_out and ids (32-bit numbers in the chunk's vocabulary, most frequent first);
    rows of vocabularies hold chunk, hashes, endings and counts (in the documents not held out). Words are told apart by
    hashes of 64 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, waiting, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for piece in pieces(batch, 2):
                words = words_of(piece.column(2), endings=True)
                waiting.append((piece.select([0, 1]), words))
                size += len(words.hashes)
                if size >= CHUNK_WORDS:
                    yield from _chunk_rows(chunk, waiting, names, schema)
                    chunk, waiting, size = chunk + 1, [], 0
        if waiting:
            yield from _chunk_rows(chunk, waiting, names, schema)

    kind = docs.schema["id"].dataType.simpleString()
    spec = (
        f"chunk long, id {kind}, held_out boolean, ids binary, hashes array<long>, endings array<int>, counts array<long>"
    )
    names = ["chunk", "id", "held_out", "ids", "hashes", "endings", "counts"]
    schema = [pa.int64(), None, pa.bool_(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    return docs.select("id", "held_out", "text").mapInArrow(run, spec)


def _chunk_rows(chunk: int, waiting: list, names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    hashes = np.concatenate([words.hashes for _, words in waiting])
    endings = np.concatenate([words.endings for _, words in waiting])
    counts = np.concatenate([words.counts for _, words in waiting])
    held = np.concatenate([rows.column(1).to_numpy(zero_copy_only=False).astype(bool) for rows, _ in waiting])
    different, first, own, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")
    number = np.empty(len(order), np.uint32)
    number[order] = np.arange(len(order), dtype=np.uint32)
    ids = number[own]
    learned = np.bincount(ids[np.repeat(~held, counts)], minlength=len(order))
    ends = np.concatenate([[0], np.cumsum(counts)])
    at = 0
    for rows, _ in waiting:
        n = rows.num_rows
        data = [ids[ends[at + k] : ends[at + k + 1]].tobytes() for k in range(n)]
        columns = [pa.array(np.full(n, chunk)), *rows.columns, pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(n, kind) for kind in kinds[4:])], names=names)
        at += n
    kind = ((mixed(endings[first[order]].astype(np.uint64)) >> np.uint64(40)) % np.uint64(ENDINGS)).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([chunk], pa.int64()),
            pa.nulls(1, waiting[0][0].column(0).type),
            pa.nulls(1, pa.bool_()),
            pa.nulls(1, pa.binary()),
            pa.array([different[order].view(np.int64)], kinds[4]),
            pa.array([kind], kinds[5]),
            pa.array([learned], kinds[6]),
        ],
        names=names,
    )


def _band(count: Column) -> Column:
    band = F.lit(0)
    for number, start in enumerate(BAND_FROM, 1):
        band = F.when(count >= start, number).otherwise(band)
    return band


def _type(head: Column, ending: Column, count: Column, word: Column) -> Column:
    """32 bits that say what the model sees of a word. The lower 16 give its class: a head, or its ending, its band, and whether
    one occurrence less would put it into the band below. The upper 16 are the word itself, by its 64-bit hash `word`, or the lower
    16 again for a word met less than OWN_FROM times."""
    edge = F.when(count.isin(list(BAND_FROM)), 1).otherwise(0)
    kind = F.coalesce(head + 32768, ending * 16 + _band(count) * 2 + edge).cast("long")
    return F.shiftleft(F.when(count >= OWN_FROM, F.shiftrightunsigned(word, 48)).otherwise(kind), 16).bitwiseOR(kind)


def typed(table: DataFrame, counts: DataFrame, ends: int) -> DataFrame:
    """Each document's counts, and the 32-bit types of its words and its end, from the encoded table.

    (id, held_out, n_tokens, n_known, logs, tail_logs, types): logs sums log10(count + 1) over all tokens, tail_logs over
    those that are not heads. Vocabularies are joined with the counts of all the corpus word by word, then each chunk's
    documents meet its vocabulary; both are as large as a chunk.
    """
    words = table.filter("hashes IS NOT NULL").select(
        "chunk", F.posexplode(F.arrays_zip("hashes", "endings")).alias("number", "word")
    )
    words = words.select("chunk", "number", F.col("word.hashes").alias("hash"), F.col("word.endings").alias("ending"))
    count = F.coalesce("count", F.lit(0))
    looked_up = words.join(counts.select("hash", "count", "head"), "hash", "left").select(
        F.col("chunk").alias("of_chunk"), "number", count.alias("count"), _type(F.col("head"), F.col("ending"), count, F.col("hash")).alias("type")
    )
    end_log = math.log10(ends + 1)

    def run(documents: pa.Table, vocabulary: pa.Table) -> pa.Table:
        number = vocabulary.column("number").to_numpy()
        count, kind = np.zeros(len(number), np.int64), np.zeros(len(number), np.uint32)
        count[number] = vocabulary.column("count").to_numpy()
        kind[number] = vocabulary.column("type").to_numpy().astype(np.uint32)
        log, known = np.log10(count + 1.0), count > 0
        tail_log = np.where(_kinds(kind) >= 32768, 0.0, log)
        n_tokens, n_known, logs, tails, types = [], [], [], [], []
        for data in documents.column("ids"):
            ids = np.frombuffer(data.as_py(), np.uint32)
            n_tokens.append(len(ids) + 1)
            n_known.append(int(known[ids].sum()) + (ends > 0))
            logs.append(float(log[ids].sum()) + end_log)
            tails.append(float(tail_log[ids].sum()))
            types.append(np.append(kind[ids], np.uint32(_END)).tobytes())
        return pa.table(
            {
                "id": documents.column("id"),
                "held_out": documents.column("held_out"),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "logs": pa.array(logs, pa.float64()),
                "tail_logs": pa.array(tails, pa.float64()),
                "types": pa.array(types, pa.binary()),
            }
        )

    documents = table.filter("hashes IS NULL").select("chunk", "id", "held_out", "ids")
    kind = table.schema["id"].dataType.simpleString()
    spec = f"id {kind}, held_out boolean, n_tokens long, n_known long, logs double, tail_logs double, types binary"
    return documents.groupBy("chunk").cogroup(looked_up.groupBy("of_chunk")).applyInArrow(run, spec)


#: The end of a text, and what comes before one.
_END = 32768 << 16 | 32768


def _kinds(types: np.ndarray) -> np.ndarray:
    """The part of types that gives the class."""
    return types & 0xFFFF


def _words(types: np.ndarray) -> np.ndarray:
    """The part of types that tells words apart; types of 16 bits stand for themselves."""
    return types >> 16 if types.dtype == np.uint32 else types


def _before(first: np.ndarray) -> np.ndarray:
    """How many tokens of its text stand before each token."""
    places = np.arange(len(first))
    return places - np.maximum.accumulate(np.where(first, places, 0))


def _hashed(keys: np.ndarray, salt: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = keys * np.uint64(7) + np.uint64(salt)
    return (mixed(keys) >> np.uint64(65 - rows.bit_length())).astype(np.int32)


def _offsets(hashed: int) -> np.ndarray:
    """Where each kind of feature rows begins: hashed single words at distances 1, 2 and 3, then class pairs (1, 2) and (1, 3), topic
    with class 1, hashed pairs of words (1, 2) and (1, 3), bias."""
    return np.cumsum([0, hashed, hashed, hashed, CLASSES**2, CLASSES**2, (CLUSTERS + 1) * CLASSES, hashed, hashed])


def feature_rows(hashed: int) -> int:
    return int(_offsets(hashed)[-1]) + 1


FEATURE_ROWS = feature_rows(HASHED)


@cache
def _word_rows(back: int, hashed: int) -> np.ndarray:
    """Row of each word at a distance."""
    return _hashed(np.arange(1 << 16, dtype=np.uint64), back, hashed)


@dataclass
class Model:
    """cluster: of each ending; log_mass: log10 of what the counts plus one of a class's words add up to; weights; shares: of each
    group in its class's counts; group_weights: of the groups, by class and word before."""

    cluster: np.ndarray
    log_mass: np.ndarray
    weights: np.ndarray
    shares: np.ndarray | None = None
    group_weights: np.ndarray | None = None

    @property
    def hashed(self) -> int:
        """Rows for each kind of hashed features."""
        return (len(self.weights) - feature_rows(0)) // 5

    def classes(self, types: np.ndarray, left_out: bool = False) -> np.ndarray:
        """Class of each type; `left_out`: as if this occurrence had not been counted."""
        types = _kinds(types)
        band = (types >> 1) & 7
        if left_out:
            band = band - np.minimum(types & 1, band)
        tail = HEADS + (band.astype(np.int32) - 1) * CLUSTERS + self.cluster[(types >> 4) & (ENDINGS - 1)]
        return np.where(types >= 32768, types.astype(np.int32) - 32768, np.where(band == 0, UNKNOWN, tail))

    def features(self, types: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Feature rows (token, 9) of some texts' tokens, `first` marking the first token of each text."""
        n = len(types)
        classes, words, before, hashed = self.classes(types), _words(types), _before(first), self.hashed
        offsets = _offsets(hashed)
        begin = np.arange(n) - before
        out = np.empty((n, 9), np.int32)
        near, said = [], []
        for back in (1, 2, 3):
            at, inside = np.maximum(np.arange(n) - back, 0), before >= back
            near.append(np.where(inside, classes[at], 0))
            said.append(np.where(inside, words[at], _END >> 16))
            out[:, back - 1] = _word_rows(back, hashed)[said[-1]] + offsets[back - 1]
        out[:, 3] = near[0] * CLASSES + near[1] + offsets[3]
        out[:, 4] = near[0] * CLASSES + near[2] + offsets[4]
        seen = np.zeros((n + 1, CLUSTERS), np.int32)
        tail = (classes >= HEADS) & (classes < UNKNOWN)
        seen[1:][tail, (classes[tail] - HEADS) % CLUSTERS] = 1
        np.cumsum(seen, axis=0, out=seen)
        lately = seen[:-1] - seen[np.maximum(begin, np.arange(n) - TOPIC_WINDOW)]
        topic = np.where(lately.any(axis=1), lately.argmax(axis=1) + 1, 0)
        out[:, 5] = topic * CLASSES + near[0] + offsets[5]
        latest = said[0].astype(np.uint64) << np.uint64(16)
        for k, other in ((6, said[1]), (7, said[2])):
            out[:, k] = _hashed(latest | other.astype(np.uint64), k, hashed) + offsets[k]
        out[:, 8] = offsets[8]
        return out

    def group_rows(self, types: np.ndarray, first: np.ndarray, own: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Rows (3, token) of the group weights for the tokens at `own`, of these classes."""
        words, before, hashed = _words(types), _before(first)[own], self.hashed
        out = np.empty((3, len(own)), np.intp)
        for back in (1, 2, 3):
            said = np.where(before >= back, words[np.maximum(own - back, 0)], _END >> 16)
            keys = said.astype(np.uint64) * np.uint64(CLASSES) + classes.astype(np.uint64)
            out[back - 1] = _hashed(keys, back, hashed) + (back - 1) * hashed
        return out

    def _group_chances(self, rows: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all groups and, by the group's share of the class, their chances; for some columns of rows (3, token)."""
        scores = self.group_weights.take(rows[0], axis=0, mode="clip")
        for row in rows[1:]:
            scores += self.group_weights.take(row, axis=0, mode="clip")
        scores -= scores.max(axis=1, keepdims=True)
        return scores, np.exp(scores) * self.shares[classes]

    def group_gains(self, types: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural log of how many times likelier each token's group is after its history than by its share of the class;
        0 for classes of one outcome."""
        found = np.zeros(len(types))
        if self.group_weights is None:
            return found
        own = np.flatnonzero((classes >= HEADS) & (classes < UNKNOWN))
        rows, groups = self.group_rows(types, first, own, classes[own]), _groups(types[own])
        for lo in range(0, len(own), BLOCK):
            at = own[lo : lo + BLOCK]
            scores, chances = self._group_chances(rows[:, lo : lo + BLOCK], classes[at])
            found[at] = scores[np.arange(len(at)), groups[lo : lo + BLOCK]] - np.log(chances @ _ONES[:GROUPS])
        return found

    def train_groups(self, types: np.ndarray, first: np.ndarray, squares: np.ndarray) -> None:
        """As `train`, for the groups: on the tokens of a class of many words that one occurrence less would leave in it."""
        classes = self.classes(types)
        own = np.flatnonzero((classes >= HEADS) & (classes < UNKNOWN) & (classes == self.classes(types, left_out=True)))
        rows, groups = self.group_rows(types, first, own, classes[own]), _groups(types[own])
        for lo in range(0, len(own), BATCH):
            part = slice(lo, lo + BATCH)
            _, slope = self._group_chances(rows[:, part], classes[own[part]])
            slope /= (slope @ _ONES[:GROUPS])[:, None]
            slope[np.arange(len(slope)), groups[part]] -= 1
            for k in range(len(rows)):
                _step(self.group_weights, squares, rows[k, part] - k * self.hashed, k * self.hashed, slope)

    def _scores(self, rows: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Score of each class, less the best one, for some columns of feature rows (9, token); written to the front of `out`."""
        scores, more = out[0, : rows.shape[1]], out[1, : rows.shape[1]]
        self.weights.take(rows[0], axis=0, out=scores, mode="clip")
        for row in rows[1:-1]:
            scores += self.weights.take(row, axis=0, out=more, mode="clip")
        scores += self.weights[-1]
        scores -= scores.max(axis=1, keepdims=True)
        return scores

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each class after each history."""
        scores = self._scores(_columns(rows), np.empty((2, len(rows), CLASSES), np.float32))
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))

    def log_chances(self, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural log of the probability of the class that came after each history."""
        rows, found = _columns(rows), np.empty(len(classes))
        room = np.empty((2, BLOCK, CLASSES), np.float32)
        for lo in range(0, len(classes), BLOCK):
            scores = self._scores(rows[:, lo : lo + BLOCK], room)
            own = scores[np.arange(len(scores)), classes[lo : lo + BLOCK]]
            np.exp(scores, out=scores)
            found[lo : lo + BLOCK] = own - np.log(scores @ _ONES[:CLASSES])
        return found

    def train(self, types: np.ndarray, first: np.ndarray, squares: np.ndarray) -> None:
        """One pass of gradient steps, scaled by AdaGrad, over some texts' tokens."""
        target, rows = self.classes(types, left_out=True), _columns(self.features(types, first))
        room, slopes = np.empty((2, BLOCK, CLASSES), np.float32), np.empty((BATCH, CLASSES), np.float32)
        for lo in range(0, len(types), BATCH):
            own, wanted = rows[:, lo : lo + BATCH], target[lo : lo + BATCH]
            slope = slopes[: len(wanted)]
            for at in range(0, len(wanted), BLOCK):
                scores = self._scores(own[:, at : at + BLOCK], room)
                np.exp(scores, out=scores)
                np.divide(scores, (scores @ _ONES[:CLASSES])[:, None], out=slope[at : at + BLOCK])
            slope[np.arange(len(wanted)), wanted] -= 1
            for ids, start in zip(own, _offsets(self.hashed)):
                _step(self.weights, squares, ids - start, start, slope)


def _groups(types: np.ndarray) -> np.ndarray:
    """The group of each word in its class."""
    return _words(types) >> (16 - GROUP_BITS)


def _step(weights: np.ndarray, squares: np.ndarray, ids: np.ndarray, start: int, slope: np.ndarray) -> None:
    """A gradient step, scaled by AdaGrad, of the rows `ids`, counted from `start`, by the slope of each of their tokens."""
    at, total = _summed(ids.astype(np.uint16), slope)
    at += start
    room = np.empty((2, BLOCK, total.shape[1]), np.float32)
    for lo in range(0, len(at), BLOCK):
        rows, change = at[lo : lo + BLOCK], total[lo : lo + BLOCK]
        step, old = room[:, : len(rows)]
        np.multiply(change, change, out=step)
        step += squares.take(rows, axis=0, out=old, mode="clip")
        squares[rows] = step
        np.sqrt(step, out=step)
        np.divide(change, step, out=change)
        change *= np.float32(RATE)
        np.subtract(weights.take(rows, axis=0, out=old, mode="clip"), change, out=step)
        weights[rows] = step


def _columns(rows: np.ndarray) -> np.ndarray:
    """Feature rows (token, 9) feature by feature."""
    return np.ascontiguousarray(rows.T, dtype=np.intp)


def _summed(ids: np.ndarray, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids, in order, and the sum of each one's rows of `slope`: by a matrix product for an id of many rows, else
    row by row, for all ids at once."""
    times = np.bincount(ids)
    at = np.flatnonzero(times)
    times = times[at]
    order, ends = np.argsort(ids, kind="stable"), np.cumsum(times)  # by digits, as 16-bit numbers are
    begins = ends - times
    total = slope.take(order[begins], axis=0, mode="clip")
    for k in np.flatnonzero(times >= MANY_ROWS):
        total[k] = _ONES[: times[k]] @ slope.take(order[begins[k] : ends[k]], axis=0, mode="clip")
    few = np.flatnonzero((times > 1) & (times < MANY_ROWS))
    few = few[np.argsort(-times[few], kind="stable")]
    begins, left = begins[few], times[few]
    sums = total.take(few, axis=0)
    for k in range(1, int(left[0]) if len(few) else 0):  # the k-th row of each id that has one
        own = int(np.searchsorted(-left, -k))
        sums[:own] += slope.take(order[begins[:own] + k], axis=0, mode="clip")
    total[few] = sums
    return at, total


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All types, which of them begin a text, and where the texts begin."""
    parts = [np.frombuffer(data.as_py(), np.uint32) for data in column]
    begins = np.cumsum([0, *map(len, parts)])[:-1]
    types = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    first = np.zeros(len(types), bool)
    first[begins] = True
    return types, first, begins


def _sliced(batch: pa.RecordBatch, column: int, most: int = 400_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many tokens."""
    sizes = np.cumsum([len(data.as_py()) // 4 for data in batch.column(column)])
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        stop = max(int(np.searchsorted(sizes, before + most, side="right")), at + 1)
        yield batch.slice(at, stop - at)
        at = stop


def _ending_clusters(corpus: DataFrame) -> np.ndarray:
    """Endings in clusters by the heads that stand near words of that ending, over all training texts.

    Counts are summed by Spark; at most ENDINGS * HEADS sums reach the driver, which groups them by k-means.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ENDINGS * HEADS, np.int64)
        for batch in batches:
            for part in _sliced(batch, 0):
                types = _kinds(_texts(part.column(0))[0])
                head = np.where(types >= 32768, types.astype(np.int64) - 32768, 0)
                ending = ((types >> 4) & (ENDINGS - 1)).astype(np.int64)
                for back in (1, 2):
                    for a, b in ((slice(back, None), slice(None, -back)), (slice(None, -back), slice(back, None))):
                        both = (types[a] < 32768) & (head[b] > 0)
                        total += np.bincount(ending[a][both] * HEADS + head[b][both], minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    rows = corpus.filter("NOT held_out").select("types").mapInArrow(run, "cell long, n long")
    table = np.zeros(ENDINGS * HEADS)
    for cell, n in rows.groupBy("cell").agg(F.sum("n")).collect():
        table[cell] = n
    table = table.reshape(ENDINGS, HEADS)
    weight = table.sum(axis=1)
    points = np.sqrt((table + weight[:, None] * 0.01 + 1e-9) / (table + weight[:, None] * 0.01 + 1e-9).sum(axis=1, keepdims=True))
    centres = [points[weight.argmax()]]
    while len(centres) < CLUSTERS:  # the heaviest of what is far from those chosen
        far = 1 - np.max(points @ np.array(centres).T, axis=1)
        centres.append(points[(far * np.sqrt(weight)).argmax()])
    centres = np.array(centres)
    for _ in range(25):
        cluster = (points @ centres.T).argmax(axis=1)
        for k in range(CLUSTERS):
            if weight[own := cluster == k].sum():
                centre = (points[own] * weight[own, None]).sum(axis=0)
                centres[k] = centre / np.linalg.norm(centre)
    return cluster.astype(np.int32)


def _trained(corpus: DataFrame, model: Model, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights, of classes and of groups, after one pass over a part of the training texts: each of as many tasks as the cluster runs
    at once starts from the model's and takes steps on the texts it reads; then the tasks' changes are averaged by tokens, in
    blocks of rows and by a tree of tasks."""
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = shared.value
        tables = [before.weights, before.group_weights]
        own = Model(before.cluster, before.log_mass, before.weights.copy(), before.shares, before.group_weights.copy())
        squares, tokens = [np.full_like(table, 1e-2) for table in tables], 0
        for batch in batches:
            for piece in _sliced(batch, 0):
                types, first, _ = _texts(piece.column(0))
                own.train(types, first, squares[0])
                own.train_groups(types, first, squares[1])
                tokens += len(types)
        del squares
        if tokens:
            # Rows of the groups are counted on from those of the classes.
            for start, old, new in ((0, tables[0], own.weights), (len(own.weights), tables[1], own.group_weights)):
                blocks = range(0, len(old), _BLOCK_ROWS)
                data = [((new[lo : lo + _BLOCK_ROWS] - old[lo : lo + _BLOCK_ROWS]) * np.float32(tokens)).tobytes() for lo in blocks]
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([start + lo for lo in blocks], pa.int64()),
                        "task": pa.array([TaskContext.get().partitionId()] * len(data), pa.int64()),
                        "tokens": pa.array([tokens] * len(data), pa.int64()),
                        "sums": pa.array(data, pa.binary()),
                    }
                )

    def added(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(data.as_py(), np.float32).astype(np.float64) for data in rows.column("sums"))
        tokens = sum(rows.column("tokens").to_pylist())
        return pa.table(
            {
                "block": rows.column("block").slice(0, 1),
                "task": pa.array([rows.column("task")[0].as_py() // _FAN_IN], pa.int64()),
                "tokens": pa.array([tokens], pa.int64()),
                "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary()),
            }
        )

    spec = "block long, task long, tokens long, sums binary"
    tasks = spark.sparkContext.defaultParallelism
    own = corpus.filter(~F.col("held_out") & (F.pmod(F.xxhash64("types"), F.lit(parts)) == part)).select("types")
    sums = own.coalesce(tasks).mapInArrow(run, spec)
    while True:
        sums = sums.groupBy("block", F.floor(F.col("task") / _FAN_IN).alias("branch")).applyInArrow(added, spec)
        if tasks <= _FAN_IN:
            break
        tasks = -(-tasks // _FAN_IN)
    weights, group_weights = model.weights.copy(), model.group_weights.copy()
    with shuffles_deleted(spark):
        changes = sums.select("block", "tokens", "sums").toArrow()
    for block, tokens, data in zip(*(changes.column(c) for c in ("block", "tokens", "sums"))):
        lo, table = (block.as_py(), weights) if block.as_py() < len(weights) else (block.as_py() - len(weights), group_weights)
        change = np.frombuffer(data.as_py(), np.float32).reshape(-1, table.shape[1]) / np.float32(tokens.as_py())
        table[lo : lo + len(change)] += change
    shared.destroy()
    return weights, group_weights


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are runs without ASCII white space, A-Z in lower case, and one end. The base is a unigram model with add-one
    smoothing and one place for all unknown words. The model gives each token a class by its history, a group of the class's
    words by class and history, and the word within its group by its count plus one: log10 P = log10 P(class | history) +
    log10 P(group | class, history) + log10((count + 1) / (group total)). The commonest words and the end are classes of their own;
    others go by how often they occur and by the cluster of their ending, and in each class by their hash into one of GROUPS;
    unknown words are one class, hence one outcome, as in the base. P(class | history) is log-linear in hashed words at distances
    1 to 3, hashed pairs of words and class pairs (with the word before, and skipping one), and a topic; P(group | class, history) in
    the same words, each hashed with the class, upon the group's share of the class. All words met OWN_FROM times or more in training
    are seen as themselves; rarer ones, and unknown ones, by ending and band. In training each word counts as if this
    occurrence had not been seen, so the unknown class gets its share.

    Counts cover all rows for which `held_out` is not true; gradient steps pass over each of their tokens once, in
    ROUNDS parts. A null or empty text is its end alone. Without training rows all words are unknown. Rows and ids may repeat
    or be null; other columns are not read; an empty table gives no rows. A row's length is what a task must hold.
    """
    named = docs.select(
        F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text")
    )
    spark = docs.sparkSession
    with Tables(spark) as tables:
        table = tables.save(encoded(named), "encoded-corpus", compression="zstd")
        words = table.filter("hashes IS NOT NULL").select(F.inline(F.arrays_zip("hashes", "endings", "counts")))
        counts = (
            words.filter("counts > 0")
            .groupBy(F.col("hashes").alias("hash"))
            .agg(F.sum("counts").alias("count"), F.min("endings").alias("ending"))
        )
        counts = tables.save(counts, "word-counts")
        ends = table.filter("hashes IS NULL AND NOT held_out").count()
        total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
        n, v = total[0] + ends, total[1] + (ends > 0)
        heads = counts.orderBy(F.desc("count"), "hash").limit(HEADS - 1).filter("count >= 100").select("hash").collect()
        numbered = spark.createDataFrame([(row[0], at) for at, row in enumerate(heads, 1)], "hash long, head int")
        counts = counts.join(F.broadcast(numbered), "hash", "left")
        kind = _type(F.col("head"), F.col("ending"), F.col("count"), F.col("hash"))
        group = F.shiftright(kind, 32 - GROUP_BITS).cast("int").alias("group")
        masses = counts.filter("head IS NULL").groupBy(_band(F.col("count")).alias("band"), "ending", group)
        masses = masses.agg(F.sum(F.col("count") + 1).alias("mass")).toArrow()  # BAND_FROM * ENDINGS * GROUPS rows at most
        # Types compress well by zstandard: the commonest word, then, takes far fewer than 32 bits.
        corpus = saved(typed(table, counts, ends), "typed-corpus", compression="zstd")
    cluster = _ending_clusters(corpus)
    band, ending, group, words_mass = (masses.column(c).to_numpy() for c in ("band", "ending", "group", "mass"))
    mass = np.zeros((CLASSES, GROUPS))
    np.add.at(mass, (HEADS + (band - 1) * CLUSTERS + cluster[ending], group), words_mass)
    shares = np.divide(mass, mass.sum(axis=1, keepdims=True), out=np.zeros_like(mass), where=mass > 0).astype(np.float32)
    mass = mass.sum(axis=1)
    mass[:HEADS] = mass[UNKNOWN] = 1.0
    hashed = min(max(1 << max(1, v // WORDS_A_ROW).bit_length() - 1, HASHED), MOST_HASHED)
    weights, group_weights = np.zeros((feature_rows(hashed), CLASSES), np.float32), np.zeros((3 * hashed, GROUPS), np.float32)
    model = Model(cluster, np.log10(np.maximum(mass, 1.0)), weights, shares, group_weights)
    for part in range(ROUNDS):
        model.weights, model.group_weights = _trained(corpus, model, part, ROUNDS)
    scored = _scored(corpus, model)
    base = F.col("logs") - F.col("n_tokens") * math.log10(n + v + 1)
    return scored.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )


def _scored(corpus: DataFrame, model: Model) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast(model)
    plain = ["id", "held_out", "n_tokens", "n_known", "logs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for piece in _sliced(batch, 6):
                types, first, begins = _texts(piece.column(6))
                classes, rows = own.classes(types), own.features(types, first)
                found = (own.log_chances(rows, classes) + own.group_gains(types, first, classes)) / math.log(10) - own.log_mass[classes]
                score = np.add.reduceat(found, begins) + piece.column(5).to_numpy()
                yield pa.RecordBatch.from_arrays([*piece.columns[:5], pa.array(score)], names=[*plain, "score"])

    kind = corpus.schema["id"].dataType.simpleString()
    spec = f"id {kind}, held_out boolean, n_tokens long, n_known long, logs double, score double"
    return corpus.select(*plain, "tail_logs", "types").mapInArrow(run, spec)
