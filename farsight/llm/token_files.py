"""Token ids of documents in binary files: independent zstandard frames, a seek table at the end, a checksum a frame."""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farsight.llm.common import Tables, broadcast_if_small, remove, saved
from farsight.session import fresh_folder

#: Bytes of text encoded at once; a longer text is encoded alone.
PIECE_BYTES = 4 << 20
#: A frame is closed once it holds this many ids; a file once it holds this many.
FRAME_IDS, FILE_IDS = 1 << 15, 1 << 22
#: Bytes of encoded words a worker remembers, twice at most, and the longest word it remembers.
REMEMBERED_BYTES, REMEMBERED_WORD = 80 << 20, 64
#: zstandard's magic numbers: skippable frames of our index and of a seek table, and the end of a seekable file.
INDEX_MAGIC, SEEK_MAGIC, END_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_CHECKED = 0x80  # in the seek table's descriptor: entries have checksums
_HEAD, _ENTRY, _FOOT = struct.Struct("<II"), struct.Struct("<III"), struct.Struct("<IBI")
_INDEX = struct.Struct("<QQQ")
_SIGNS = re.compile(rb"[.,;:!?%&#*=~-]+")
_LETTERS_SIGNS = re.compile(rb"([A-Za-z\x80-\xff]+)([.,;:!?%&#*=~-]*)")


def _bytes_of(strings: pa.Array) -> list[bytes]:
    """`to_pylist` for binary strings without nulls, cut from one buffer: a fraction of the time."""
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32, len(strings) + 1, 4 * strings.offset).tolist() if len(strings) else [0]
    whole = b"" if data is None else data.to_pybytes()
    return [whole[start:end] for start, end in zip(ends, ends[1:])]


class WordEncoder:
    """The ids that the tokenizers library gives for texts, each distinct word between ASCII spaces being encoded once.

    That is sound for vocabularies that lower-case, drop white space, split letters from signs and mark the last token of such a
    run; `path` must name one. A new word of letters with signs after it is looked up, and if need be encoded, in these two parts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix = self.tokenizer.model.end_of_word_suffix
        self._last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self._last[[number for token, number in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        self._size = 0

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, ...]:
        """A word as runs of letters and of signs, if it is that simple; else the word itself."""
        found = _LETTERS_SIGNS.fullmatch(word)
        if found is None:
            return (word,)
        letters, signs = found.groups()
        if letters.isascii():
            return (letters.lower(), signs) if signs else (letters.lower(),)
        return (letters, signs) if signs and letters.decode().isalpha() else (word,)

    def _encode_runs(self, runs: list[bytes]) -> list[bytes]:
        """Ids of runs of letters or signs, by one call: every run has one token that ends it."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(runs).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self._last[ids]) + 1
        if len(ends) != len(runs):  # lower-casing has split a run
            return self._encode_words(runs)
        data, ends = ids.tobytes(), (4 * ends).tolist()
        return [data[start:end] for start, end in zip([0, *ends], ends)]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([word.decode() for word in words], add_special_tokens=False)
        return [np.array(code.ids, "<u4").tobytes() for code in found]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words that are not remembered."""
        if self._size > REMEMBERED_BYTES:  # what is not met again is forgotten next time
            self._known, self._older, self._size = {}, self._known, 0
        parts = {word: self._parts(word) for word in words}
        found = {p: self._known.get(p) or self._older.get(p) for each in parts.values() for p in each}
        lost = [part for part, ids in found.items() if ids is None]
        runs = [part for part in lost if part.decode().isalpha() or _SIGNS.fullmatch(part)]
        other = list(set(lost).difference(runs))
        found |= zip(runs, self._encode_runs(runs)) if runs else ()
        found |= zip(other, self._encode_words(other)) if other else ()
        new = {word: b"".join([found[part] for part in each]) for word, each in parts.items()}
        self._remember(found)
        self._remember(new)
        return new

    def _remember(self, found: dict[bytes, bytes]) -> None:
        short = {word: ids for word, ids in found.items() if len(word) <= REMEMBERED_WORD}
        self._known |= short
        self._size += sum(map(len, short)) + sum(map(len, short.values())) + 160 * len(short)

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        ids = list(map(self._known.get, words))
        lost = [at for at, own in enumerate(ids) if own is None]
        if lost:
            missing = [words[at] for at in lost]
            found = {word: self._older[word] for word in missing if word in self._older}
            self._remember(found)
            found |= self._learn([word for word in missing if word not in found])
            for at, word in zip(lost, missing):
                ids[at] = found[word]
        return ids

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; all texts together should be of a bounded size."""
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        table = self._ids_of(_bytes_of(words.dictionary.cast(pa.binary())))
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        ids, starts = np.frombuffer(b"".join(table), "<u4"), np.cumsum(sizes) - sizes
        number = words.indices.to_numpy()
        each = sizes[number]
        ends = np.concatenate([[0], np.cumsum(each)])
        places = np.repeat(starts[number] - ends[:-1], each) + np.arange(ends[-1])
        cuts = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return np.split(ids[places], cuts[1:-1])


@functools.cache
def _encoder(name: str) -> WordEncoder:
    return WordEncoder(public_tokenizers.path(name))


class FileWriter:
    """One file: documents are added in order, `finish` gives its bytes.

    Layout: data frames, each a zstandard frame of its own with the ids of consecutive documents as little-endian unsigned 32-bit
    integers; a skippable frame with the index: number of the writing part, of the file within it and of documents, then,
    compressed, the documents' ids, whether each is null, and after how many ids each ends; last the seek table of
    zstandard's seekable format, with compressed size, size and checksum (low half of XXH64) of each frame before it.
    """

    def __init__(self, part: int, number: int, frame_ids: int = FRAME_IDS):
        self.part, self.number, self.frame_bytes = part, number, 4 * frame_ids
        self.docs: list[int | None] = []
        self.ends: list[int] = []
        self.frames: list[bytes] = []
        self.entries: list[bytes] = []
        self.ids, self.open = 0, bytearray()
        self._zstd = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, doc: int | None, ids: bytes) -> None:
        self.ids += len(ids) // 4
        self.docs.append(doc)
        self.ends.append(self.ids)
        self.open += ids
        if len(self.open) >= self.frame_bytes:
            self._close()

    def _close(self) -> None:
        """A document longer than a frame gets several."""
        for start in range(0, len(self.open), 2 * self.frame_bytes):
            data = bytes(self.open[start : start + 2 * self.frame_bytes])
            frame = self._zstd.compress(data)
            self._frame(frame, len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF)
        self.open = bytearray()

    def _frame(self, frame: bytes, size: int, checksum: int) -> None:
        self.frames.append(frame)
        self.entries.append(_ENTRY.pack(len(frame), size, checksum))

    def finish(self) -> bytes:
        self._close()
        null = np.array([doc is None for doc in self.docs], bool)
        docs = np.array([0 if doc is None else doc for doc in self.docs], "<i8")
        packed = self._zstd.compress(docs.tobytes() + null.tobytes() + np.array(self.ends, "<i8").tobytes())
        index = _INDEX.pack(self.part, self.number, len(docs)) + packed
        self._frame(_HEAD.pack(INDEX_MAGIC, len(index)) + index, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        table = b"".join(self.entries) + _FOOT.pack(len(self.entries), _CHECKED, END_MAGIC)
        return b"".join([*self.frames, _HEAD.pack(SEEK_MAGIC, len(table)), table])


class FileReader:
    """Reads a file's seek table and index; decompresses the frames asked for, and no others, and checks each."""

    def __init__(self, content: bytes):
        self.content, self.decompressed = memoryview(content), 0
        count, flags, magic = _FOOT.unpack(self.content[-_FOOT.size :])
        if magic != END_MAGIC or flags != _CHECKED:
            raise ValueError("not a token file, or one cut short")
        table = self.content[-_FOOT.size - count * _ENTRY.size : -_FOOT.size]
        sizes = np.frombuffer(table, "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes[:, 0])])
        self.places = np.concatenate([[0], np.cumsum(sizes[:, 1])])
        self.checksums = sizes[:, 2]
        self._zstd = zstandard.ZstdDecompressor()
        index = self.content[self.starts[-2] + _HEAD.size : self.starts[-1]]
        self.part, self.number, n = _INDEX.unpack(index[: _INDEX.size])
        raw = self._zstd.decompress(bytes(index[_INDEX.size :]))
        self.docs = np.frombuffer(raw, "<i8", n)
        self.null = np.frombuffer(raw, bool, n, 8 * n)
        self.ends = np.frombuffer(raw, "<i8", n, 9 * n)

    def ids(self, first: int, last: int) -> bytes:
        """The ids from place `first` up to `last` in the file, as little-endian unsigned 32-bit integers."""
        first, last = 4 * first, 4 * last
        if first >= last:
            return b""
        low, high = np.searchsorted(self.places, [first, last - 1], side="right") - 1
        data = b"".join(map(self._frame, range(low, high + 1)))
        return data[first - self.places[low] : last - self.places[low]]

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """Each document's id, the number of ids before it in the file, and its ids; every frame is decompressed once."""
        frames, held, base = iter(range(len(self.checksums) - 1)), b"", 0
        start = 0
        for doc, null, end in zip(self.docs.tolist(), self.null.tolist(), self.ends.tolist()):
            parts = [held[4 * start - base :]]
            got = len(parts[0])
            while got < 4 * (end - start):
                parts.append(self._frame(next(frames)))
                got += len(parts[-1])
            held, base = b"".join(parts), 4 * start
            yield (None if null else doc), start, held[: 4 * (end - start)]
            start = end

    def _frame(self, at: int) -> bytes:
        data = self._zstd.decompress(bytes(self.content[self.starts[at] : self.starts[at + 1]]))
        self.decompressed += 1
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checksums[at]:
            raise ValueError(f"frame {at} does not fit its checksum")
        return data


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, as many at once as PIECE_BYTES allow, but one at least."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
    start = 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def write_token_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 2,
    frame_ids: int = FRAME_IDS,
    file_ids: int = FILE_IDS,
) -> None:
    """Writes the ids of every document, each with `end_id` appended, to files in `folder`, by ascending document id.

    A null text counts as empty: its only id is the end. Documents without an id come first; rows of one id are ordered
    by their texts and stay documents of their own. Ids of documents must be whole numbers; other columns are not read. An empty table
    gives no file. Texts are dealt by ranges of (id, hash of the text), so that one repeated id does not meet in one task, then encoded
    and written where they lie; a task starts a new file every `file_ids` ids and holds no more than that. Spark's writer puts the
    files into place, so a task that is repeated leaves one copy.
    """
    if docs.schema[id_col].dataType.typeName() not in ("long", "integer", "short", "byte"):
        raise ValueError(f"{id_col} must hold whole numbers")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc", "print").sortWithinPartitions("doc", "print", "text").select("doc", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        file = FileWriter(part, 0, frame_ids)
        for batch in batches:
            for piece in _pieces(batch):
                for doc, ids in zip(piece.column("doc").to_pylist(), encoder.encode(piece.column("text"))):
                    file.add(doc, ids.tobytes() + end)
                    if file.ids >= file_ids:
                        yield pa.RecordBatch.from_pydict({"content": [file.finish()]})
                        file = FileWriter(part, file.number + 1, frame_ids)
        if file.docs:
            yield pa.RecordBatch.from_pydict({"content": [file.finish()]})

    # Spark's text writer ends each row by the line separator, one row a file: here the last byte of the seek table.
    files = dealt.mapInArrow(run, "content binary")
    files = files.select(F.expr("substring(content, 1, length(content) - 1)").cast("string").alias("value"))
    last = bytes([END_MAGIC >> 24]).decode("latin-1")
    files.write.option("encoding", "ISO-8859-1").option("lineSep", last).option("maxRecordsPerFile", 1).text(folder)


def _contents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths).select("path", "content")


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file, place) of every document in the files of a folder, which are read and checked.

    start: number of ids before the document in all files, in the order of writing; place: the same in its file, a path.
    """
    schema = "doc_id long, n_tokens long, ids_crc32 long, file string, place long, part long, number long, ids long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                file = FileReader(content.as_py())
                rows = [(doc, len(ids) // 4, zlib.crc32(ids), start) for doc, start, ids in file.documents()]
                docs, sizes, sums, places = zip(*rows)
                constant = [(pa.string(), path.as_py()), (pa.int64(), file.part), (pa.int64(), file.number)]
                name, part, number = (pa.array([value] * len(rows), kind) for kind, value in constant)
                total = pa.array([int(file.ends[-1])] * len(rows), pa.int64())
                columns = [pa.array(x, pa.int64()) for x in (docs, sizes, sums)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, name, pa.array(places, pa.int64()), part, number, total],
                    ["doc_id", "n_tokens", "ids_crc32", "file", "place", "part", "number", "ids"],
                )

    with Tables(spark) as tables:
        found = tables.save(_contents(spark, folder).mapInArrow(run, schema), "token-index")
        files = found.filter("place = 0").select("part", "number", "ids")
        before = F.sum("ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
        files = files.select("part", "number", F.coalesce(before, F.lit(0)).alias("before"))  # one row a file
        files = broadcast_if_small(tables.save(files, "token-files"), 24)
        joined = found.join(files, ["part", "number"]).select(
            "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "file", "place"
        )
        return tables.keep(joined, "token-index")


def read_documents(index: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, ids) of the documents whose id is in `wanted`, ids as array<long>: only files that hold one are opened, and
    of these only the frames that hold its ids are decompressed. Rows of one id are all returned; a null id finds nothing."""
    spark = index.sparkSession
    asked = wanted.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    found = saved(index.join(asked, "doc_id"), "wanted")
    paths = [row[0] for row in found.select("file").distinct().toLocalIterator()]
    schema = "doc_id long, start long, ids array<long>"
    if not paths:
        return spark.createDataFrame([], schema)
    each = F.sort_array(F.collect_list(F.struct("place", "n_tokens", "doc_id", "start"))).alias("asked")
    files = _contents(spark, paths).join(found.groupBy(F.col("file").alias("path")).agg(each), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, rows in zip(batch.column("content"), batch.column("asked").to_pylist()):
                file = FileReader(content.as_py())
                for row in rows:
                    ids = np.frombuffer(file.ids(row["place"], row["place"] + row["n_tokens"]), "<u4").astype(np.int64)
                    one = [pa.array([row["doc_id"]]), pa.array([row["start"]]), pa.array([ids], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(one, ["doc_id", "start", "ids"])

    return files.mapInArrow(run, schema)


def encode_and_index(docs: DataFrame, **settings) -> DataFrame:
    """Writes token files (`write_token_files`), reads them back (`token_index`), and removes them."""
    spark = docs.sparkSession
    folder = fresh_folder(spark, "tokens")
    write_token_files(docs, folder, **settings)
    found = token_index(spark, folder)
    remove(spark, folder)
    return found
