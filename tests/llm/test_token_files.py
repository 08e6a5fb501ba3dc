"""Token files: exact round trips, the library's ids, and the frames that a reader opens."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from farsight.llm import token_files as T

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
ENCODER = T.WordEncoder(VOCABULARY)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def encoded(encoder, text):
    ahead, found, _ = encoder.encode(pa.array(["words ahead, x", text, "after it"]))
    assert ahead.tolist() == LIBRARY.encode("words ahead, x", add_special_tokens=False).ids
    return found.tobytes()


def packed(ids):
    return np.array(ids, "<u4").tobytes()


ODD = ["it's we'll ́x á İİ ẞ", "a\x0bb\x1cc\x85d e\xa0f", "<|startoftext|>a<|endoftext|> <|endoftext|", "12345 ٠١ ½"]


@pytest.mark.parametrize("text", [*ODD, "", " ", "x" * 3000, "각 \U0001F600‍\U0001F468", "a\r\nb\tc\fd", "\x00 \x1f"])
def test_ids_are_the_librarys(text):
    assert encoded(ENCODER, text) == packed(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sdA<|>endoftext̸́=")), max_size=60))
def test_ids_of_any_text(text):
    assert encoded(ENCODER, text) == packed(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_lower_casing_may_split_a_run():
    assert encoded(T.WordEncoder(VOCABULARY), "İx, ÀÉ. abc.") == packed(LIBRARY.encode("İx, ÀÉ. abc.", add_special_tokens=False).ids)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED_BYTES", 300)
    small = T.WordEncoder(VOCABULARY)
    for start in range(0, 60, 7):
        text = " ".join(f"word{n % 23} other{n}" for n in range(start, start + 30)) + " " + "y" * 100
        assert encoded(small, text) == packed(LIBRARY.encode(text, add_special_tokens=False).ids)


def made(docs, frame_ids=100):
    file = T.FileWriter(3, 4, frame_ids)
    for doc, ids in docs:
        file.add(doc, packed(ids))
    return file.finish()


def test_a_reader_opens_only_the_frames_it_needs():
    rng = np.random.default_rng(1)
    docs = [(i if i % 9 else None, rng.integers(0, 49_000, int(n))) for i, n in enumerate(rng.integers(0, 90, 60))]
    docs[20] = (20, rng.integers(0, 49_000, 1000))  # several frames
    content = made(docs)
    file = T.FileReader(content)
    assert (file.part, file.number) == (3, 4) and len(file.checksums) > 10
    assert [(d, i) for d, _, i in file.documents()] == [(d, packed(i)) for d, i in docs]
    assert file.decompressed == len(file.checksums) - 1  # each once; the index is no data frame
    for at, (_, ids) in enumerate(docs):
        fresh = T.FileReader(content)
        start = 0 if not at else int(fresh.ends[at - 1])
        assert fresh.ids(start, int(fresh.ends[at])) == packed(ids)
        assert fresh.decompressed <= 2 + len(ids) // 200
    # any zstandard reader can read the data from end to end, and skips index and seek table
    plain = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert plain == b"".join(packed(ids) for _, ids in docs)


def test_damage_is_noticed():
    content = bytearray(made([(1, range(500)), (2, range(500))]))
    with pytest.raises(ValueError):
        T.FileReader(bytes(content[:-1]))
    file = T.FileReader(bytes(content))
    file.checksums[4] ^= 1
    with pytest.raises(ValueError, match="frame 4"):
        file.ids(500, 1000)
    content[int(file.starts[0]) + 30] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        T.FileReader(bytes(content)).ids(0, 500)


ROWS = [(5, "five words of a text"), (1, None), (2, ""), (4, "same"), (4, "same"), (4, "other"), (None, "no id"), (3, "  \n ")]
ROWS += [(100 + i, f"document {i} has its own words " * (i % 5)) for i in range(60)] + [(50, "very long text " * 30_000), *((60 + i, t) for i, t in enumerate(ODD))]


@pytest.mark.parametrize("how", [{}, {"frame_ids": 50, "file_ids": 400}])
def test_written_and_read_back(table, spark, how):
    found = T.encode_and_index(table(ROWS), **how).collect()
    assert len(found) == len(ROWS)
    by_place = sorted(found, key=lambda row: row["start"])
    keys = [(-1 if row["doc_id"] is None else row["doc_id"]) for row in by_place]
    assert keys == sorted(keys)
    start = 0
    for row in by_place:
        assert row["start"] == start
        start += row["n_tokens"]
    wanted = sorted((str(doc), len(ids_of(text)), zlib.crc32(packed(ids_of(text)))) for doc, text in ROWS)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in found) == wanted
    again = T.encode_and_index(table(ROWS).repartition(5), **how).drop("file", "place").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in T.encode_and_index(table(ROWS), **how).drop("file", "place").collect())


def test_no_documents(table):
    assert T.encode_and_index(table([])).count() == 0


def test_documents_by_id(table, spark, tmp_path):
    T.write_token_files(table(ROWS), str(tmp_path / "tokens"), frame_ids=50, file_ids=400)
    index = T.token_index(spark, str(tmp_path / "tokens"))
    assert index.select("file").distinct().count() > 3
    wanted = spark.createDataFrame([(4,), (50,), (120,), (999,), (None,), (4,)], "doc_id long")
    found = T.read_documents(index, wanted).collect()
    texts = sorted((doc, ids_of(text)) for doc, text in ROWS if doc in (4, 50, 120))
    assert sorted((row["doc_id"], row["ids"]) for row in found) == texts
    assert T.read_documents(index, wanted.filter("doc_id = 999")).count() == 0


def test_words_are_cut_from_one_buffer():
    """Without an object of pyarrow's for each word, which took a third of the time of known words."""
    words = ["", "one", "größe", "", "x" * 70, "last"]
    for array in (pa.array(words), pa.array(words)[2:], pa.array([], pa.string()), pa.array(["", ""])):
        assert T._bytes_of(array.cast(pa.binary())) == array.cast(pa.binary()).to_pylist()


def test_a_word_without_ids_is_remembered(monkeypatch):
    """One that the vocabulary drops whole, met again after others have pushed it out of the newer half of the memory."""
    monkeypatch.setattr(T, "REMEMBERED_BYTES", 1)
    encoder = T.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = pa.array(["\x00 hello"])
    for _ in range(3):
        assert [ids.tolist() for ids in encoder.encode(texts)] == [encoder.tokenizer.encode("\x00 hello", add_special_tokens=False).ids]
        encoder.encode(pa.array([f"word{_}"]))
