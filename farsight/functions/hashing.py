"""A deterministic local embedding: signed feature hashing (Weinberger et al., 2009).

It stands in for a model service where none can be reached. Each word goes to the bucket
`md5[0:8] mod dim` with the sign given by `md5[8:10]`; counts are summed and the vector is scaled
to unit length. A text without words gives zeros.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


#: Words whose cells are kept at hand, of each dimension.
MOST_KNOWN = 1 << 18
_known: dict[int, dict[str, int]] = {}


def _cells(words: Sequence[str], dim: int) -> np.ndarray:
    """Of each word twice its bucket, and one more if its sign is negative."""
    known = _known.setdefault(dim, {})
    if len(known) > MOST_KNOWN:
        known.clear()
    found = list(map(known.get, words))
    if None in found:
        for at, cell in enumerate(found):
            if cell is None:
                digest = hashlib.md5(words[at].encode("utf-8")).digest()
                known[words[at]] = found[at] = int.from_bytes(digest[:4], "big") % dim * 2 + digest[4] % 2
    return np.fromiter(found, np.int64, len(found))


def _sums(row: np.ndarray, cells: np.ndarray, rows: int, dim: int) -> np.ndarray:
    """Sums of signs by row and bucket."""
    sums = np.bincount(row * dim + (cells >> 1), weights=1.0 - 2.0 * (cells & 1), minlength=rows * dim)
    return sums.reshape(-1, dim)


def counts_of_words(word_lists: Sequence[Sequence[str]], dim: int) -> np.ndarray:
    """`hashed_counts` of lists of Python strings."""
    sizes = [len(words) for words in word_lists]
    cells = _cells(list(chain.from_iterable(word_lists)), dim)
    return _sums(np.repeat(np.arange(len(sizes)), sizes), cells, len(sizes), dim)


def hashed_counts(word_lists: pa.Array, dim: int) -> np.ndarray:
    """Signed word counts per bucket, one row per word list."""
    if isinstance(word_lists, pa.ChunkedArray):
        word_lists = word_lists.combine_chunks()
    coded = word_lists.flatten().dictionary_encode()
    cells = _cells(coded.dictionary.to_pylist(), dim)
    if not len(cells):
        return np.zeros((len(word_lists), dim))
    code = coded.indices.to_numpy(zero_copy_only=False)
    sizes = word_lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(word_lists)), sizes)
    return _sums(row, cells[code], len(word_lists), dim)


def unit_rows(counts: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return np.divide(counts, lengths, out=np.zeros_like(counts), where=lengths > 0).astype(np.float32)


def to_list_array(matrix: np.ndarray) -> pa.Array:
    """A float matrix as an Arrow array of equally long lists."""
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), pa.float32()))


def hash_embed_words(word_list: Column, dim: int, normalise: bool = True) -> Column:
    """The hashed vector of a column of word arrays, a whole Arrow batch at a time, no shuffle."""

    @F.arrow_udf("array<float>")
    def embed(word_lists: pa.Array) -> pa.Array:
        counts = hashed_counts(word_lists, dim)
        return to_list_array(unit_rows(counts) if normalise else counts.astype(np.float32))

    return embed(word_list)
