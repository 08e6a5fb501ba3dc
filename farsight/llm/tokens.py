"""Words and word shingles of Arrow text columns as numpy arrays, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Words in a shingle.
SHINGLE = 5
#: Text bytes worked on at once; a longer text is worked on alone.
PIECE_BYTES = 2 << 20
_BLOCK = 1 << 15
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = np.where(_SPACE, 0, _LOWER.astype(np.uint64) + 1).astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_FACTOR = mixed(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)


@dataclass
class Words:
    """The words of some texts: 64-bit hashes (of words with A-Z in lower case) and, by text, where they begin."""

    hashes: np.ndarray
    first: np.ndarray  # of text i: words first[i] to first[i + 1]
    endings: np.ndarray | None = None  # a number of each word's last three bytes, if asked for

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most PIECE_BYTES of text, or one row."""
    lengths = batch.column(column).cast(pa.large_string())
    ends = np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1] if len(lengths) else np.zeros(1, np.int64)
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[at] + PIECE_BYTES, side="right")) - 1
        stop = min(max(stop, at + 1), batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop


def words_of(texts: pa.Array, endings: bool = False) -> Words:
    """Words are runs without ASCII white space; null texts have none."""
    texts = pa.concat_arrays([texts.fill_null("").cast(pa.large_string())])
    if not len(texts):
        return Words(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32) if endings else None)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    base = int(ends[0])
    size = int(ends[-1]) - base
    data = np.frombuffer(texts.buffers()[2], np.uint8)[base : base + size] if size else np.zeros(0, np.uint8)
    ends = ends - base
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = ends[:-1][ends[:-1] < size]
    begins[borders] = inside[borders]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, ends, side="left")
    return Words(_hashed(data, starts), first, _endings(data, inside, begins, starts) if endings else None)


def _endings(data: np.ndarray, inside: np.ndarray, begins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    over = inside.copy()
    over[:-1] &= ~inside[1:] | begins[1:]
    last = np.flatnonzero(over)
    out = _LOWER[data[last]].astype(np.uint32)
    for back in (1, 2):
        at = last - back
        out = out * np.uint32(256) + np.where(at >= starts, _LOWER[data[np.maximum(at, 0)]], 0)
    return out


def _hashed(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash per word; white space, which counts 0, may follow a word."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            lo = int(starts[at])
            stop = max(int(np.searchsorted(starts, lo + _BLOCK, side="right")) - 1, at + 1)
            if stop >= len(starts) - 1:
                stop = len(starts)
            hi = int(starts[stop]) if stop < len(starts) else len(data)
            own = starts[at:stop] - lo
            place = np.arange(hi - lo) - np.repeat(own, np.diff(own, append=hi - lo))
            if hi - lo > len(_FACTOR):
                place &= len(_FACTOR) - 1
            sums = np.add.reduceat(_VALUE.take(data[lo:hi]) * _FACTOR.take(place), own)
            out[at:stop] = mixed(sums + GOLDEN)
            at = stop
    return out


_ORDER = mixed(np.arange(101, 101 + 64, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def shingles_of(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each shingle of `size` words; a text of fewer words, but some, has one shingle of them all."""
    counts = words.counts
    with np.errstate(over="ignore"):
        n = max(len(words.hashes) - size + 1, 0)
        hashes = np.zeros(n, np.uint64)
        for k in range(size):
            hashes += words.hashes[k : k + n] * _ORDER[k]
        text = np.repeat(np.arange(len(counts)), counts)
        last = words.first[1:][text[:n]] if n else np.zeros(0, np.int64)
        whole = np.arange(n) + size <= last
        found_text, found = text[:n][whole], mixed(hashes[whole])
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            own = np.zeros(len(short), np.uint64)
            for k in range(size - 1):
                has = counts[short] > k
                own[has] += words.hashes[words.first[short[has]] + k] * _ORDER[k]
            found_text = np.concatenate([found_text, short])
            found = np.concatenate([found, mixed(own + GOLDEN * counts[short].astype(np.uint64))])
    return found_text, found


def counted(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, times) of each different hash of each text, in this order."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    if not len(text):
        return text, hashes, np.zeros(0, np.int64)
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text)))


def overlap(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle multisets of each pair of texts; 0 if either has no word."""
    a_text, a_hash, a_times = counted(*shingles_of(words_of(left)))
    b_text, b_hash, b_times = counted(*shingles_of(words_of(right)))
    text = np.concatenate([a_text, b_text])
    hashes = np.concatenate([a_hash, b_hash])
    times = np.concatenate([a_times, b_times])
    order = np.lexsort((hashes, text))
    text, hashes, times = text[order], hashes[order], times[order]
    both = np.zeros(len(left))
    if len(text) > 1:
        same = (text[1:] == text[:-1]) & (hashes[1:] == hashes[:-1])
        np.add.at(both, text[1:][same], np.minimum(times[1:], times[:-1])[same])
    total = np.bincount(text, weights=times, minlength=len(left)) - both
    return np.divide(both, total, out=np.zeros(len(left)), where=total > 0)
