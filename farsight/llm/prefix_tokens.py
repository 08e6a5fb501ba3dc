"""Exact token counts at every prefix of a text, by dynamic programming over byte-pair encodings."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces whose counts a worker remembers; when full it starts anew.
REMEMBERED = 400_000


class PrefixCounter:
    """Token counts of texts and of all their prefixes for a byte-level BPE vocabulary file (tokenizers' JSON).

    Within a piece, the encoding of prefix i is that of a shorter prefix and one more token: the token t that ends
    at i and may follow the last token before it, which holds if encoding both tokens' bytes together gives the two
    back. So count[i] = count[i - len(t)] + 1, and every prefix costs a few lookups.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = _bytes_of_signs()
        self._id = {bytes(byte_of[sign] for sign in word): number for word, number in spec["model"]["vocab"].items()}
        self._token = {number: word for word, number in self._id.items()}
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        raw = lambda word: bytes(byte_of[sign] for sign in word)
        self._rank = {(self._id[raw(a)], self._id[raw(b)]): at for at, (a, b) in enumerate(merges)}
        self._lengths: dict[bytes, list[int]] = {}  # of the tokens that end in given two bytes, longest first
        for ending, length in sorted({(word[-2:], len(word)) for word in self._id}, key=lambda x: -x[1]):
            self._lengths.setdefault(ending, []).append(length)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._pieces = regex.compile(public_tokenizers.PATTERN).findall
        self._spans = regex.compile(public_tokenizers.PATTERN).finditer
        self._follows: dict[tuple[int, int], bool] = {}
        self._known: dict[str, int] = {}
        self._older: dict[str, int] = {}

    def _merge(self, data: bytes) -> list[int]:
        ids = [self._id[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min(zip(ids, ids[1:]), key=lambda pair: self._rank.get(pair, 1 << 30))
            if best not in self._rank:
                break
            whole, out, at = self._id[self._token[best[0]] + self._token[best[1]]], [], 0
            while at < len(ids):
                if at + 1 < len(ids) and (ids[at], ids[at + 1]) == best:
                    out.append(whole)
                    at += 2
                else:
                    out.append(ids[at])
                    at += 1
            ids = out
        return ids

    def _may_follow(self, before: int, token: int) -> bool:
        """before is -1 at the start of a piece."""
        key = (before, token)
        if (known := self._follows.get(key)) is None:
            data = self._token[token] if before < 0 else self._token[before] + self._token[token]
            known = self._merge(data) == ([token] if before < 0 else [before, token])
            if len(self._follows) > REMEMBERED:
                self._follows.clear()
            self._follows[key] = known
        return known

    def piece_counts(self, data: bytes) -> list[int]:
        """Token count of each prefix, by bytes, of one piece; the first is that of no byte, 0."""
        last, count, find, lengths, follows = [-1], [0], self._id.get, self._lengths.get, self._follows.get
        for end in range(1, len(data) + 1):
            for length in (*lengths(data[max(0, end - 2) : end], ()), 1):
                start = end - length
                if start < 0 or (token := find(data[start:end])) is None:
                    continue
                known = follows((last[start], token))
                if known or known is None and self._may_follow(last[start], token):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
        return count

    def _count_piece(self, piece: str) -> int:
        found = self._known.get(piece)
        if found is None:
            if len(self._known) > REMEMBERED:  # the least recently met half goes
                self._known, self._older = {}, self._known
            found = self._older.get(piece) or self.piece_counts(piece.encode())[-1]
            self._known[piece] = found
        return found

    def count(self, text: str) -> int:
        """Token count of a whole text; a special token inside it is one token, as the library has it."""
        total = 0
        for at, part in enumerate(self._special.split(text) if self._special else [text]):
            if at % 2:
                total += 1
                continue
            pieces = self._pieces(part)
            try:
                total += sum(map(self._known.__getitem__, pieces))
            except KeyError:
                total += sum(map(self._count_piece, pieces))
        return total

    def prefixes(self, text: str) -> np.ndarray:
        """Token count of text[:k] for each k from 0 to len(text)."""
        out = np.zeros(len(text) + 1, np.int32)
        start = 0
        safe, before = 0, 0  # a cut inside a special token is counted from here
        for at, part in enumerate(self._special.split(text) if self._special else [text]):
            if at % 2:
                for k in range(start + 1, start + len(part)):
                    out[k] = before + self.count(text[safe:k])
                out[start + len(part)] = out[start] + 1
                safe, before = start + len(part), int(out[start]) + 1
            elif part:
                safe, before = self._part(part, start, out)
            start += len(part)
        return out

    def _part(self, part: str, offset: int, out: np.ndarray) -> tuple[int, int]:
        """Fills the counts of a part without special tokens; returns where its last piece but one starts, and the
        count before that."""
        total, starts, gap = int(out[offset]), [], None
        for found in self._spans(part):
            a, b, piece = found.start(), found.end(), found.group()
            starts.append((offset + a, total))
            if piece[0].isspace() or not piece.strip():
                if gap is None:
                    gap = (a, total)
            else:
                gap = None
            if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():  # a contraction falls apart when cut
                for k in range(a + 1, b):
                    out[offset + k] = total + sum(map(self._count_piece, self._pieces(part[a:k])))
            else:
                counts = self.piece_counts(piece.encode())
                at = 0
                for k, sign in enumerate(piece, a + 1):
                    at += len(sign.encode())
                    out[offset + k] = total + counts[at]
            if gap is not None:  # a cut inside white space leaves it as one piece from its start
                run_start, before = gap
                run_end = a + len(piece) - len(piece.lstrip())
                run = part[run_start:run_end]
                counts = self.piece_counts(run.encode())
                at = len(part[run_start:a].encode())
                for k in range(a + 1, run_end + 1):
                    at += len(part[k - 1].encode())
                    out[offset + k] = before + counts[at]
                if run_end < b:
                    gap = None
            total += self._count_piece(piece)
            if gap is None or b == len(part):
                out[offset + b] = total
        out[offset + len(part)] = total
        return starts[-2:][0]


def _bytes_of_signs() -> dict[str, int]:
    """The signs by which byte-level vocabularies write the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + at): b for at, b in enumerate(hidden)}


@functools.cache
def _counter(name: str) -> PrefixCounter:
    return PrefixCounter(public_tokenizers.path(name))


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    limit: int = 1024,
    prefixes: bool = False,
) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, n_tokens, over_limit, fits; with `prefixes` also prefix_counts.

    `fits` is the number of characters of the longest prefix of at most `limit` tokens (null unless `prefixes`);
    prefix_counts holds the count of each prefix, from 0 characters to all. A null text counts as empty: 0 bytes, 0
    tokens. Special tokens inside a text are one token each, none are added. Rows may repeat; other columns are
    neither read nor returned; an empty table gives no rows. No shuffle: each text is worked on where it is read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            texts = ["" if text is None else text for text in batch.column(1).to_pylist()]
            tokens = [counter.count(text) for text in texts]
            columns = {
                id_col: batch.column(0),
                "n_bytes": pa.array([len(text.encode()) for text in texts], pa.int64()),
                "n_tokens": pa.array(tokens, pa.int64()),
                "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
            }
            if prefixes:
                tables = [counter.prefixes(text) for text in texts]
                columns["fits"] = pa.array([int(np.flatnonzero(t <= limit)[-1]) for t in tables], pa.int64())
                columns["prefix_counts"] = pa.array(tables, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    if prefixes:
        schema += ", fits long, prefix_counts array<int>"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(count, schema)
