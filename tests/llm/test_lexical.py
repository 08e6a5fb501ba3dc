"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from farsight.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=50):
    counts = [(doc, Counter(terms(text))) for doc, text in docs if terms(text)]
    n_docs, all_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // all_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) & set(c)
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def frames(spark, docs, items):
    clash = [f"'x' AS {c}" for c in "doc item term terms n counts score rank task salt id".split()]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", *clash).repartition(3),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", *clash),
    )


@pytest.mark.parametrize("settings", [{}, {"max_block_bytes": 300}, {"k": 2}])
def test_equal_to_brute_force(spark, settings, monkeypatch):
    rng = random.Random(1)
    words = [f"W{n}x" for n in range(40)] + ["Größe", "naïve", "日本語"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(300)]
    docs += [(500 + i, "w1X w2x, w3x!") for i in range(70)]  # copies: more ties than are kept
    docs += [(7, "w1x"), (7, "w1x"), (None, "w1x w2x"), (None, None), (900, ""), (901, "... --"), (902, "w5x " * 40_000)]
    items = [(i, " ".join(rng.choices(words, k=6))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "unknown"), (23, "w1x w2x w3x"), (23, "w1x w2x w3x"), (None, "w4x W4X")]
    found = L.search_items(*frames(spark, docs, items), **settings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(row) for row in found.collect()), key=str) == brute(docs, items, settings.get("k", 50))


def test_empty_tables(spark):
    some = [(1, "one two")]
    for docs, items in ([], some), (some, []), ([], []), ([(1, None), (2, "")], some):
        assert L.search_items(*frames(spark, docs, items)).count() == 0


def test_terms_as_the_pattern_has_them():
    text = "".join(map(chr, range(0x250))) + "AbC_dé9\x00z {|}  \xa0x\U0001F600"
    assert [t.decode() for t in L.terms_of(text.encode())] == terms(text)


def test_narrow_pieces_give_the_same_sums(monkeypatch):
    rng = np.random.default_rng(3)
    block = L.ItemBlock(list(range(5)), [" ".join(f"t{x}" for x in rng.integers(0, 60, 30)).encode() for _ in range(5)])
    weights = rng.integers(0, 40_000, len(block.number))
    (tile,) = L.ItemTiles(block, weights).tiles
    row, term = np.nonzero(rng.random((50, len(block.number) + 3)) < 0.3)
    impact = rng.integers(1, 999_999, len(row))
    plain = np.zeros((50, 5), object)
    for r, t, i in zip(row, term, impact):
        for item, own in enumerate(block.terms):
            plain[r, item] += int(i) * int(weights[t]) if t in own else 0
    for exact in (1 << 53, 1 << 37, 1 << 20):  # down to one term at once
        monkeypatch.setattr(L, "EXACT", exact)
        assert (L.tile_scores(tile, weights, 50, row, term, impact) == plain).all()
