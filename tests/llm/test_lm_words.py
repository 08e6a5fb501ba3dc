"""The language model tells words of the same ending and frequency apart, in histories and among the words of a class."""

import numpy as np

from pyspark.sql import functions as F

from farsight.llm import lm

#: Words of one length, ending and count; each first word is followed by its own second one.
FIRST = [f"{a}{b}olan" for a in "bdfgk" for b in "aeiu"]
SECOND = [f"{a}{b}emit" for a in "mnprs" for b in "aeiu"]
PAIRS = list(zip(FIRST, SECOND))


def test_words_of_one_ending_are_told_apart(spark):
    rows = spark.createDataFrame([(11, 3, 5), (12, 3, 5), (11, 3, 1), (12, 3, 1)], "word long, ending int, count long")
    mixed = F.xxhash64("word")
    seen = [row[0] for row in rows.select(lm._type(F.lit(None).cast("int"), F.col("ending"), F.col("count"), mixed)).collect()]
    assert seen[0] != seen[1] and seen[0] & 0xFFFF == seen[1] & 0xFFFF
    assert seen[2] == seen[3]  # met once: by ending and band
    model = lm.Model(np.zeros(lm.ENDINGS, np.int32), np.zeros(lm.CLASSES), np.zeros((lm.FEATURE_ROWS, lm.CLASSES), np.float32))
    first = np.array([True, False])
    one, other = (model.features(np.array([kind, kind], np.uint32), first) for kind in seen[:2])
    assert (one[0] == other[0]).all() and one[1, 0] != other[1, 0] and one[1, 6] != other[1, 6]


def test_what_follows_a_word_is_learned(table):
    texts = [" ".join(f"{a} {b}" for a, b in (PAIRS[(i * j + k) % 20] for k in range(20))) for i in range(40) for j in (1, 3, 7, 9)]
    right = " ".join(f"{a} {b}" for a, b in PAIRS)
    wrong = " ".join(f"{a} {PAIRS[(k + 7) % 20][1]}" for k, (a, _) in enumerate(PAIRS))
    rows = [*enumerate(texts), (1000, right), (1001, wrong)]
    found = {r["doc_id"]: r for r in lm.score_texts(table(rows), F.col("doc_id") >= 1000).collect()}
    assert abs(found[1000]["base_score"] - found[1001]["base_score"]) < 1e-6
    assert found[1000]["score"] > found[1001]["score"] + 2
    assert found[1000]["score"] > found[1000]["base_score"]


def drawn():
    rng = np.random.default_rng(5)
    n = lm.BATCH + 500
    types = (np.minimum(rng.zipf(1.3, n), lm.ENDINGS - 1) * 16 + rng.integers(2, 10, n)).astype(np.uint32) | rng.integers(0, 1 << 16, n).astype(np.uint32) << 16
    types[::3] = 32768 + rng.integers(0, lm.HEADS, len(types[::3])) | 7 << 16
    shares = rng.random((lm.CLASSES, lm.GROUPS)).astype(np.float32)
    shares /= shares.sum(axis=1, keepdims=True)
    weights = rng.normal(size=(3 * lm.HASHED, lm.GROUPS)).astype(np.float32) * np.float32(0.3)
    cluster = (np.arange(lm.ENDINGS) % lm.CLUSTERS).astype(np.int32)
    return lm.Model(cluster, np.zeros(lm.CLASSES), np.zeros((lm.FEATURE_ROWS, lm.CLASSES), np.float32), shares, weights), types, np.arange(n) % 50 == 0


def plain(model, types, first):
    """Chances of all groups of each token of a class of many words."""
    classes = model.classes(types)
    own = np.flatnonzero((classes >= lm.HEADS) & (classes < lm.UNKNOWN))
    rows = model.group_rows(types, first, own, classes[own])
    chances = np.exp(model.group_weights[rows].astype(np.float64).sum(axis=0)) * model.shares[classes[own]]
    return own, rows, chances / chances.sum(axis=1, keepdims=True)


def test_gains_are_those_of_a_distribution():
    model, types, first = drawn()
    own, _, chances = plain(model, types, first)
    classes, groups = model.classes(types), (types >> 16 >> 11).astype(int)
    gains = model.group_gains(types, first, classes)
    assert np.allclose(gains[own], np.log(chances[np.arange(len(own)), groups[own]] / model.shares[classes[own], groups[own]]), atol=1e-4)
    assert not np.delete(gains, own).any()


def test_a_training_step_of_the_groups():
    model, types, first = drawn()
    types, first = types[: lm.BATCH], first[: lm.BATCH]
    own, rows, slope = plain(model, types, first)
    kept = model.classes(types)[own] == model.classes(types, left_out=True)[own]
    own, rows, slope = own[kept], rows[:, kept], slope[kept]
    slope[np.arange(len(own)), (types[own] >> 16 >> 11).astype(int)] -= 1
    weights = model.group_weights.astype(np.float64)
    model.train_groups(types, first, np.full_like(model.group_weights, 1e-2))
    for row in rows:
        total = np.zeros_like(weights)
        np.add.at(total, row, slope)
        weights -= lm.RATE * total / np.sqrt(1e-2 + total * total)
    assert np.allclose(model.group_weights, weights, atol=1e-3)
