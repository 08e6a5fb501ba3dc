"""The language model's training steps and scores against plain sums."""

import numpy as np

from farsight.llm import lm


def drawn(n=3 * lm.BLOCK + 77):
    rng = np.random.default_rng(3)
    types = (np.minimum(rng.zipf(1.3, n), lm.ENDINGS - 1) * 16 + rng.integers(0, 10, n)).astype(np.uint16)
    types[::3] = 32768 + rng.integers(0, lm.HEADS, len(types[::3]))
    cluster = (np.arange(lm.ENDINGS) % lm.CLUSTERS).astype(np.int32)
    weights = rng.normal(size=(lm.FEATURE_ROWS, lm.CLASSES)).astype(np.float32) * np.float32(0.1)
    return lm.Model(cluster, np.zeros(lm.CLASSES), weights), types, np.arange(n) % 50 == 0


def test_sums_of_frequent_and_rare_ids():
    rng = np.random.default_rng(4)
    for ids in (rng.zipf(1.3, 5000) % 9000, np.zeros(40), np.arange(7), np.repeat([5, 9], [lm.MANY_ROWS, lm.MANY_ROWS - 1])):
        ids, slope = ids.astype(np.uint16), rng.normal(size=(len(ids), lm.CLASSES)).astype(np.float32)
        wanted = np.zeros((9000, lm.CLASSES))
        np.add.at(wanted, ids, slope)
        at, total = lm._summed(ids, slope)
        assert at.tolist() == sorted(set(ids.tolist()))
        assert np.allclose(total, wanted[at], atol=1e-3)


def test_a_training_step():
    model, types, first = drawn()
    weights, squares = model.weights.astype(np.float64), np.full_like(model.weights, 1e-2)
    rows, target = model.features(types, first), model.classes(types, left_out=True)
    slope = np.exp(model.log_probabilities(rows).astype(np.float64))
    slope[np.arange(len(types)), target] -= 1
    model.train(types, first, squares)
    for k in range(rows.shape[1]):
        total = np.zeros_like(weights)
        np.add.at(total, rows[:, k], slope)
        weights -= lm.RATE * total / np.sqrt(1e-2 + total * total)
    assert np.allclose(model.weights, weights, atol=1e-3)


def test_chances_of_what_came():
    model, types, first = drawn()
    rows, classes = model.features(types, first), model.classes(types)
    logs = model.log_probabilities(rows)[np.arange(len(types)), classes]
    assert np.allclose(model.log_chances(rows, classes), logs, atol=1e-5)
