"""Hard negatives against brute force, and the parts they are made of."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farsight.llm import negatives as N
from farsight.llm.common import Tables


def brute(rows, is_anchor, scale=256, positives=5, negatives=3, window=(50, 95)):
    taking = {}
    for id_, label, vector in rows:
        if id_ is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        row = (label, [int(np.floor(scale * x)) for x in vector])
        taking[id_] = min(taking.get(id_, row), row)
    out = []
    for a, (label, vector) in taking.items():
        if not is_anchor(a):
            continue
        score = {c: sum(x * y for x, y in zip(vector, v)) for c, (_, v) in taking.items() if c != a}
        ranked = sorted(score, key=lambda c: (-score[c], c))
        for p in [c for c in ranked if taking[c][0] == label][:positives]:
            inside = [c for c in ranked if taking[c][0] != label
                      and window[0] * score[p] <= 100 * score[c] <= window[1] * score[p]]
            out += [(a, p, rank, c, score[p], score[c]) for rank, c in enumerate(inside[:negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    clash = "id v anchor place folder block low high ids vectors search score rank task floor salt".split()
    return df.selectExpr("*", *(f"'{name}' AS {name}" for name in clash))


def clusters(n, dim, seed, spread=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    at = rng.integers(0, 8, n)
    return [
        (i, int(rng.integers(0, 3)), (centres[c] + spread * rng.normal(size=dim)).astype(np.float32).tolist())
        for i, c in enumerate(at)
    ]


@pytest.mark.parametrize("settings", [{}, {"block_rows": 7, "slab_bytes": 900}])
def test_equal_to_brute_force(spark, settings):
    rows = clusters(400, 6, 1) + [(1000 + i, 1, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(60)]  # copies: ties
    rows += [(2000 + i, 2, [0.75, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(30)]
    found = N.mine_negatives(frame(spark, rows), F.col("vec_id") % 25 == 0, **settings)
    got = sorted(tuple(row) for row in found.collect())
    assert got == brute(rows, lambda i: i % 25 == 0) and len(got) > 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.5, 0.5]), (3, 2, [0.5, None]), (4, 2, [nan, 1.0])]
    rows += [(5, 1, [inf, 1.0]), (6, None, [1.0, 1.0]), (7, 2, None), (None, 2, [0.75, 0.75]), (8, 2, []), (9, 2, [0.9])]
    rows += [(10, 2, [0.5, 0.5]), (10, 2, [0.5, 0.5]), (10, 3, [0.1, 0.1]), (11, 1, [-1.0, -1.0]), (12, 3, [0.0, 0.0])]
    found = N.mine_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(row) for row in found.collect()) == brute(rows, lambda i: i % 10 == 0)
    for none in ([], [(1, 1, [1.0])], [(0, 1, [1.0]), (1, 1, [2.0])]):
        assert N.mine_negatives(frame(spark, none), F.col("vec_id") % 10 == 0).count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        N.mine_negatives(frame(spark, [(0, 1, [1e30]), (1, 2, [1e30])]), F.col("vec_id") == 0)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 2), [float(np.float32(x)) for x in rng.normal(size=3) * 2**18]) for i in range(60)]
    found = N.mine_negatives(frame(spark, rows), F.col("vec_id") % 5 == 0)
    assert sorted(tuple(row) for row in found.collect()) == brute(rows, lambda i: i % 5 == 0)


def test_the_curve_visits_each_cell_once_and_moves_by_one():
    for dims, bits in [(2, 4), (3, 3), (4, 2)]:
        cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims), axis=-1).reshape(-1, dims)
        place = N.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(2)
    anchors, rows = rng.integers(-300, 300, (20, 8)), rng.integers(-300, 300, (50, 8))
    least, most = N.bounds(anchors, rows.min(0)[None], rows.max(0)[None], True)
    scores = anchors @ rows.T
    assert (least[:, 0] <= scores.min(1)).all() and (most[:, 0] >= scores.max(1)).all()
    assert (N.products(anchors, rows, True) == scores).all()


def test_percents_stay_in_64_bits():
    values = np.array([2**62, -(2**62), 199, -199, 0])
    assert N._percent(values, 95).tolist() == [v * 95 // 100 for v in values.tolist()]


def test_folders_that_cannot_hold_a_hit_are_not_read(spark):
    rows = clusters(3000, 6, 4, spread=0.02)
    with Tables(spark) as tables:
        taking = tables.save(
            N._participants(frame(spark, rows), F.col("vec_id") < 3, "vec_id", "label", "embedding", 256.0), "taking"
        )
        index = N.BlockIndex(tables, taking, 6, 16, folder_bytes=16 * 6 * 8)
        slab = index.slab(index.anchors(5), 5)
        assert len(slab.ids) == 3
        needed = index._needed(tables, tables.share(slab), "for_positives")
        assert "dynamicpruning" in needed._jdf.queryExecution().toString()
        read, every = needed.count(), index.blocks.count()
        assert 0 < read < every / 3
        # no block read is one without a label of an anchor
        assert {row[0] for row in needed.select("label").distinct().collect()} <= set(slab.labels.tolist())


def test_best_keeps_ties_by_id():
    best = N.Best(2, 3)
    best.offer(np.array([1]), np.array([[5, 5, 5, 5, 1] * 5]), np.ones((1, 25), bool), np.arange(100, 125))
    best.offer(np.array([1]), np.array([[5, 9]]), np.array([[True, False]]), np.array([7, 8]))
    rows = pa.Table.from_batches([best.rows()]).to_pylist()
    assert [(r["search"], r["id"], r["score"]) for r in rows] == [(1, 7, 5), (1, 100, 5), (1, 101, 5)]
