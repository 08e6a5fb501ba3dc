import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farsight.functions.distance import METRICS
from farsight.functions.text import extract_keywords
from farsight.operators import ranking as R
from farsight.operators import search as S
from farsight.sources.collection import Collection

WORDS = [f"word{n}" for n in range(12)]


def make_points(n=400, dim=4, seed=3):
    """Points with many ties: a third are copies, and vectors are coarse."""
    rng = random.Random(seed)
    points = []
    for at in range(n):
        if at % 3 == 0:
            vector, text = [1.0, 0.5, 0.0, -0.5][:dim], "word0 word1 copies"
        else:
            vector = [rng.choice([-1.0, -0.5, 0.0, 0.5, 1.0]) for _ in range(dim)]
            text = " ".join(rng.sample(WORDS, 3))
        points.append((f"p{at}", text, vector))
    return points


def exact_search(points, query, vector, keywords, metric, limit, offset=0, c=60):
    sign = 1 if METRICS[metric] else -1

    def score(v):
        a, b = np.array(v, dtype=float), np.array(vector, dtype=float)
        if metric == "Dot":
            s = a @ b
        elif metric == "Cosine":
            norm = np.linalg.norm(a) * np.linalg.norm(b)
            s = a @ b / norm if norm else 0.0
        else:
            s = np.linalg.norm(a - b) if metric == "Euclid" else np.abs(a - b).sum()
        return float(f"{s:.11e}") + 0.0

    wanted = limit + offset
    ranked = sorted((-sign * score(v), i, t) for i, t, v in points)
    if not keywords:
        return [(i, -sign * cost + 0.0) for cost, i, _ in ranked[offset:wanted]]
    fused = {}
    legs = [(ranked, max(10 * wanted, 50))]
    legs += [([r for r in ranked if k in r[2].split()], max(4 * wanted, 20)) for k in keywords]
    for leg, cut in legs:
        for rank, (_, i, _) in enumerate(leg[:cut], start=1):
            fused.setdefault(i, []).append(1 / (c + rank))
    best = sorted((-sum(sorted(s)), i) for i, s in fused.items())
    return [(i, -s) for s, i in best[offset:wanted]]


@pytest.fixture(scope="module")
def points():
    return make_points()


def collection(spark, points, metric, partitions=7):
    df = spark.createDataFrame(points, "id string, text string, embedding array<float>")
    return Collection.from_table("c", df.repartition(partitions), 4, distance=metric)


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("query", ["word0 and word5 near", "what is the"])
def test_search_is_exact(spark, points, metric, query):
    vector = [0.5, 0.5, -1.0, 0.5]
    keywords = S.query_keywords(spark, query)
    c = collection(spark, points, metric)
    for limit, offset in [(10, 4), (60, 0)]:
        found = S.search(c, query, limit, offset, query_vector=vector).collect()
        expected = exact_search(points, query, vector, keywords, metric, limit, offset)
        assert [(row["ID"], pytest.approx(row["SCORE"], abs=2e-9)) for row in found] == expected
        assert [row["QUERY"] for row in found] == [query] * len(expected)


@pytest.mark.parametrize("query", ["word0 and word5 near", "what is the"])
def test_hits_come_best_first_every_time(spark, points, query):
    vector, keywords = [0.5, 0.5, -1.0, 0.5], S.query_keywords(spark, query)
    c = collection(spark, points, "Manhattan")
    expected = [i for i, _ in exact_search(points, query, vector, keywords, "Manhattan", 10, 4)]
    for _ in range(15):  # the adaptive optimizer once dropped the last sort in one run of seven
        found = S.search(c, query, 10, 4, query_vector=vector)
        assert [row["ID"] for row in found.collect()] == expected


def _queries(spark, n):
    rng = random.Random(9)
    rows = []
    for at in range(n):
        text = "what is the" if at % 5 == 0 else " ".join(rng.sample(WORDS, 2))
        rows.append((at, text, [rng.choice([-1.0, 0.0, 1.0, 0.5]) for _ in range(4)]))
    return rows, spark.createDataFrame(rows, "query_id long, query string, query_vector array<float>")


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
@pytest.mark.parametrize("dealt", [False, True])
def test_many_queries_are_exact(spark, points, metric, block_bytes, dealt):
    rows, queries = _queries(spark, 11)
    c = collection(spark, points, metric)
    found = S.search_many(c, queries, 5, 2, max_block_bytes=block_bytes, dealt=dealt)
    by_query = {}
    for row in found.collect():
        by_query.setdefault(row["query_id"], []).append((row["ID"], row["SCORE"]))
    for query_id, text, vector in rows:
        keywords = S.query_keywords(spark, text)
        expected = exact_search(points, text, vector, keywords, metric, 5, 2)
        got = dict(by_query[query_id])
        assert got == {i: pytest.approx(s, abs=2e-9) for i, s in expected}


def test_many_blocks_of_queries_do_not_pass_through_the_driver(spark, points, monkeypatch):
    rows, queries = _queries(spark, 11)
    c = collection(spark, points, "Cosine")
    wanted = S.search_many(c, queries, 5, dealt=False).collect()

    def refused(*_):
        raise AssertionError("queries on the driver")

    monkeypatch.setattr(S, "query_blocks", refused)
    found = S.search_many(c, queries, 5, max_block_bytes=100)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted))


@pytest.mark.parametrize("no", ["queries", "points"])
def test_nothing_to_deal(spark, points, no):
    _, queries = _queries(spark, 3)
    c = collection(spark, [] if no == "points" else points, "Cosine")
    asked = queries.limit(0) if no == "queries" else queries
    assert S.search_many(c, asked, 5, dealt=True).collect() == []


def test_the_placing_of_rows_changes_nothing(spark, points):
    rng = random.Random(4)
    shuffled = points[:]
    rng.shuffle(shuffled)
    vector = [1.0, 0.0, 0.0, 1.0]
    one = S.search(collection(spark, points, "Cosine", 1), "word3", 20, query_vector=vector)
    other = S.search(collection(spark, shuffled, "Cosine", 13), "word3", 20, query_vector=vector)
    assert [tuple(r) for r in one.collect()] == [tuple(r) for r in other.collect()]


def test_vector_topk_is_a_prefix(spark, points):
    c = collection(spark, points, "Euclid")
    vector = [0.0, 0.5, 0.5, 0.0]
    nine = S.vector_search(c, "x", 9, query_vector=vector).collect()
    ten = S.vector_search(c, "x", 10, query_vector=vector).collect()
    assert nine == ten[:9]


def test_default_limit_is_ten(spark, points):
    c = collection(spark, points, "Cosine")
    assert S.search(c, "word1", query_vector=[1.0, 0, 0, 0]).count() == 10


def test_keywords_match_whole_tokens_only(spark):
    rows = [("a", "password reset", [0.0, 1.0]), ("b", "passwords", [0.0, 1.0]),
            ("c", "my_password", [0.0, 1.0]), ("d", "épassword passwordé", [0.0, 1.0]),
            ("e", "PASSWORD", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id string, text string, embedding array<float>")
    expected = {"a": ["password", "reset"], "b": ["passwords"], "c": ["my", "password"], "d": ["épassword", "passwordé"],
                "e": ["password"]}
    assert {r["id"]: r["tokens"] for r in R.with_tokens(df).collect()} == expected


def test_fused_score_falls_with_worse_ranks(spark):
    ranked = spark.createDataFrame(
        [("q", True, leg, f"p{rank}", 1.0, rank) for leg in ("", "w") for rank in range(1, 30)],
        "query_key string, hybrid boolean, leg string, id string, score double, rank int",
    )
    scores = [r["score"] for r in R.fuse(ranked, "Cosine").orderBy(F.length("id"), "id").collect()]
    assert scores == sorted(scores, reverse=True) and len(set(scores)) == 29


def test_a_huge_group_of_copies_keeps_the_smallest_ids():
    n = 30_000
    ids = pa.array([f"{at:06d}" for at in np.random.default_rng(0).permutation(n)])
    vectors = pa.array([[1.0, 0.0]] * n, pa.list_(pa.float32()))
    tokens = pa.array([["hot"]] * n, pa.list_(pa.string()))
    block = R.QueryBlock(["q"], np.array([[1.0, 1.0]]), [["hot"]])
    ranker = R.LegRanker(block, "Cosine", R.LegLimits(10))
    for start in range(0, n, 7000):
        part = slice(start, start + 7000)
        ranker.add(ids[part], vectors[part], tokens[part])
    found = ranker.result().to_pylist()
    by_leg = {leg: sorted(r["id"] for r in found if r["leg"] == leg) for leg in ("", "hot")}
    assert by_leg[""] == [f"{at:06d}" for at in range(100)]
    assert by_leg["hot"] == [f"{at:06d}" for at in range(40)]


def test_what_cannot_be_searched(spark, points):
    c = collection(spark, points, "Cosine")
    with pytest.raises(ValueError):
        S.search(c, "", query_vector=[1.0] * 4)
    with pytest.raises(ValueError, match="4"):
        S.search(c, "word", query_vector=[1.0] * 3)
    with pytest.raises(ValueError, match="embedder"):
        S.search(c, "word")
    with pytest.raises(ValueError, match="negative"):
        S.search(c, "word", -1, query_vector=[1.0] * 4)
    twice = spark.createDataFrame(
        [(1, "a b", [1.0] * 4)] * 2, "query_id int, query string, query_vector array<float>"
    )
    with pytest.raises(ValueError, match="unique"):
        S.search_many(c, twice)


def test_an_empty_collection_gives_typed_columns(spark):
    c = collection(spark, [], "Cosine", 1)
    for query in ("word0", "what is the"):
        found = S.search(c, query, query_vector=[1.0] * 4)
        assert found.dtypes == [
            ("ID", "string"), ("TEXT", "string"), ("SCORE", "double"), ("QUERY", "string")
        ]
        assert found.collect() == []


def test_tiles_and_cuts_change_nothing(monkeypatch):
    points = make_points(600)
    ids, texts, vectors = (list(column) for column in zip(*points))
    rng = np.random.default_rng(5)
    block = R.QueryBlock([f"q{k}" for k in range(40)], rng.integers(-2, 3, (40, 4)) / 2, [WORDS[k % 12 : k % 12 + 3] for k in range(40)])
    found = []
    for tile, waiting, scores in ((512, 500_000, 4_000_000), (7, 10, 100)):
        monkeypatch.setattr(R, "TILE_QUERIES", tile)
        monkeypatch.setattr(R, "WAITING", waiting)
        monkeypatch.setattr(R, "SCORES_PER_BLOCK", scores)
        ranker = R.LegRanker(block, "Cosine", R.LegLimits(2))
        ranker.add(pa.array(ids), pa.array(vectors, pa.list_(pa.float32())), pa.array([text.split() for text in texts]))
        found.append(sorted(map(str, ranker.result().to_pylist())))
    assert found[0] == found[1]


def test_dealt_candidates_do_not_grow_with_the_partitions(spark, points, monkeypatch):
    _, queries = _queries(spark, 11)
    made, deal = [], S.candidates_dealt
    monkeypatch.setattr(S, "candidates_dealt", lambda *given: made.append(deal(*given)) or made[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        S.search_many(collection(spark, points, "Cosine"), queries, 5, dealt=True)
        vector_legs = made[0].filter("leg = ''")
        assert vector_legs.count() <= 4 * R.LegLimits(5).vector * 11  # once all 400 points a query
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_only_rows_of_repeated_ids_are_shuffled(spark):
    rows = [(f"p{at}", f"text {at}", [1.0, at / 9]) for at in range(50)]
    rows += [("p3", "a text", [0.5, 0.5]), ("p4", "text 4", [0.0, 1.0]), (None, "none", [1.0, 1.0]), ("", "none", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id string, text string, embedding array<float>")
    points = Collection.from_table("c", df, 2).points
    text = points._jdf.queryExecution().executedPlan().toString()
    assert "left anti" in text.lower() or "leftanti" in text.lower()
    found = {r["id"]: (r["text"], list(r["embedding"])) for r in points.collect()}
    assert points.count() == len(found) == 51
    assert found["p3"] == ("a text", [0.5, 0.5]) and found["p4"] == ("text 4", [0.0, 1.0]) and found["p5"][0] == "text 5"
    assert [v for t, v in found.values() if t == "none"] == [[0.0, 1.0]]


def test_points_are_written_once_however_many_blocks(spark, points):
    """More blocks of queries shuffle no more, and packed points rank as points do."""
    _, queries = _queries(spark, 40)
    c = collection(spark, points, "Cosine")
    asked = queries.select(
        F.col("query_id").cast("string").alias("query_key"),
        S.extract_keywords(F.col("query")).alias("keywords"),
        F.col("query_vector").cast("array<double>").alias("query_vector"),
    )
    wanted = sorted(map(tuple, R.rank_legs(R.candidates_broadcast(c.points, R.QueryBlock.from_arrow(asked.toArrow(), c.vector_size), "Cosine", R.LegLimits(5)), "Cosine", R.LegLimits(5)).collect()))
    for blocks, slices in ((1, 1), (7, 1), (5, 3)):
        made = R.candidates_dealt(c.points, asked, "Cosine", c.vector_size, R.LegLimits(5), blocks, slices)
        text = made._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in text and text.count("Exchange ") == 1 and "embedding" not in text.split("Exchange ")[1]
        assert sorted(map(tuple, R.rank_legs(made, "Cosine", R.LegLimits(5), slices).collect())) == wanted
    assert R.dealing(spark, 500_000, 250_000, R.LegLimits(3), 1)[0] == 1
