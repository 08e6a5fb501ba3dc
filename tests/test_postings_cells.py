"""Stored postings and k-means cells: the same results as looking at every point."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from farsight.functions.distance import METRICS
from farsight.functions.ids import point_id
from farsight.operators import ranking as R
from farsight.operators import search as S
from farsight.operators.embedding import HashEmbedder
from farsight.operators.ingest import ingest
from farsight.session import fresh_folder
from farsight.sources import postings as P
from farsight.sources.cells import build_cells
from farsight.sources.collection import Collection
from farsight.sources.store import CollectionStore

WORDS = [f"word{n}" for n in range(40)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def texts(n, seed):
    rng = random.Random(seed)
    return [f"common {' '.join(rng.sample(WORDS, 4))}" if at % 3 == 0 else " ".join(rng.sample(WORDS, 5)) for at in range(n)]


@pytest.fixture(scope="module")
def stored(spark):
    """Three segments: later ones replace some points of earlier ones, with other words."""
    store = CollectionStore(spark, fresh_folder(spark, "words"))
    store.create("docs", 16)
    for seed, (low, high) in enumerate([(0, 300), (100, 160), (150, 320)]):
        rows = [(f"d{at}", text) for at, text in zip(range(low, high), texts(high - low, seed))]
        df = spark.createDataFrame(rows, "id string, text string")
        ingest(store, "docs", df, HashEmbedder(16))
    scanned = store.collection("docs")
    assert store.build_postings("docs") == 3 and store.build_postings("docs") == 0
    return scanned, store.collection("docs")


def hits(df):
    return [tuple(row) for row in df.collect()]


@pytest.mark.parametrize("query", ["word1 common word7", "common", "word2 nowhere", "what is the"])
def test_search_by_postings_is_search(stored, query):
    scanned, indexed = stored
    assert not scanned.postings and len(indexed.postings) == 3
    embedder = HashEmbedder(16)
    assert hits(S.search(indexed, query, 20, embedder=embedder)) == hits(S.search(scanned, query, 20, embedder=embedder))


@pytest.mark.parametrize("named_bytes", [R.MAX_NAMED_BYTES, 0])
def test_many_queries_by_postings(spark, stored, named_bytes, monkeypatch):
    monkeypatch.setattr(R, "MAX_NAMED_BYTES", named_bytes)  # 0: nothing is broadcast
    scanned, indexed = stored
    queries = spark.createDataFrame([(n, f"{w} common {w}x") for n, w in enumerate(WORDS[:9])], "query_id long, query string")
    found = [
        sorted(map(str, S.ranked_legs_of_many(c, queries, R.LegLimits(5), HashEmbedder(16)).collect())) for c in stored
    ]
    assert found[0] == found[1] and len(found[0]) > 100


def test_only_the_buckets_of_the_words_are_read(spark, stored):
    _, indexed = stored
    for postings in indexed.postings:
        text = plan(P.points_with(postings, ["word1", "word7"]))
        (filters,) = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
        buckets = {r[0] for r in spark.sql("SELECT pmod(xxhash64(w), 64) FROM VALUES ('word1'), ('word7') AS t(w)").collect()}
        assert set(map(int, re.findall(r"\d+", filters.split("IN")[1]))) == buckets
        assert "In(token, [word1,word7])" in text


def test_many_words_are_looked_up_by_a_join_that_prunes(stored, monkeypatch):
    _, indexed = stored
    few = sorted(map(str, P.points_with(indexed.postings[0], ["word1", "word7"]).select("point_id").collect()))
    monkeypatch.setattr(P, "MAX_FILTERED_WORDS", 1)
    found = P.points_with(indexed.postings[0], ["word1", "word7"])
    assert "dynamicpruning" in plan(found)
    assert sorted(map(str, found.select("point_id").collect())) == few


def test_a_common_word_is_spread(spark, monkeypatch):
    monkeypatch.setattr(P, "ROW_IDS", 20)
    monkeypatch.setattr(P, "TASK_IDS", 300)
    points = spark.range(2000).select(
        F.sha1(F.col("id").cast("string").cast("binary")).alias("point_id"),
        F.array(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), "id"))).alias("tokens"),
    )
    folder = fresh_folder(spark, "hot")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with more data
    try:
        P.write_postings(points, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = P.read_postings(spark, folder).filter("token = 'hot'")
    rows = rows.select(F.size("point_ids").alias("n"), F.input_file_name().alias("file"))
    sizes = rows.agg(F.max("n"), F.sum("n"), F.count_distinct("file")).first()
    assert sizes[0] < 60 and sizes[1] == 667 and sizes[2] >= 3
    assert P.read_postings(spark, folder).agg(F.sum(F.size("point_ids"))).first()[0] == 2000


def test_an_ingest_after_indexing_is_still_found(spark, stored):
    store = CollectionStore(spark, fresh_folder(spark, "later"))
    store.create("docs", 16)
    for text in ("old words", "new words"):
        ingest(store, "docs", spark.createDataFrame([("a", text)], "id string, text string"), HashEmbedder(16))
        assert [row["TEXT"] for row in S.search(store.collection("docs"), text, embedder=HashEmbedder(16)).collect()] == [text]
        store.build_postings("docs")
    assert S.search(store.collection("docs"), "old", embedder=HashEmbedder(16)).first()["TEXT"] == "new words"


# ---- cells


def clustered(spark, n=1500, dim=8, seed=1, metric="Cosine"):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dim))
    rows = [(f"p{i}", "t", (centres[i % 30] + 0.05 * rng.normal(size=dim)).tolist()) for i in range(n)]
    rows += [(f"copy{i}", "t", centres[3].tolist()) for i in range(200)]
    rows += [("zero", "t", [0.0] * dim), ("none", "t", None), ("short", "t", [1.0]), ("nan", "t", [float("nan")] * dim)]
    df = spark.createDataFrame(rows, "id string, text string, embedding array<float>")
    return Collection.from_table("c", df.repartition(4), dim, distance=metric), centres


@pytest.mark.parametrize("metric", METRICS)
def test_cells_give_what_a_scan_gives(spark, metric):
    collection, centres = clustered(spark, metric=metric)
    index = build_cells(collection, cells=40)
    for query, limit, offset in [(centres[3], 10, 0), (centres[7] + 0.3, 25, 5), (np.zeros(8), 5, 0)]:
        found = index.topk(query.tolist(), limit, offset)
        assert hits(found.hits) == hits(S.nearest(collection, query.tolist(), limit, offset))
        assert 0 < found.cells_read <= found.cells
    if metric != "Dot":  # by Dot a longer vector elsewhere may beat a near one
        near = index.topk(centres[7].tolist(), 10)
        assert near.cells_read <= near.cells / 2

    sign, query = (1 if METRICS[metric] else -1), np.array([0.3, -1.0, 2.0, 0.0, 0.5, 0.5, -0.2, 1.0])
    bounds = dict(zip(index.numbers.tolist(), index.bounds(query)))
    whole = Collection("c", index.vectors, 8, distance=metric)
    scores = {row["id"]: row["score"] for row in S.nearest(whole, query.tolist(), 10_000).collect()}
    assert all(sign * scores[row["id"]] <= bounds[row["cell"]] for row in index.vectors.select("id", "cell").collect())

    if metric in ("Cosine", "Euclid"):
        recalls = []
        for query in centres[:3] + 0.1:
            exact = {row["id"] for row in S.nearest(collection, query.tolist(), 10).collect()}
            few = index.topk(query.tolist(), 10, probes=6)
            assert few.cells_read <= 6
            recalls.append(len(exact & {row["id"] for row in few.hits.collect()}) / 10)
        assert np.mean(recalls) >= 0.9


def test_no_points_no_hits(spark):
    empty = Collection("c", spark.createDataFrame([], "id string, text string, embedding array<float>"), 3)
    assert build_cells(empty).topk([1.0, 2.0, 3.0], 5).hits.count() == 0
    same = spark.createDataFrame([(f"a{n}", "t", [1.0, 1.0, 0.0]) for n in range(50)], "id string, text string, embedding array<float>")
    assert [row["id"] for row in build_cells(Collection("c", same, 3), cells=9).topk([1.0, 0.0, 0.0], 2).hits.collect()] == ["a0", "a1"]
    one = spark.createDataFrame([("a", "t", [1.0, 0.0, 0.0])], "id string, text string, embedding array<float>")
    assert [row["id"] for row in build_cells(Collection("c", one, 3)).topk([1.0, 0.0, 0.0], 5).hits.collect()] == ["a"]


def test_ids_are_shuffled_and_stored_small(spark):
    """Ids that are UUIDs take 16 bytes; others come back as they were."""
    points = spark.range(3000).select(
        F.when(F.col("id") == 5, "x").when(F.col("id") == 6, "A0000000-0000-0000-0000-000000000000").otherwise(
            point_id(F.col("id").cast("string"))
        ).alias("point_id"),
        F.array(F.lit("hot"), F.lit("cold")).alias("tokens"),
    )
    folder = fresh_folder(spark, "small")
    P.write_postings(points, folder)
    found = P.read_postings(spark, folder)
    for token in ("hot", "cold"):
        ids = found.filter(F.col("token") == token).select(F.explode("point_ids").alias("point_id"))
        assert ids.exceptAll(points.select("point_id")).isEmpty() and ids.count() == 3000
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    assert sizes.agg(F.sum("length")).first()[0] < 6000 * 30  # once 40 each


def test_a_rare_word_is_one_row(spark, monkeypatch):
    """However many points there are, only a common word's ids are cut into rows."""
    monkeypatch.setattr(P, "ROW_IDS", 20)
    monkeypatch.setattr(P, "TASK_IDS", 500)
    points = spark.range(1500).select(
        point_id(F.col("id").cast("string")).alias("point_id"),
        F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("id") % 150)).alias("tokens"),
    )
    folder = fresh_folder(spark, "rare")
    P.write_postings(points, folder)
    found = P.read_postings(spark, folder)
    rare = found.filter("token != 'hot'").agg(F.count("token"), F.min(F.size("point_ids")), F.max(F.size("point_ids"))).first()
    assert tuple(rare) == (150, 10, 10)
    hot = found.filter("token = 'hot'").select("prefix", F.explode("point_ids").alias("point_id"))
    assert hot.filter("NOT startswith(point_id, prefix)").isEmpty()
    assert hot.select("point_id").exceptAll(points.select("point_id")).isEmpty() and hot.count() == 1500
    longest = found.filter("token = 'hot'").select(F.size("point_ids").alias("n"), F.sort_array("point_ids") == F.col("point_ids"))
    assert longest.agg(F.max("n")).first()[0] < 60 and longest.select(F.every(longest[1])).first()[0]
    words = P.points_with(found, ["hot", "w7"]).collect()
    assert len(words) == 1500 and sum(sorted(row["tokens"]) == ["hot", "w7"] for row in words) == 10


def test_texts_of_different_ids_are_shuffled_once(spark, monkeypatch):
    def refused(*_, **__):
        raise AssertionError("texts shuffled by id")

    store = CollectionStore(spark, fresh_folder(spark, "once"))
    store.create("docs", 16)
    df = spark.createDataFrame([("a", "one"), ("b", "two")], "id string, text string")
    monkeypatch.setattr("farsight.operators.ingest.keep_last", refused)
    assert ingest(store, "docs", df, HashEmbedder(16)).agg(F.sum("upserted_count")).first()[0] == 2
    assert sorted(tuple(r) for r in store.points("docs").select("id", "text").collect()) == [("a", "one"), ("b", "two")]
