import statistics

import pytest
from pyspark.sql import functions as F

from farsight.functions.ids import point_id
from farsight.functions.text import text_for_embedding
from farsight.operators import balance as B
from farsight.operators.embedding import HashEmbedder
from farsight.operators.ingest import ingest
from farsight.plans import queries as Q
from farsight.session import fresh_folder
from farsight.sources.embedding_cache import EmbeddingCache
from farsight.sources.store import CollectionStore


@pytest.fixture(scope="module")
def documents(spark):
    """Documents, one of them of 20 MB, and one id that a third of all rows have."""
    given = Q.table(spark, "/root/testdata/sf0.001", "documents").select(
        F.col("doc_id").cast("string").alias("id"), "text", F.col("doc_id").alias("seq")
    )
    long = spark.range(1).select(
        F.lit("long").alias("id"), F.repeat(F.lit("many words "), 2_000_000).alias("text"), F.lit(1).alias("seq")
    )
    same = spark.range(100).select(
        F.lit("same").alias("id"), F.concat(F.lit("text "), "id").alias("text"), F.col("id").alias("seq")
    )
    return given.unionByName(long).unionByName(same)


def test_tasks_embed_equal_sums(spark):
    rows = Q.table(spark, "/root/testdata/sf0.01", "documents").select(
        point_id(F.col("doc_id").cast("string")).alias("point_id"),
        # One text as long as 20 MB, cut as the model sees it, and many short ones.
        text_for_embedding(
            F.when(F.col("doc_id") == 5, F.repeat(F.lit("many words "), 2_000_000)).otherwise(F.col("text")), 6000
        ).alias("text"),
    )
    rows = rows.withColumn("cost", B.text_cost(F.col("text")))
    dealt, tasks = B.deal_by_cost(rows, B.cell_costs(rows, "cost"))
    by_task = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.sum("cost").alias("cost"), F.count("*").alias("n"))
    found = by_task.collect()
    assert len(found) == tasks and sum(row["n"] for row in found) == rows.count()
    costs = [row["cost"] for row in found]
    assert max(costs) < 2 * statistics.median(costs)


def test_parts_are_cut_at_equal_sums(spark):
    costs = spark.createDataFrame([(f"{n:04x}", 1000 if n == 3 else 10) for n in range(200)], "cell string, cost bigint")
    parts = {row["cell"]: row["part"] for row in B.cut_cells(costs, 4).collect()}
    assert [parts[cell] for cell in sorted(parts)] == sorted(parts.values()) and len(parts) == 200
    sums = [sum(1000 if cell == "0003" else 10 for cell in parts if parts[cell] == part) for part in range(4)]
    share = (199 * 10 + 1000) / 4
    assert all(total <= share + 1000 for total in sums)
    # No part but that of the one dear cell is above its share and one more cell.
    assert sorted(sums)[-2] <= share + 10


@pytest.mark.parametrize("cached", [False, True])
def test_the_points_are_the_same(spark, documents, cached):
    store = CollectionStore(spark, fresh_folder(spark, "balance"))
    cache = EmbeddingCache(spark, fresh_folder(spark, "cache")) if cached else None
    found = {}
    for name, by_cost in [("rows", False), ("cost", True)]:
        store.create(name, 16)
        ingest(store, name, documents, HashEmbedder(16), seq_col="seq", by_cost=by_cost, cache=cache)
        points = store.points(name).select("id", F.sha2("text", 256).alias("text"), "embedding", "tokens")
        found[name] = sorted(map(str, points.collect()))
    assert found["rows"] == found["cost"] and len(found["cost"]) == 202


def test_nothing_to_deal(spark, documents):
    store = CollectionStore(spark, fresh_folder(spark, "balance"))
    store.create("none", 16)
    ingest(store, "none", documents.limit(0), HashEmbedder(16), seq_col="seq", by_cost=True)
    assert store.points("none").count() == 0
