"""What the plans must and must not contain."""

import dataclasses
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from farsight.operators import ranking as R
from farsight.operators import search as S
from farsight.operators.embedding import HashEmbedder
from farsight.operators.ingest import ingest
from farsight.operators.upsert import keep_last
from farsight.plans import queries as Q
from farsight.session import fresh_folder
from farsight.sources.store import CollectionStore

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    store = CollectionStore(spark, fresh_folder(spark, "plans"))
    store.create("docs", 16)
    documents = Q.table(spark, FOLDER, "documents")
    ingest(store, "docs", documents, HashEmbedder(16), id_col="doc_id", seq_col="doc_id")
    return store.collection("docs")


def test_legs_are_cut_before_each_shuffle(spark, stored):
    block = R.QueryBlock(["q"], np.ones((1, 16)), [["word"]])
    limits = R.LegLimits(10)
    candidates = R.candidates_broadcast(stored.points, block, "Cosine", limits)
    text = plan(R.rank_legs(candidates, "Cosine", limits))
    assert len(re.findall(r"WindowGroupLimit .*100, Partial", text)) == 2
    assert len(re.findall(r"WindowGroupLimit .*100, Final", text)) == 2


def test_ranking_reads_no_text_and_scans_once(spark, stored):
    block = R.QueryBlock(["q"], np.ones((1, 16)), [["word"]])
    candidates = R.candidates_broadcast(stored.points, block, "Cosine", R.LegLimits(10))
    scans = re.findall(r"ReadSchema: struct<([^>]*>[^>]*)>", plan(candidates))
    assert plan(candidates).count("FileScan") == 1
    assert "text" not in scans[0] and "embedding" in scans[0] and "tokens" in scans[0]


def test_vector_topk_keeps_k_rows_per_task_and_prunes_columns(spark, stored):
    text = plan(S.nearest(stored, [1.0] * 16, 5, 2))
    assert "TakeOrderedAndProject" in text and "Window" not in text
    assert "ReadSchema: struct<id:string,embedding:array<float>>" in text


def test_texts_come_from_the_shards_of_the_hits(spark, stored):
    text = plan(S.search(stored, "the word", 5, query_vector=[1.0] * 16))
    assert "dynamicpruning" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("query", ["the word", "what is the"])
def test_the_last_sort_stays_in_the_final_plan(spark, stored, query):
    found = S.search(stored, query, 5, 2, query_vector=[1.0] * 16)
    found.collect()
    final = plan(found).split("Initial Plan")[0]
    assert "Final Plan" in final
    # Above the join that brings the texts there is a sort, and no limit that could take it along.
    above = final[: re.search(r"BroadcastHashJoin", final).start()]
    assert "row_number" in above and re.search(r"Sort \[", above) and "TakeOrdered" not in above and "Limit" not in above


def test_each_point_is_scored_once(spark, stored):
    assert plan(S.nearest(stored, [1.0] * 16, 5)).count("ArrowEvalPython") == 1


def test_each_layer_is_pruned(spark, stored):
    layered = dataclasses.replace(stored, layers=stored.layers * 3)
    found = S.search(layered, "the word", 5, query_vector=[1.0] * 16)
    assert plan(found).count("dynamicpruning") >= 3
    assert found.collect() == S.search(stored, "the word", 5, query_vector=[1.0] * 16).collect()
    # The ranking is done once, not once per layer.
    assert plan(found).count("ReusedExchange") >= 2


def test_keep_last_combines_before_the_shuffle(spark):
    rows = spark.range(10).select(F.lit("k").alias("id"), F.col("id").alias("seq"), F.lit("t").alias("t"))
    text = plan(keep_last(rows.repartition(3), "id"))
    assert text.count("partial_max") == 1 and text.index("partial_max") > text.index("hashpartitioning")


def test_word_counts_combine_before_the_shuffle(spark):
    text = plan(Q.text_index_postings(spark, FOLDER))
    assert "partial_count" in text
    assert "ReadSchema: struct<text:string>" in text


def test_dealt_queries_are_not_broadcast(spark, stored):
    queries = spark.range(5).select(
        F.col("id").cast("string").alias("query_key"),
        F.array(F.lit("word")).alias("keywords"),
        F.array_repeat(F.lit(1.0), 16).alias("query_vector"),
    )
    text = plan(R.candidates_dealt(stored.points, queries, "Cosine", 16, R.LegLimits(10), blocks=3))
    assert "Broadcast" not in text
    # Points and queries go through one exchange, and the points' texts are not read.
    assert text.count("Exchange ") == 1
    assert not re.search(r"ReadSchema: \S*text:", text)
