import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from farsight.functions.ids import point_id
from farsight.operators import search as S
from farsight.operators.embedding import HashEmbedder
from farsight.operators.health import collection_health
from farsight.operators.ingest import ingest
from farsight.session import fresh_folder
from farsight.sources import commits
from farsight.sources.store import KEPT_VERSIONS, CollectionStore
from farsight.streaming.ingest import ingest_stream

DIM = 16


@pytest.fixture
def store(spark):
    return CollectionStore(spark, fresh_folder(spark, "store"))


def rows(spark, *pairs):
    return spark.createDataFrame(
        [(i, t, n) for n, (i, t) in enumerate(pairs)], "id string, text string, n long"
    )


def load(store, source, name="docs", embedder=HashEmbedder(DIM), **settings):
    return ingest(store, name, source, embedder, seq_col="n", **settings)


def contents(store, name="docs"):
    return {r["id"]: r["text"] for r in store.points(name).collect()}


# ---- creating


def test_create_twice(store):
    assert store.create("c", 64, "Dot") == "created: c"
    assert store.create("c", 32, "Cosine") == "exists: c"
    entry = store.entry("C")
    assert (entry["name"], entry["vector_size"], entry["distance"]) == ("c", 64, "Dot")


def test_size_from_the_model(store):
    assert store.create("c", model_name="nomic-embed-text") == "created: c"
    assert store.entry("c")["vector_size"] == 768


@pytest.mark.parametrize(
    "settings, message",
    [
        ({"vector_size": 3, "distance": "L2_norm"}, "Cosine, Dot, Euclid, Manhattan"),
        ({"vector_size": 3, "distance": "cosine"}, "Cosine"),
        ({"model_name": "no-such-model"}, "explicit vector_size"),
        ({}, "no model_name"),
        ({"model_name": ""}, "no model_name"),
        ({"distance": "L2_norm"}, "not a distance metric"),
    ],
)
def test_create_refused(store, settings, message):
    with pytest.raises(ValueError, match=message):
        store.create("c", **settings)
    assert store.registry().count() == 0


@pytest.mark.parametrize("name", ["", "..", "a/b", ".hidden"])
def test_names_are_folders(store, name):
    with pytest.raises(ValueError, match="cannot name"):
        store.create(name, 4)


def test_names_differing_by_case_only(store):
    store.create("docs", 4)
    with pytest.raises(ValueError, match="case"):
        store.create("Docs", 4)


def test_create_many(spark, store):
    store.create("old", 4)
    requests = spark.createDataFrame(
        [
            (1, "old", 8, "Dot", ""),
            (2, "new", None, "Cosine", "nomic-embed-text"),
            (3, "new", 5, "Dot", ""),
            (4, "bad", 5, "L2_norm", ""),
            (5, "bad", None, "Dot", None),
            (6, "NEW", 5, "Dot", ""),
            (7, "../new", 5, "Dot", ""),
            (8, None, 5, "Dot", ""),
        ],
        "seq long, name string, vector_size int, distance string, model_name string",
    )
    status = {r["seq"]: r["status"] for r in store.create_many(requests).collect()}
    assert status == {
        1: "exists: old",
        2: "created: new",
        3: "exists: new",
        4: "error: invalid distance",
        5: "error: no vector_size and no model_name",
        6: "error: name differs only by case",
        7: "error: this cannot name a collection",
        8: "error: this cannot name a collection",
    }
    sizes = {r["name"]: r["vector_size"] for r in store.registry().collect()}
    assert sizes == {"old": 4, "new": 768}


# ---- listing


def test_listing_and_refresh(spark, store):
    assert store.list().collect() == []
    for name in ("bank_a", "bank_b", "products", "prod_x"):
        store.create(name, DIM)
    found = store.list("bank_*,products").collect()
    assert len(found) == 12
    assert {r["table_name"] for r in found} == {"BANK_A", "BANK_B", "PRODUCTS"}
    assert [r["column_name"] for r in sorted(found)[:4]] == ["ID", "TEXT", "SCORE", "QUERY"]
    load(store, rows(spark, ("1", "one")), "bank_a")
    assert store.refresh(" bank_? ") == ["bank_a", "bank_b"]
    assert spark.sql("SELECT id, text FROM bank_a").collect() == [("1", "one")]


@pytest.mark.parametrize(
    "wanted, names",
    [
        ("bank_*,products", {"BANK_A", "BANK_B", "PRODUCTS"}),
        (" prod_? ", {"PROD_X"}),
        (None, {"BANK_A", "BANK_B", "PRODUCTS", "PROD_X", "A.B", "AXB"}),
        ("", {"BANK_A", "BANK_B", "PRODUCTS", "PROD_X", "A.B", "AXB"}),
        ("PROD*", set()),
        ("prod", set()),
        (" , ,", set()),
        ("a.b", {"A.B"}),
        ("[ab]*", set()),
    ],
)
def test_collection_filter(spark, wanted, names):
    from farsight.operators.catalog import list_tables

    registered = spark.createDataFrame(
        [(n,) for n in ("bank_a", "bank_b", "products", "prod_x", "a.b", "axb")], "name string"
    )
    assert {r["table_name"] for r in list_tables(registered, wanted).collect()} == names


# ---- ingest


def test_ingest_cleans_and_counts(spark, store):
    store.create("docs", DIM)
    summary = load(
        store, rows(spark, ("a", "one"), (None, "x"), ("", "y"), ("b", None), ("a", "two"))
    )
    assert contents(store) == {"a": "two", "b": ""}
    assert sum(r["upserted_count"] for r in summary.collect()) == 3
    points = store.points("docs").select("id", "point_id", point_id(F.col("id"))).collect()
    assert all(r[1] == r[2] for r in points)


@pytest.mark.parametrize("count", [5, 250])
def test_ingest_counts(spark, store, count):
    store.create("docs", DIM)
    summary = load(store, rows(spark, *[(f"id-{n}", f"text {n}") for n in range(count)]))
    assert sum(r["upserted_count"] for r in summary.collect()) == count
    assert summary.dtypes == [("partition_id", "int"), ("upserted_count", "bigint")]


def test_upsert_overwrites(spark, store):
    store.create("docs", DIM)
    load(store, rows(spark, ("doc-1", "old"), ("doc-2", "kept")))
    load(store, rows(spark, ("doc-1", "new"), ("doc-3", "added")))
    load(store, rows(spark, ("doc-1", "newest")))
    expected = {"doc-1": "newest", "doc-2": "kept", "doc-3": "added"}
    assert contents(store) == expected
    before = sorted(store.points("docs").drop("seen").collect())
    store.compact("docs")
    assert len(store.entry("docs")["segments"]) == 1
    assert sorted(store.points("docs").drop("seen").collect()) == before


def test_ingest_twice_is_ingest_once(spark, store):
    store.create("docs", DIM)
    source = rows(spark, ("a", "one"), ("b", "two"))
    load(store, source)
    once = sorted(store.points("docs").collect())
    load(store, source)
    assert sorted(store.points("docs").collect()) == once


def test_text_is_stored_whole_but_embedded_short(spark, store):
    store.create("docs", DIM)
    text = "apple " * 1000 + "banana " * 500
    load(store, rows(spark, ("a", text)), max_chars=6000)
    point = store.points("docs").first()
    assert point["text"] == text and "banana" in point["tokens"]
    assert point["embedding"] == [float(x) for x in HashEmbedder(DIM).embed(["apple " * 1000])[0]]


def test_no_ids_at_all(spark, store):
    store.create("docs", DIM)
    with pytest.raises(ValueError, match="has an id"):
        load(store, rows(spark, (None, "x"), ("", "y")))
    assert store.points("docs").count() == 0


def test_an_empty_source_is_no_error(spark, store):
    store.create("docs", DIM)
    assert load(store, rows(spark, ("a", "b")).filter("false")).collect() == []
    assert store.points("docs").count() == 0


def test_vectors_of_the_wrong_size_stay_invisible(spark, store):
    store.create("docs", DIM)
    with pytest.raises(ValueError, match="16 elements"):
        load(store, rows(spark, ("a", "two"), ("b", "three")), embedder=HashEmbedder(8))
    assert contents(store) == {}
    load(store, rows(spark, ("a", "one")))
    with pytest.raises(ValueError, match="hash-8"):  # the first ingest has bound the model
        load(store, rows(spark, ("a", "two")), embedder=HashEmbedder(8))
    assert contents(store) == {"a": "one"}


def test_another_model_is_refused(spark, store):
    store.create("docs", DIM, model_name="hash-16")
    with pytest.raises(ValueError, match="hash-8"):
        load(store, rows(spark, ("a", "one")), embedder=HashEmbedder(8))
    load(store, rows(spark, ("a", "one")))
    with pytest.raises(ValueError, match="hash-8"):
        S.search(store.collection("docs"), "one", embedder=HashEmbedder(8))


def test_two_writers_do_not_lose_each_other(spark, store):
    store.create("docs", DIM)
    load(store, rows(spark, ("a", "one")))
    others = [CollectionStore(spark, store.root) for _ in range(2)]
    for turn in range(50):
        with ThreadPoolExecutor(2) as pool:
            jobs = [pool.submit(other.add_segment, "docs", f"{at}-{turn}") for at, other in enumerate(others)]
            assert sorted(job.result()["version"] for job in jobs) == [2 + 2 * turn, 3 + 2 * turn]
    segments = store.entry("docs")["segments"]
    assert sorted(segments[1:]) == sorted(f"{at}-{turn}" for at in (0, 1) for turn in range(50))
    assert len(store._versions("docs")) == KEPT_VERSIONS
    assert store.registry().first()["segments"] == segments


def test_a_version_is_made_once(spark, tmp_path):
    path = f"{tmp_path}/folder/00001.json"
    assert commits.create_once(spark, path, "first")
    assert not commits.create_once(spark, path, "second")
    assert commits.read(spark, path) == "first"
    assert [name for name, _ in commits.names(spark, f"{tmp_path}/folder")] == ["00001.json"]
    assert commits.names(spark, f"{tmp_path}/nowhere") == []


def test_models_do_not_mix_whoever_comes_first(spark, store):
    store.create("docs", DIM)
    store.add_segment("docs", "one", "some-model")
    with pytest.raises(ValueError, match="some-model"):
        store.add_segment("docs", "two", "another")


def test_ids_are_cast_to_text(spark, store):
    store.create("docs", DIM)
    source = spark.sql("SELECT CAST(7 AS DECIMAL(5,0)) AS id, 'seven' AS text")
    ingest(store, "docs", source, HashEmbedder(DIM))
    assert contents(store) == {"7": "seven"}


def test_unknown_collection(store):
    with pytest.raises(ValueError, match="no collection"):
        store.points("nowhere")


# ---- searching what is stored


@pytest.mark.parametrize("shard_digits", [1, 2])
def test_search_in_a_stored_collection(spark, store, shard_digits):
    store.create("kb", DIM, shard_digits=shard_digits)
    texts = {
        "auth-001": "How to reset your password",
        "auth-002": "Password reset mail does not arrive",
        "bill-001": "Where to find an invoice",
        "bill-002": "Change the billing address",
        "tech-001": "The app is slow",
    }
    load(store, rows(spark, *texts.items()), "kb")
    load(store, rows(spark, ("tech-001", "The app is very slow")), "kb")
    load(store, rows(spark, ("bill-003", "Paying by card")), "kb")
    hits = S.search(
        store.collection("KB"), "how do I reset my password", 3, embedder=HashEmbedder(DIM)
    ).collect()
    assert [h["ID"] for h in hits][:2] in (["auth-001", "auth-002"], ["auth-002", "auth-001"])
    assert all(h["TEXT"] == texts[h["ID"]] for h in hits if h["ID"] != "tech-001")
    assert hits[0]["SCORE"] >= hits[1]["SCORE"] >= hits[2]["SCORE"]
    slow = S.search(store.collection("kb"), "slow", 1, embedder=HashEmbedder(DIM)).first()
    assert slow["TEXT"] == "The app is very slow"
    queries = spark.createDataFrame([(1, "slow"), (2, "card")], "query_id int, query string")
    best = S.search_many(store.collection("kb"), queries, 1, embedder=HashEmbedder(DIM)).collect()
    assert {(r["query_id"], r["ID"], r["TEXT"]) for r in best} == {
        (1, "tech-001", "The app is very slow"),
        (2, "bill-003", "Paying by card"),
    }


def test_health(spark, store):
    store.create("docs", DIM)
    load(store, rows(spark, ("a", "one"), ("b", "two")))
    report = {r["check"]: r for r in collection_health(store, "docs", HashEmbedder(DIM)).collect()}
    assert report["verdict"]["status"] == "PASS"
    assert report["has points"]["detail"] == "2 points"
    report = {r["check"]: r for r in collection_health(store, "docs", HashEmbedder(8)).collect()}
    assert report["verdict"]["status"] == report["embedding round trip"]["status"] == "FAIL"


# ---- streaming


def test_stream(spark, store):
    store.create("docs", DIM)
    arriving, checkpoint = fresh_folder(spark, "arriving"), fresh_folder(spark, "checkpoint")

    def deliver(*pairs):
        rows(spark, *pairs).coalesce(1).write.mode("append").parquet(arriving)

    def run():
        source = spark.readStream.schema("id string, text string, n long").option(
            "maxFilesPerTrigger", 1
        ).parquet(arriving)
        stream = ingest_stream(
            store, "docs", source, HashEmbedder(DIM), checkpoint, compact_every=2, seq_col="n"
        )
        stream.awaitTermination()

    deliver(("a", "one"), ("b", "two"))
    deliver(("a", "three"))
    deliver(("c", "four"), ("a", "five"), ("a", "six"))
    run()
    assert contents(store) == {"a": "six", "b": "two", "c": "four"}
    deliver(("b", "seven"))
    run()  # goes on where it stopped
    assert contents(store) == {"a": "six", "b": "seven", "c": "four"}


def test_names_that_are_no_identifiers(spark, store):
    for name in ("my-docs", "v1.2"):
        store.create(name, DIM, distance="Euclid")
        load(store, rows(spark, ("a", "one word"), ("b", "two words")), name=name)
    assert {"my_docs", "v1_2"} <= set(store.refresh())
    function = store.register_search("my-docs", HashEmbedder(DIM))
    assert function == "search_my_docs"
    found = spark.sql(f"SELECT * FROM {function}('what is the')").collect()
    wanted = S.search(store.collection("my-docs"), "what is the", embedder=HashEmbedder(DIM)).collect()
    assert sorted(found) == sorted(wanted) and len(found) == 2
    with pytest.raises(Exception, match="needs a query text"):
        spark.sql(f"SELECT * FROM {function}('')").collect()


# ---- segments over segments


def versions_of_points(spark, store, turns, size, name="docs"):
    """Ingests overlapping runs of ids, each with a text of its own; returns what must be there in the end."""
    wanted = {}
    for turn in range(turns):
        pairs = [(f"d{at}", f"text {turn}") for at in range(turn * size // 2, turn * size // 2 + size)]
        load(store, rows(spark, *pairs), name)
        wanted |= dict(pairs)
    return wanted


def test_replaced_rows_are_left_out_where_they_lie(spark, store):
    store.create("docs", DIM)
    wanted = versions_of_points(spark, store, 5, 8)
    assert contents(store) == wanted
    entry = store.entry("docs")
    assert len(entry["segments"]) == 5 and len(entry["covers"]) == 10 and sum(entry["sizes"]) == 40
    text = store.points("docs")._jdf.queryExecution().executedPlan().toString()
    # Only bitmaps are exchanged: no point is, and no later id is joined.
    assert "SortMergeJoin" not in text and "LeftAnti" not in text and "bitmap" in text
    assert all("bucket" in each for each in re.findall(r"hashpartitioning\(([^)]*)\)", text))


def test_segments_that_came_in_together(spark, store):
    store.create("docs", DIM)
    load(store, rows(spark, ("a", "one"), ("b", "one")))
    looked = store.entry("docs")["segments"]
    load(store, rows(spark, ("a", "two")))
    # a third writer who has seen only the first segment
    segment, path = store.new_segment(store.entry("docs"))
    store.write_points(store.points("docs").withColumn("text", F.lit("three")), path)
    covers = store.note_replaced(store.entry("docs"), segment, looked)
    store.add_segment("docs", segment, None, 2, tuple(covers))
    assert contents(store) == {"a": "three", "b": "three"}


def test_folding_by_size(spark, store):
    store.create("docs", DIM)
    wanted, written = {}, 0
    for turn in range(9):
        pairs = [(f"d{at}", f"text {turn}") for at in range(turn * 2, turn * 2 + 3)]
        load(store, rows(spark, *pairs))
        wanted |= dict(pairs)
        before = set(store.entry("docs")["segments"])
        store.fold("docs", fan=3)
        entry = store.entry("docs")
        written += 3 + sum(size for s, size in zip(entry["segments"], entry["sizes"]) if s not in before)
    assert contents(store) == wanted
    assert len(entry["segments"]) <= 4 and sum(entry["sizes"]) >= len(wanted)
    assert written <= 3 * 9 * 3  # log of 9 to the base 3, and one more, not 9 / 2
    assert store.sweep("docs") == []  # too young to go
    assert store.sweep("docs", grace_seconds=0)
    left = {name.partition("-")[0] for name, _ in commits.names(spark, f"{store.root}/collections/docs")}
    assert left == set(entry["segments"]) and contents(store) == wanted


def test_folding_in_the_middle_keeps_what_lies_above(spark, store):
    store.create("docs", DIM)
    wanted = versions_of_points(spark, store, 5, 4)
    store._merge(store.entry("docs"), 1, 4)
    assert contents(store) == wanted and len(store.entry("docs")["segments"]) == 3
    text = store.points("docs")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in text
    store.compact("docs")
    assert contents(store) == wanted and len(store.entry("docs")["segments"]) == 1


# ---- facts kept beside the segments


def test_statistics_of_an_upserted_collection(store, spark):
    store.create("docs", DIM)
    load(store, rows(spark, *((str(k), "word " * (k % 7)) for k in range(600))))
    load(store, rows(spark, *((str(k), "other words") for k in range(500, 900))))
    load(store, rows(spark, ("0", "last"), ("899", "last"), ("new", "last")))
    found = store.statistics("docs").first()
    assert (found["points"], found["replaced"], found["noted"]) == (1003, 102, True)
    assert (found["no_id"], found["no_vector"], found["wrong_size"], found["longest"]) == (0, 0, 0, 30)
    assert abs(found["distinct_ids"] - 901) <= 0.065 * 901 and found["median_length"] == 11
    exact = collection_health(store, "docs", HashEmbedder(DIM)).select("place", "check", "status").collect()
    sketch = collection_health(store, "docs", HashEmbedder(DIM), exact=False)
    assert sketch.select("place", "check", "status").collect() == exact
    assert sketch.filter("check = 'has points'").first()["detail"] == "901 points"
    store.compact("docs")
    assert store.statistics("docs").select("points", "replaced").first() == (901, 0)
    assert abs(store.statistics("docs").first()["distinct_ids"] - 901) <= 0.065 * 901


def test_sketch_report_reads_no_points(store, spark):
    store.create("docs", DIM)
    load(store, rows(spark, ("a", "one"), ("b", "two")))
    load(store, rows(spark, ("b", "three")))
    files = store.statistics("docs").inputFiles()
    assert files and all("-facts/" in file or "-over-" in file for file in files)


def test_statistics_of_an_empty_collection_and_of_segments_without_facts(store, spark):
    store.create("docs", DIM)
    found = store.statistics("docs").first()
    assert (found["points"], found["replaced"], found["distinct_ids"], found["median_length"]) == (0, 0, 0, None)
    assert collection_health(store, "docs", HashEmbedder(DIM), exact=False).filter("check = 'verdict'").first()["status"] == "FAIL"
    load(store, rows(spark, ("a", "one"), ("b", "three")))
    entry = store.entry("docs")
    commits.delete(spark, store.facts_path(entry, entry["segments"][0]))
    assert store.statistics("docs").select("points", "distinct_ids", "longest").first() == (2, 2, 5)
