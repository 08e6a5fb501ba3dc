import pytest

from farsight.functions.sql import register_functions, register_search_function
from farsight.operators import search as S
from farsight.operators.embedding import HashEmbedder
from farsight.operators.ingest import ingest
from farsight.plans import queries as Q
from farsight.session import fresh_folder
from farsight.sources.store import CollectionStore
from tests.test_functions import KEYWORD_CASES

FOLDER = "/root/testdata/sf0.001"
QUERY = "The words of a query, and onesen erblest"


@pytest.fixture(scope="module")
def store(spark):
    store = CollectionStore(spark, fresh_folder(spark, "sql"))
    store.create("kb", 16)
    documents = Q.table(spark, FOLDER, "documents")
    ingest(store, "kb", documents, HashEmbedder(16), id_col="doc_id", seq_col="doc_id")
    store.refresh()
    return store


@pytest.mark.parametrize("embedder", [None, HashEmbedder(16)])
@pytest.mark.parametrize("query", [QUERY, "what is the"])
def test_the_function_is_the_search(spark, store, embedder, query):
    register_search_function(spark, "search_kb", "kb", 16, embedder)
    found = spark.sql(f"SELECT * FROM search_kb('{query}', 15) ORDER BY SCORE DESC, ID")
    wanted = S.search(store.collection("kb"), query, 15, embedder=HashEmbedder(16))
    assert found.collect() == wanted.collect()


def test_its_result_is_a_table(spark, store):
    register_search_function(spark, "search_kb", "kb", 16)
    spark.read.parquet(f"{FOLDER}/documents.parquet").createOrReplaceTempView("documents_sql")
    rows = spark.sql(
        f"""
        SELECT d.lang, count(*) AS n, max(h.SCORE) AS best
        FROM search_kb('{QUERY}', 30) h JOIN documents_sql d ON h.ID = CAST(d.doc_id AS STRING)
        WHERE h.SCORE > 0.01 GROUP BY d.lang ORDER BY best DESC LIMIT 2
        """
    ).collect()
    assert 1 <= len(rows) <= 2 and rows[0]["best"] >= rows[-1]["best"]


@pytest.mark.parametrize("query", KEYWORD_CASES)
def test_keywords_in_sql(spark, query):
    register_functions(spark)
    found = spark.sql("SELECT farsight_query_keywords(:q) AS k", args={"q": query}).first()["k"]
    assert found == KEYWORD_CASES[query]


def test_sql_counts_as_many_keywords_as_asked(spark):
    register_functions(spark)
    query = " ".join(f"keyword{n}" for n in range(30))
    for most, given in ((3, ", 3"), (None, ", NULL"), (12, "")):
        found = spark.sql(f"SELECT farsight_query_keywords('{query}'{given}) AS k").first()["k"]
        assert found == S.query_keywords(spark, query, most=most)


def test_a_refresh_gives_every_collection_its_relation(spark, store):
    store.create("other_model", 16, model_name="some-model")
    views = store.refresh("kb, other*", searchable=True, embedder=HashEmbedder(16))
    assert views == ["kb", "other_model"]
    found = spark.sql(f"SELECT * FROM search_kb('{QUERY}', 15) ORDER BY SCORE DESC, ID")
    assert found.columns == ["ID", "TEXT", "SCORE", "QUERY"]
    assert found.collect() == S.search(store.collection("kb"), QUERY, 15, embedder=HashEmbedder(16)).collect()
    # Vectors of a model that is not at hand cannot be made.
    assert not spark.catalog.functionExists("search_other_model")


def test_a_column_of_queries_from_sql(spark, store):
    Q.items(spark, FOLDER).createOrReplaceTempView("asked")
    S.register_search_many(store.collection("kb"), "asked", "answers", limit=4, embedder=HashEmbedder(16))
    found = spark.sql("SELECT * FROM answers").collect()
    wanted = S.search_many(store.collection("kb"), spark.table("asked"), 4, embedder=HashEmbedder(16))
    assert sorted(map(str, found)) == sorted(map(str, wanted.collect()))
    best = spark.sql("SELECT max(SCORE) AS best FROM answers WHERE query_id = 0 AND ID IS NOT NULL").first()
    assert best["best"] == max(row["SCORE"] for row in found if row["query_id"] == 0)
