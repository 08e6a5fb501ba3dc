"""The registered queries: every operator over the given tables, whole.

Each takes (spark, folder of the tables) and returns a DataFrame.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.distance import METRICS
from ..functions.hashing import hash_embed_words
from ..functions.ids import point_id
from ..functions.sql import register_search_function
from ..functions.text import (
    MAX_CHARS,
    MAX_KEYWORDS,
    extract_keywords,
    index_tokens,
    text_for_embedding,
    tokens_of_words,
    words,
)
from ..operators import search as S
from ..operators.catalog import list_tables
from ..operators.cleaning import clean, id_and_text
from ..operators.creation import plan_creation
from ..operators.embedding import HashEmbedder, embed_column
from ..operators.health import collection_health, health_report
from ..operators.ingest import ingest
from ..operators.joins import join_hits
from ..operators.ranking import LegLimits, fuse
from ..operators.upsert import keep_last, upsert
from ..session import fresh_folder
from ..sources.cells import build_cells
from ..sources.collection import Collection
from ..sources.statistics import ERRORS, HLL_ERROR
from ..sources.store import CollectionStore
from ..sources.tables import read_spread
from ..streaming.ingest import ingest_stream

DIM = 64  # elements of the vectors in `embeddings`, and of the hashed ones
QUERY_POINT = 7  # the vector that serves as a query by example
QUERY_ITEM = 0  # the benchmark text that serves as a query
NO_KEYWORDS = "what is the"
MAX_KEY_BYTES = 16 * 1024 * 1024  # of keys that are broadcast to filter another table
FILE_BYTES = 128 * 1024 * 1024  # of text in one arriving file, about
FILTER = "src1*_en, src?_fr ,, src5_de"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, spread over all cores: each text costs far more than reading it."""
    return read_spread(spark, f"{folder}/documents.parquet")


def having(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """The rows whose key, a long, other rows have too. Keys are counted and broadcast if they are few: texts then stay in place."""
    keys = others.select(key).distinct()
    few = 16 * others.select(key).count() <= MAX_KEY_BYTES
    return rows.join(F.broadcast(keys) if few else keys, key, "left_semi")


# ---- collections over the given tables


def example_collection(spark: SparkSession, folder: str, distance: str = "Cosine") -> Collection:
    """All given vectors, with the documents' texts where there are any."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return Collection.from_table(
        "documents", vectors.join(documents, "id", "left"), DIM, distance=distance
    )


def shown(hits: DataFrame, decimals: int = 6, score: str = "SCORE") -> DataFrame:
    """Scores rounded for comparison with other engines, after everything that depends on them."""
    return hits.withColumn(score, F.round(score, decimals))


def hashed_collection(
    spark: SparkSession, folder: str, distance: str, normalise: bool = True
) -> Collection:
    """All documents with hashed vectors."""
    worded = texts(spark, folder).select(
        F.col("doc_id").alias("id"), "text", words(F.col("text")).alias("words")
    )
    documents = worded.select(
        "id",
        "text",
        hash_embed_words(F.col("words"), DIM, normalise).alias("embedding"),
        tokens_of_words(F.col("words")).alias("tokens"),
    )
    return Collection.from_table("hashed", documents, DIM, distance=distance)


def example_vector(spark: SparkSession, folder: str) -> list[float]:
    vectors = table(spark, folder, "embeddings")
    return vectors.filter(F.col("vec_id") == QUERY_POINT).first()["embedding"]


def example_query(spark: SparkSession, folder: str) -> str:
    items = table(spark, folder, "benchmark")
    return items.filter(F.col("item_id") == QUERY_ITEM).first()["text"]


# ---- vector search


def vector_topk(distance: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        hits = S.vector_search(
            example_collection(spark, folder, distance),
            NO_KEYWORDS,
            query_vector=example_vector(spark, folder),
        )
        return shown(hits)

    return run


def vector_topk_dot(spark: SparkSession, folder: str) -> DataFrame:
    """Over word counts, which unlike the given vectors are not of unit length."""
    query = example_query(spark, folder)
    vector = (
        table(spark, folder, "benchmark")
        .filter(F.col("item_id") == QUERY_ITEM)
        .select(hash_embed_words(words(F.col("text")), DIM, normalise=False))
        .first()[0]
    )
    collection = hashed_collection(spark, folder, "Dot", normalise=False)
    return shown(S.vector_search(collection, query, query_vector=vector))


def vector_topk_offset(spark: SparkSession, folder: str) -> DataFrame:
    hits = S.vector_search(
        example_collection(spark, folder),
        NO_KEYWORDS,
        limit=15,
        offset=20,
        query_vector=example_vector(spark, folder),
    )
    return shown(hits)


def score_filter(spark: SparkSession, folder: str) -> DataFrame:
    hits = S.vector_search(
        example_collection(spark, folder),
        NO_KEYWORDS,
        limit=50,
        query_vector=example_vector(spark, folder),
    )
    return shown(hits.filter(F.col("SCORE") > 0.2).select("ID", "SCORE"))


def result_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as hits, some of them without an id, text or score."""
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    hits = documents.join(labels, "doc_id", "left").select(
        S.result_id(
            F.when(F.col("lang") != "fr", F.col("doc_id").cast("string")),
            F.when(F.col("source") != "src3", point_id(F.col("doc_id").cast("string"))),
        ).alias("id"),
        F.when(F.col("lang") != "de", F.col("text")).alias("text"),
        F.col("quality").cast("double").alias("score"),
        F.col("source").alias("query"),
    )
    return S.result_rows(hits, F.lit("documents").alias("collection"))


# ---- hybrid search


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def _item_legs(spark: SparkSession, folder: str) -> DataFrame:
    """The legs of all benchmark texts over all documents."""
    collection = hashed_collection(spark, folder, "Cosine")
    return S.ranked_legs_of_many(collection, items(spark, folder), LegLimits(10), HashEmbedder(DIM))


def keyword_leg(spark: SparkSession, folder: str) -> DataFrame:
    ranked = _item_legs(spark, folder)
    return shown(
        ranked.select("query_key", "leg", "id", "score", F.col("rank").cast("bigint").alias("rank")), 6, "score"
    )


def upserted_store(spark: SparkSession, folder: str, indexed: bool = True) -> CollectionStore:
    """All documents, stored: those with a label came in with a text of another document's kind first. Words are indexed."""
    documents = table(spark, folder, "documents").select("doc_id", "text", F.lit(1).alias("seq"))
    labelled = table(spark, folder, "labels").select("doc_id").distinct()
    older = documents.join(labelled, "doc_id", "left_semi").select(
        "doc_id", F.reverse("text").alias("text"), F.lit(0).alias("seq")
    )
    rest = documents.join(labelled, "doc_id", "left_anti")
    store = _store(spark)
    store.create("documents", DIM)
    for rows in (older.unionAll(rest), documents.join(labelled, "doc_id", "left_semi")):
        ingest(
            store, "documents", rows, HashEmbedder(DIM), id_col="doc_id", seq_col="seq", max_chars=None, some_ids=False
        )
    if indexed:
        store.build_postings("documents")
    return store


def upserted_collection(spark: SparkSession, folder: str) -> Collection:
    return upserted_store(spark, folder).collection("documents")


def keyword_leg_postings(spark: SparkSession, folder: str) -> DataFrame:
    """As `keyword_leg`, but over stored documents, some of them overwritten, by the stored index of words."""
    collection = upserted_collection(spark, folder)
    ranked = S.ranked_legs_of_many(collection, items(spark, folder), LegLimits(10), HashEmbedder(DIM))
    return shown(
        ranked.select("query_key", "leg", "id", "score", F.col("rank").cast("bigint").alias("rank")), 6, "score"
    )


def search_after_upserts(spark: SparkSession, folder: str) -> DataFrame:
    """One query over stored documents, some of them overwritten."""
    query = example_query(spark, folder)
    hits = S.search(upserted_collection(spark, folder), query, embedder=HashEmbedder(DIM))
    return shown(hits, 9)


def vector_topk_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest vectors by each metric, found in k-means cells."""
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.lit("").alias("text"), "embedding")
    vector, found = example_vector(spark, folder), []
    for metric in METRICS:
        index = build_cells(Collection.from_table("vectors", vectors, DIM, distance=metric))
        found.append(shown(index.topk(vector, 10).hits.withColumn("metric", F.lit(metric)), 6, "score"))
    return reduce(DataFrame.unionAll, found)


def rrf_fusion(spark: SparkSession, folder: str) -> DataFrame:
    fused = fuse(_item_legs(spark, folder), "Cosine")
    return shown(fused.select("query_key", "id", "score"), 9, "score")


def _hybrid(spark: SparkSession, folder: str, limit: int) -> DataFrame:
    return S.search(
        hashed_collection(spark, folder, "Cosine"),
        example_query(spark, folder),
        limit=limit,
        embedder=HashEmbedder(DIM),
    )


def rrf_fusion_deep(spark: SparkSession, folder: str) -> DataFrame:
    """So many ranks that neighbours differ in the tenth decimal only."""
    hits = _hybrid(spark, folder, 5000)
    return shown(hits.select(F.col("ID").alias("id"), F.col("SCORE").alias("score")), 9, "score")


def hybrid_search(spark: SparkSession, folder: str) -> DataFrame:
    """One query over all documents."""
    return shown(_hybrid(spark, folder, 10), 9)


def vector_topk_small_norm(spark: SparkSession, folder: str) -> DataFrame:
    """The given vectors a hundred thousand times smaller: scores differ far behind the point."""
    small = F.transform("embedding", lambda x: (x * F.lit(1e-5).cast("float")).cast("float"))
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.lit("").alias("text"), small.alias("embedding")
    )
    query = vectors.filter(F.col("id") == QUERY_POINT).first()["embedding"]
    hits = [
        S.vector_search(
            Collection.from_table("small", vectors, DIM, distance=metric), NO_KEYWORDS, 50, query_vector=query
        ).select(F.lit(metric).alias("metric"), "ID")
        for metric in ("Dot", "Euclid")
    ]
    return reduce(DataFrame.unionAll, hits)


def search_dirty_points(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of which some have no id, some another's, some no vector and some one that is not finite."""
    vectors = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "doc_id")
    documents = having(table(spark, folder, "documents"), vectors, "doc_id").join(vectors, "doc_id")
    last = F.col("doc_id") % 10
    given = F.when(last == 4, F.col("doc_id") - 1).when(last != 3, F.col("doc_id"))
    damage = F.col("doc_id") % 7
    nan = F.transform("embedding", lambda x: F.lit(float("nan")).cast("float"))
    vector = F.when(damage == 2, nan).when(damage != 1, F.col("embedding"))
    points = documents.select(given.alias("id"), "text", vector.alias("embedding"))
    collection = Collection.from_table("dirty", points, DIM)
    hits = S.vector_search(collection, NO_KEYWORDS, 40, query_vector=example_vector(spark, folder))
    return shown(hits.select("ID", "SCORE"))


def hybrid_fallback(spark: SparkSession, folder: str) -> DataFrame:
    hits = S.search(
        example_collection(spark, folder),
        NO_KEYWORDS,
        limit=12,
        query_vector=example_vector(spark, folder),
    )
    return shown(hits)


def batch_hybrid(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark text searched for in all documents."""
    collection = hashed_collection(spark, folder, "Cosine")
    return shown(S.search_many(collection, items(spark, folder), embedder=HashEmbedder(DIM)), 9)


def sql_search_many(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark text searched for in all documents, from SQL."""
    items(spark, folder).createOrReplaceTempView("benchmark_queries")
    collection = hashed_collection(spark, folder, "Cosine")
    S.register_search_many(collection, "benchmark_queries", "hits_of_benchmark", embedder=HashEmbedder(DIM))
    return spark.sql("SELECT query_id, ID, TEXT, round(SCORE, 9) AS SCORE, QUERY FROM hits_of_benchmark")


def batch_hybrid_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation turn searched for in all documents; the queries do not pass through the driver."""
    turns = (
        table(spark, folder, "conversations")
        .groupBy(F.concat("conv_id", F.lit("-"), "turn").alias("query_id"))
        .agg(F.max("text").alias("query"))
        .filter("query_id IS NOT NULL")
    )
    collection = hashed_collection(spark, folder, "Cosine")
    found = S.search_many(collection, turns, 3, embedder=HashEmbedder(DIM), dealt=True)
    return shown(found.select("query_id", "ID", "SCORE"), 9)


def sql_table_function(spark: SparkSession, folder: str) -> DataFrame:
    """Hybrid search from SQL, joined with a table there."""
    hashed_collection(spark, folder, "Cosine").points.createOrReplaceTempView("hashed_documents")
    table(spark, folder, "documents").createOrReplaceTempView("all_documents")
    register_search_function(spark, "search_documents", "hashed_documents", DIM)
    query = example_query(spark, folder).replace("\\", "\\\\").replace("'", "\\'")
    return spark.sql(
        f"""
        SELECT h.ID, d.lang, d.source, round(h.SCORE, 9) AS SCORE, h.QUERY
        FROM search_documents('{query}', 20) h JOIN all_documents d
          ON h.ID = CAST(d.doc_id AS STRING)
        WHERE h.SCORE > 0.01
        ORDER BY h.SCORE DESC, h.ID
        """
    )


def join_metadata(spark: SparkSession, folder: str) -> DataFrame:
    hits = shown(_hybrid(spark, folder, 25), 9)
    metadata = table(spark, folder, "documents").select("doc_id", "lang", "source")
    joined = join_hits(hits, metadata, "doc_id", n_hits=25)
    return joined.select("ID", "lang", "source", "SCORE").orderBy(F.desc("SCORE"), "ID")


def join_fact(spark: SparkSession, folder: str) -> DataFrame:
    """One hit to many events."""
    hits = shown(_hybrid(spark, folder, 25), 9)
    joined = join_hits(hits, table(spark, folder, "events"), "user_id", n_hits=25)
    return joined.select("event_id", "user_id", "event_type", "ID", "SCORE").orderBy(
        F.desc("SCORE"), "event_id"
    )


# ---- text and embedding


def extract_keywords_query(spark: SparkSession, folder: str) -> DataFrame:
    return keywords_of_all(spark, folder, MAX_KEYWORDS)


def extract_keywords_uncapped(spark: SparkSession, folder: str) -> DataFrame:
    return keywords_of_all(spark, folder, None)


def keywords_of_all(spark: SparkSession, folder: str, most: int | None) -> DataFrame:
    """All benchmark texts and all turns."""
    texts_ = table(spark, folder, "benchmark").select(
        F.concat(F.lit("item-"), F.col("item_id")).alias("id"), "text"
    )
    turns = table(spark, folder, "conversations").select(
        F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("id"), "text"
    )
    return texts_.unionByName(turns).select(
        "id", F.array_join(extract_keywords(F.col("text"), most=most), " ").alias("keywords")
    )


def text_index_postings(spark: SparkSession, folder: str) -> DataFrame:
    documents = texts(spark, folder)
    return (
        documents.select(F.explode(index_tokens(F.col("text"))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("documents"))
    )


def _non_zero(df: DataFrame, key: str) -> DataFrame:
    """A vector column as (key, bucket, value) rows."""
    return (
        df.select(key, F.posexplode_outer("embedding").alias("bucket", "value"))
        .filter(F.col("value") != 0)
        .select(
            key,
            F.col("bucket").cast("bigint").alias("bucket"),
            F.round(F.col("value").cast("double"), 6).alias("value"),
        )
    )


def hash_embed(spark: SparkSession, folder: str) -> DataFrame:
    documents = texts(spark, folder)
    vectors = documents.select(
        "doc_id", hash_embed_words(words(F.col("text")), DIM).alias("embedding")
    )
    return _non_zero(vectors, "doc_id")


def batch_embed(spark: SparkSession, folder: str, max_chars: int | None = MAX_CHARS) -> DataFrame:
    """The model sees the truncated text, a hundred rows per call."""
    documents = texts(spark, folder).select(
        "doc_id", text_for_embedding(F.col("text"), max_chars).alias("model_text")
    )
    return _non_zero(embed_column(documents, "model_text", HashEmbedder(DIM)), "doc_id")


def batch_embed_whole_text(spark: SparkSession, folder: str) -> DataFrame:
    """The model sees the whole text."""
    return batch_embed(spark, folder, None)


def point_id_uuid5(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey", "c_name", point_id(F.col("c_name")).alias("point_id")
    )


# ---- ingest


def ingest_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, some of which have a NULL or empty id or no text."""
    damaged_id = (
        F.when(F.col("source") == "src3", F.lit(None))
        .when(F.col("lang") == "de", F.lit(""))
        .otherwise(F.col("doc_id").cast("string"))
    )
    damaged_text = F.when(F.col("lang") != "es", F.col("text"))
    rows = id_and_text(
        table(spark, folder, "documents"), damaged_id, damaged_text, F.col("doc_id")
    )
    return clean(rows).select("original_id", "text")


def ingest_truncate(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id",
        F.length("text").cast("bigint").alias("stored_chars"),
        text_for_embedding(F.col("text")).alias("model_text"),
    )


def ingest_concat_text(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(
        "p_name", F.lit(" by "), "p_brand", F.lit(", "), "p_type", F.lit(", size "),
        F.col("p_size").cast("string"),
    )
    rows = id_and_text(
        table(spark, folder, "part"), F.col("p_partkey"), text, F.col("p_partkey")
    )
    return clean(rows).select("original_id", "text")


def dimension_check(spark: SparkSession, folder: str) -> DataFrame:
    """The given vectors, cut short by as many elements as their label says."""
    documents = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.lit("").alias("text"),
        F.slice("embedding", 1, F.lit(DIM) - F.col("label")).alias("embedding"),
    )
    report = Collection.from_table("cut", documents, DIM).size_report()
    return report.select(*[F.col(c).cast("bigint").alias(c) for c in report.columns])


def _store(spark: SparkSession) -> CollectionStore:
    return CollectionStore(spark, fresh_folder(spark, "collections"))


def ingest_documents(spark: SparkSession, folder: str, by_cost: bool = False) -> DataFrame:
    """All documents written to a new collection and read back."""
    store = _store(spark)
    store.create("documents", DIM)
    ingest(
        store,
        "documents",
        table(spark, folder, "documents"),
        HashEmbedder(DIM),
        id_col="doc_id",
        seq_col="doc_id",
        by_cost=by_cost,
    )
    return store.points("documents").select(
        "point_id", "id", "text", F.size("tokens").cast("bigint").alias("n_tokens")
    )


def ingest_by_cost(spark: SparkSession, folder: str) -> DataFrame:
    """The same, tasks being dealt equal sums of bytes to embed."""
    return ingest_documents(spark, folder, by_cost=True)


def ingest_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of one language and length share an id, so some are overwritten."""
    store = _store(spark)
    store.create("documents", DIM)
    return ingest(
        store,
        "documents",
        table(spark, folder, "documents"),
        HashEmbedder(DIM),
        id_col=F.concat_ws("-", "lang", "n_chars"),
        seq_col="doc_id",
    )


def _documents_and_labelled(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents keyed by language and length, and those with a label once more, marked."""
    documents = table(spark, folder, "documents").select(
        F.concat_ws("-", "lang", "n_chars").alias("id"), F.col("doc_id").alias("seq"), "text"
    )
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("seq"), "quality")
    labelled = documents.join(labels, "seq").select(
        "id", "seq", F.concat(F.lit("quality "), "quality", F.lit(": "), "text").alias("text")
    )
    return documents, labelled


def upsert_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    documents, labelled = _documents_and_labelled(spark, folder)
    return upsert(keep_last(documents, "id"), labelled, "id")


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Documents arriving file by file, then again, marked, those that have a label."""
    store = _store(spark)
    store.create("streamed", DIM)
    arriving = fresh_folder(spark, "arriving")
    # Three files a delivery, of which two make a batch; where they would be large, each is as many as keep a file in bounds.
    size = table(spark, folder, "documents").agg(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0
    parts = max(1, math.ceil(size / (3 * FILE_BYTES)))
    for number, delivery in enumerate(_documents_and_labelled(spark, folder)):
        # Rows of one id share a file: files of one delivery may be taken in any order. A batch may
        # hold files of both deliveries, so a row says which one it came with.
        numbered = delivery.withColumn("delivery", F.lit(number))
        numbered.repartition(3 * parts, "id").write.mode("append").parquet(arriving)
    source = (
        spark.readStream.schema(numbered.schema).option("maxFilesPerTrigger", 2 * parts).parquet(arriving)
    )
    stream = ingest_stream(
        store,
        "streamed",
        source,
        HashEmbedder(DIM),
        fresh_folder(spark, "checkpoint"),
        seq_col=F.struct("delivery", "seq"),
        compact_every=2,
    )
    stream.awaitTermination()
    return store.points("streamed").select("id", "text")


# ---- catalog


def create_collections(spark: SparkSession, folder: str) -> DataFrame:
    """Each document asks for a collection of its source and language."""
    documents = table(spark, folder, "documents")
    name = F.concat_ws("_", "source", "lang")
    requests = documents.select(
        F.col("doc_id").alias("seq"),
        F.when(F.col("source") == "src9", F.initcap(name)).otherwise(name).alias("name"),
        F.when(F.col("n_chars") > 1000, F.lit(DIM)).alias("vector_size"),
        F.when(F.col("source") == "src4", F.lit("L2_norm"))
        .when(F.col("lang") == "fr", F.lit("Dot"))
        .otherwise(F.lit("Cosine"))
        .alias("distance"),
        F.when(F.col("lang") == "en", F.lit("nomic-embed-text"))
        .when(F.col("lang") == "de", F.lit("all-MiniLM-L6-v2"))
        .when(F.col("lang") == "fr", F.lit("no-such-model"))
        .otherwise(F.lit(""))
        .alias("model_name"),
    )
    toxic = table(spark, folder, "labels").filter(F.col("toxic") == 1).select("doc_id")
    registered = documents.join(toxic, "doc_id", "left_semi").select(name.alias("name")).distinct()
    return plan_creation(requests, registered)


def list_collections(spark: SparkSession, folder: str) -> DataFrame:
    return list_tables(
        table(spark, folder, "documents").select(F.col("source").alias("name")).distinct()
    )


def collection_filter(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "documents").select(
        F.concat_ws("_", "source", "lang").alias("name")
    )
    return list_tables(names.distinct(), FILTER)


def example_health(spark: SparkSession, folder: str) -> DataFrame:
    """The example collection, and one in which some ids and vectors are wrong."""
    good = example_collection(spark, folder).points
    bad = good.select(
        F.when(F.length("text") > 500, F.col("id")).alias("id"),
        F.when(F.length("text") < 9000, F.slice("embedding", 1, DIM - 1))
        .otherwise(F.lit(None))
        .alias("embedding"),
    )
    names = table(spark, folder, "documents").select(F.col("source").alias("name")).distinct()
    reports = [
        health_report(points, names, name, DIM, len(HashEmbedder(DIM).embed(["preflight"])[0]))
        .withColumn("collection", F.lit(name))
        for name, points in (("src1", good), ("missing", bad.unionByName(bad)))
    ]
    return reduce(DataFrame.unionByName, reports)


def collection_health_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """What is known of the stored documents, some of them overwritten, without reading any, and the verdict on them."""
    store = upserted_store(spark, folder, indexed=False)
    verdict = collection_health(store, "documents", HashEmbedder(DIM), exact=False).filter(F.col("check") == "verdict")
    facts = store.statistics("documents")
    near = F.abs(F.col("distinct_ids") / (F.col("points") - F.col("replaced")) - 1) <= ERRORS * HLL_ERROR
    columns = ["points", "replaced", "no_id", "no_vector", "wrong_size", "text_bytes", "longest"]
    return facts.select(*columns, near.alias("distinct_near")).join(F.broadcast(verdict.select("status")))


QUERIES = {
    "vector_topk_cosine": vector_topk("Cosine"),
    "vector_topk_dot": vector_topk_dot,
    "vector_topk_euclid": vector_topk("Euclid"),
    "vector_topk_manhattan": vector_topk("Manhattan"),
    "vector_topk_offset": vector_topk_offset,
    "score_filter": score_filter,
    "result_contract": result_contract,
    "keyword_leg": keyword_leg,
    "keyword_leg_postings": keyword_leg_postings,
    "search_after_upserts": search_after_upserts,
    "vector_topk_cells": vector_topk_cells,
    "rrf_fusion": rrf_fusion,
    "rrf_fusion_deep": rrf_fusion_deep,
    "vector_topk_small_norm": vector_topk_small_norm,
    "search_dirty_points": search_dirty_points,
    "hybrid_search": hybrid_search,
    "hybrid_fallback": hybrid_fallback,
    "batch_hybrid": batch_hybrid,
    "batch_hybrid_turns": batch_hybrid_turns,
    "sql_search_many": sql_search_many,
    "sql_table_function": sql_table_function,
    "join_metadata": join_metadata,
    "join_fact": join_fact,
    "extract_keywords": extract_keywords_query,
    "extract_keywords_uncapped": extract_keywords_uncapped,
    "text_index_postings": text_index_postings,
    "hash_embed": hash_embed,
    "batch_embed": batch_embed,
    "batch_embed_whole_text": batch_embed_whole_text,
    "point_id_uuid5": point_id_uuid5,
    "ingest_clean": ingest_clean,
    "ingest_truncate": ingest_truncate,
    "ingest_concat_text": ingest_concat_text,
    "dimension_check": dimension_check,
    "ingest_documents": ingest_documents,
    "ingest_by_cost": ingest_by_cost,
    "ingest_summary": ingest_summary,
    "upsert_last_wins": upsert_last_wins,
    "stream_ingest": stream_ingest,
    "create_collections": create_collections,
    "list_collections": list_collections,
    "collection_filter": collection_filter,
    "collection_health": example_health,
    "collection_health_sketch": collection_health_sketch,
}
