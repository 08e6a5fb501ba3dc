import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from farsight.functions.distance import METRICS, distance, score_against
from farsight.functions.hashing import hash_embed_words
from farsight.functions.ids import point_id
from farsight.functions.text import STOP_WORDS, extract_keywords, index_tokens, text_for_embedding, words
from farsight.operators.embedding import HashEmbedder

KEYWORD_CASES = {
    "banks acquired by JP Morgan": ["banks", "acquired", "banksacquired", "jp", "morgan", "jpmorgan"],
    "what is the": [],
    "": [],
    "J.P. Morgan": ["morgan"],
    "data data lake": ["data", "lake"],
    "jpmorgan JP Morgan": ["jpmorgan", "jp", "jpmorganjp", "morgan"],
    "how do I reset my password": ["reset", "password"],
    "Müller GmbH": ["ller", "gmbh", "llergmbh"],
    "a1 b2 c3 d4 e5 f6 g7 h8": [
        "a1", "b2", "a1b2", "c3", "b2c3", "d4", "c3d4", "e5", "d4e5", "f6", "e5f6", "g7",
    ],
}


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize("query", KEYWORD_CASES)
def test_keywords(spark, query):
    assert one(spark, query, extract_keywords) == KEYWORD_CASES[query]


def test_there_are_111_stop_words():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 111
    assert STOP_WORDS == sorted(STOP_WORDS)


def test_no_stop_word_is_a_keyword(spark):
    assert one(spark, " ".join(STOP_WORDS), extract_keywords) == []


def test_keywords_of_a_null_query(spark):
    assert one(spark, None, extract_keywords) == []


def test_kelvin_sign_is_not_a_k(spark):
    assert one(spark, "10K lamp", extract_keywords) == ["10", "lamp", "10lamp"]


def test_unicode_keywords_follow_the_index(spark):
    assert one(spark, "Müller GmbH", lambda v: extract_keywords(v, unicode=True)) == [
        "müller", "gmbh", "müllergmbh",
    ]


def test_keywords_of_a_long_text_are_those_of_its_beginning(spark):
    long = " ".join(f"word{n}" for n in range(20000))
    assert one(spark, long, extract_keywords) == one(spark, long[:200], extract_keywords)


def test_index_tokens(spark):
    text = f"Émile's x {'a' * 40} {'b' * 41} MÜLLER müller 42 snake_case"
    assert one(spark, text, index_tokens) == ["émile", "a" * 40, "müller", "42", "snake", "case"]
    assert one(spark, None, index_tokens) == []


@pytest.mark.parametrize("text", ["x" * 6000, "x" * 6001, "é" * 6001, "\U0001f600" * 6001])
def test_truncation_counts_characters(spark, text):
    assert one(spark, text, text_for_embedding) == text[:6000]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("doc-1", "eea9cb72-744e-5814-a929-652d970d86ac"),
        ("doc-2", "2652c3f2-4088-5a28-b1ae-5ff2fd825971"),
        ("id-0", "368e20ce-c07f-5e7a-aac2-f9fbe998c7af"),
        ("é2", "1085b015-1c7d-5110-9a31-b22f410925c9"),
    ],
)
def test_point_ids(spark, given, expected):
    assert one(spark, given, point_id) == expected


def test_point_ids_are_the_standard_ones(spark):
    names = [f"name {n} ä" for n in range(500)]
    rows = spark.createDataFrame([(n,) for n in names], "v string").select("v", point_id(F.col("v")))
    assert {r[0]: r[1] for r in rows.collect()} == {
        n: str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names
    }


def _reference(metric, a, b):
    a, b = np.array(a, dtype=np.float32).astype(float), np.array(b, dtype=np.float32).astype(float)
    if metric == "Dot":
        return float(a @ b)
    if metric == "Cosine":
        norm = np.linalg.norm(a) * np.linalg.norm(b)
        return float(a @ b / norm) if norm else 0.0
    return float(np.linalg.norm(a - b) if metric == "Euclid" else np.abs(a - b).sum())


@pytest.mark.parametrize("metric", METRICS)
def test_metrics(spark, metric):
    rng = random.Random(1)
    vectors = [[rng.uniform(-1, 1) for _ in range(5)] for _ in range(30)] + [[0.0] * 5]
    query = vectors[3]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(vectors)], "n int, v array<float>")
    native = distance(metric, F.col("v"), F.array(*[F.lit(x).cast("float") for x in query]))
    query32 = [float(np.float32(x)) for x in query]
    rows = df.select("n", native, score_against(metric, F.col("v"), query32)).collect()
    for n, exact, rounded in rows:
        assert exact == pytest.approx(_reference(metric, vectors[n], query), abs=1e-9)
        assert rounded == pytest.approx(exact, abs=6e-7)


def test_unknown_metric():
    with pytest.raises(ValueError, match="Manhattan"):
        distance("L2_norm", F.lit(1), F.lit(2))


def test_vectors_that_cannot_be_compared_have_no_score(spark):
    rows = [([1.0, 2.0],), ([1.0],), (None,), ([float("nan"), 0.0],), ([float("inf"), 0.0],), ([None, 1.0],), ([1e-5, 3e-5],)]
    df = spark.createDataFrame(rows, "v array<float>").coalesce(1)
    found = [row[0] for row in df.select(score_against("Dot", F.col("v"), [1.0, 1.0])).collect()]
    assert found[:6] == [3.0, None, None, None, None, None] and abs(found[6] - 4e-5) < 1e-11


def test_both_hashed_embeddings_agree(spark):
    texts = ["Hello hello World", "", "Straße 42, ÉCOLE!", "a_b c-d " * 50]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    column = df.select("n", hash_embed_words(words(F.col("t")), 16).alias("e")).orderBy("n")
    found = np.array([row["e"] for row in column.collect()], dtype=np.float32)
    assert np.array_equal(found, HashEmbedder(16).embed(texts))
    assert np.allclose(np.linalg.norm(found, axis=1), [1, 0, 1, 1])
