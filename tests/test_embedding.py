import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from farsight.operators.embedding import (
    HashEmbedder,
    OllamaEmbedder,
    OpenAIEmbedder,
    embed_column,
    embed_query,
    make_embedder,
)


# Tasks cannot import this module, so what they need from it travels with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Answers:
    """A transport that gives prepared answers and notes what it was asked."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def __call__(self, url, payload, headers):
        self.asked.append((url, payload, headers))
        status, body = self.answers.pop(0)
        return status, body if isinstance(body, str) else json.dumps(body)


def test_ollama_batch():
    post = Answers((200, {"embeddings": [[1.0], [2.0]]}))
    assert OllamaEmbedder("http://h:1/", "m", post).embed(["a", "b"]) == [[1.0], [2.0]]
    assert post.asked == [("http://h:1/api/embed", {"model": "m", "input": ["a", "b"]}, {})]


def test_ollama_without_batch_endpoint():
    post = Answers((404, "no"), (200, {"embedding": [1.0]}), (200, {"embedding": [2.0]}))
    assert OllamaEmbedder("http://h", "m", post).embed(["a", "b"]) == [[1.0], [2.0]]
    assert [url for url, _, _ in post.asked[1:]] == ["http://h/api/embeddings"] * 2
    assert [payload["prompt"] for _, payload, _ in post.asked[1:]] == ["a", "b"]


@pytest.mark.parametrize("answers", [[(500, "broken")], [(404, "no"), (500, "broken")]])
def test_ollama_failure(answers):
    with pytest.raises(RuntimeError, match="500.*broken"):
        OllamaEmbedder("http://h", "m", Answers(*answers)).embed(["a"])


def openai(post, waits):
    return OpenAIEmbedder("key", "m", post, waits.append)


def test_openai():
    post, waits = Answers((200, {"data": [{"embedding": [1.0]}, {"embedding": [2.0]}]})), []
    assert openai(post, waits).embed(["a", "b"]) == [[1.0], [2.0]]
    assert post.asked[0][2] == {"Authorization": "Bearer key"} and waits == []


def test_openai_waits_when_told_to():
    post, waits = Answers((429, ""), (429, ""), (200, {"data": [{"embedding": [1.0]}]})), []
    assert openai(post, waits).embed(["a"]) == [[1.0]]
    assert waits == [1.0, 2.0]


def test_openai_gives_up_after_three_attempts():
    post, waits = Answers(*[(429, "slow down")] * 4), []
    with pytest.raises(RuntimeError, match="429"):
        openai(post, waits).embed(["a"])
    assert len(post.asked) == 3 and waits == [1.0, 2.0]


def test_openai_other_errors_are_not_tried_again():
    post, waits = Answers((401, "who are you")), []
    with pytest.raises(RuntimeError, match="401"):
        openai(post, waits).embed(["a"])
    assert len(post.asked) == 1


def test_no_connection():
    with pytest.raises(RuntimeError, match="no connection"):
        OllamaEmbedder("http://127.0.0.1:9", "m").embed(["a"])


def test_providers():
    assert isinstance(make_embedder("Ollama", url="http://h"), OllamaEmbedder)
    assert make_embedder(url="http://h").model == "nomic-embed-text"
    assert isinstance(make_embedder("OPENAI", api_key="k", model="m"), OpenAIEmbedder)
    with pytest.raises(ValueError, match="local"):
        make_embedder("local")


def test_a_query_without_an_embedding():
    for empty in ([], [[]]):
        with pytest.raises(RuntimeError, match="no embedding"):
            embed_query(OllamaEmbedder("u", "m", Answers((200, {"embeddings": empty}))), "q")


class Counting:
    """Puts the size of the call a text was part of into its vector."""

    model = "counting"

    def embed(self, texts):
        return [[float(len(texts)), float(len(text))] for text in texts]


def test_batches(spark):
    df = spark.range(250).select("id", F.concat(F.lit("text "), "id").alias("t")).coalesce(1)
    rows = embed_column(df, "t", Counting()).collect()
    assert [r["embedding"][0] for r in rows] == [100.0] * 200 + [50.0] * 50
    assert [r["embedding"][1] for r in rows] == [float(len(f"text {n}")) for n in range(250)]
    sizes = embed_column(df, "t", Counting(), batch_size=7).select(F.col("embedding")[0]).distinct()
    assert {r[0] for r in sizes.collect()} == {7.0, 5.0}
    with pytest.raises(ValueError):
        embed_column(df, "t", Counting(), batch_size=0)


class Short:
    model = "short"

    def embed(self, texts):
        return [[1.0]] * (len(texts) - 1)


def test_a_missing_vector_is_an_error(spark):
    df = spark.range(3).select("id", F.lit("x").alias("t"))
    with pytest.raises(Exception, match="vectors for"):
        embed_column(df, "t", Short()).collect()


def test_hashing_is_an_embedder():
    assert len(embed_query(HashEmbedder(12), "some words")) == 12
