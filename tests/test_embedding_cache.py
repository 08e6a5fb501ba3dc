"""Texts met before do not reach the model."""

import os

import pytest

from farsight.operators.embedding import HashEmbedder
from farsight.operators.ingest import ingest
from farsight.session import fresh_folder
from farsight.sources.embedding_cache import EmbeddingCache
from farsight.sources.store import CollectionStore

DIM = 16


def counting(folder, model="counting"):
    # within a function, so that workers get the class with the object
    class Counting:
        """Notes every text it is asked for in a file; gives too few elements for texts that say so."""

        def __init__(self, folder, model="counting"):
            self.folder, self.model = folder, model

        def embed(self, texts):
            with open(f"{self.folder}/{os.getpid()}", "a") as file:
                file.writelines(text + "\n" for text in texts)
            vectors = HashEmbedder(DIM).embed(texts)
            return [list(vector)[: 3 if "broken" in text else DIM] for text, vector in zip(texts, vectors)]

        def asked(self):
            return sorted(line.strip() for name in os.listdir(self.folder) for line in open(f"{self.folder}/{name}"))

    return Counting(folder, model)


@pytest.fixture
def parts(spark, tmp_path):
    store = CollectionStore(spark, fresh_folder(spark, "cached"))
    for name in ("one", "two", "plain"):
        store.create(name, DIM)
    return store, EmbeddingCache(spark, fresh_folder(spark, "cache")), counting(str(tmp_path))


def test_the_model_is_asked_once_for_a_text(spark, parts):
    store, cache, embedder = parts
    rows = [(f"d{n}", f"text {n % 5}") for n in range(30)] + [("none", None)]
    df = spark.createDataFrame(rows, "id string, text string").repartition(3)
    ingest(store, "one", df, embedder, cache=cache)
    once = ["", *(f"text {n}" for n in range(5))]
    assert embedder.asked() == once
    ingest(store, "one", df, embedder, cache=cache)  # unchanged
    ingest(store, "two", df, embedder, cache=cache)  # another collection
    assert embedder.asked() == once
    ingest(store, "one", spark.createDataFrame([("d1", "new"), ("d2", "text 3")], df.schema), embedder, cache=cache)
    assert embedder.asked() == sorted([*once, "new"])
    # the vectors are the model's, and another model has its own
    ingest(store, "plain", df, counting(embedder.folder, "other"), cache=cache)
    points = {name: {r["id"]: r["embedding"] for r in store.points(name).collect()} for name in ("two", "plain")}
    assert points["two"] == points["plain"] and len(points["two"]) == 31
    assert len(embedder.asked()) == 13


def test_wrong_answers_are_not_kept(spark, parts):
    store, cache, embedder = parts
    df = spark.createDataFrame([("a", "fine"), ("b", "broken")], "id string, text string")
    for _ in range(2):
        with pytest.raises(ValueError, match="1 vectors"):
            ingest(store, "one", df, embedder, cache=cache)
    assert embedder.asked() == ["broken", "broken", "fine"]
    assert cache.vectors("counting").count() == 1 and cache.vectors("unknown").count() == 0
