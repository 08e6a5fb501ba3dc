"""Embedding a column of texts in batches, and the services that can do it."""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import counts_of_words, to_list_array, unit_rows

# Defaults of the ingest.
BATCH_SIZE = 100
DEFAULT_PROVIDER = "ollama"
DEFAULT_MODEL = "nomic-embed-text"
OPENAI_URL = "https://api.openai.com/v1/embeddings"
RATE_LIMIT_WAITS = (1.0, 2.0)
# A service that does not answer for so many seconds fails the task, which Spark tries again.
TIMEOUT = 120.0
WORD = re.compile(r"[^\W_]+")

# post(url, payload, headers) -> (status, body text)
Transport = Callable[[str, dict, dict], tuple[int, str]]


class Embedder(Protocol):
    model: str

    def embed(self, texts: Sequence[str]) -> Sequence[Sequence[float]]: ...


def http_post(url: str, payload: dict, headers: dict) -> tuple[int, str]:
    request = urllib.request.Request(
        url,
        data=json.dumps(payload).encode("utf-8"),
        headers={"Content-Type": "application/json", **headers},
        method="POST",
    )
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT) as response:
            return response.status, response.read().decode("utf-8")
    except urllib.error.HTTPError as error:
        return error.code, error.read().decode("utf-8", "replace")
    except urllib.error.URLError as error:
        raise RuntimeError(f"no connection to {url}: {error.reason}") from error
    except TimeoutError as error:
        raise RuntimeError(f"no answer from {url} within {TIMEOUT:g} seconds") from error


def _json_or_raise(url: str, status: int, body: str) -> dict:
    if status != 200:
        raise RuntimeError(f"HTTP {status} from {url}: {body}")
    return json.loads(body)


@dataclass(frozen=True)
class OllamaEmbedder:
    """One call per batch; one call per text where the server has no batch endpoint."""

    url: str
    model: str = DEFAULT_MODEL
    post: Transport = http_post

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        base = self.url.rstrip("/")
        target = f"{base}/api/embed"
        status, body = self.post(target, {"model": self.model, "input": list(texts)}, {})
        if status != 404:
            return _json_or_raise(target, status, body)["embeddings"]
        single = f"{base}/api/embeddings"
        answers = (self.post(single, {"model": self.model, "prompt": t}, {}) for t in texts)
        return [_json_or_raise(single, *answer)["embedding"] for answer in answers]


@dataclass(frozen=True)
class OpenAIEmbedder:
    """Waits and tries again when told to slow down (429), at most three attempts in all."""

    api_key: str = field(repr=False)
    model: str
    post: Transport = http_post
    sleep: Callable[[float], None] = time.sleep

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        payload = {"model": self.model, "input": list(texts)}
        headers = {"Authorization": f"Bearer {self.api_key}"}
        for wait in (*RATE_LIMIT_WAITS, None):
            status, body = self.post(OPENAI_URL, payload, headers)
            if status != 429 or wait is None:
                break
            self.sleep(wait)
        return [item["embedding"] for item in _json_or_raise(OPENAI_URL, status, body)["data"]]


@dataclass(frozen=True)
class HashEmbedder:
    """The local stand-in; gives the same vectors as `functions.hashing.hash_embed_words`."""

    dim: int

    @property
    def model(self) -> str:
        return f"hash-{self.dim}"

    def embed(self, texts: Sequence[str]):
        return unit_rows(counts_of_words([WORD.findall(text.lower()) for text in texts], self.dim))


def make_embedder(provider: str = DEFAULT_PROVIDER, **settings) -> Embedder:
    """The embedder of a provider; an unknown one fails here, before any row is read."""
    makers = {"ollama": OllamaEmbedder, "openai": OpenAIEmbedder}
    maker = makers.get(provider.lower())
    if maker is None:
        raise ValueError(f"unknown provider {provider!r}: choose one of {', '.join(makers)}")
    return maker(**settings)


def embed_query(embedder: Embedder, query: str) -> list[float]:
    """The vector of one query text."""
    vectors = embedder.embed([query])
    if vectors is None or len(vectors) == 0 or len(vectors[0]) == 0:
        raise RuntimeError(f"no embedding came back for model {embedder.model!r}")
    return [float(value) for value in vectors[0]]


def _as_lists(vectors) -> pa.Array:
    if isinstance(vectors, np.ndarray):
        return to_list_array(vectors)
    return pa.array([list(vector) for vector in vectors], pa.list_(pa.float32()))


def embed_texts(embedder: Embedder, batch_size: int = BATCH_SIZE) -> Callable[[pa.Array], pa.Array]:
    """Vectors for an Arrow array of texts (NULL counts as empty), at most `batch_size` texts per model call."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")

    def embed(texts: pa.Array) -> pa.Array:
        parts = []
        for start in range(0, len(texts), batch_size):
            part = [text or "" for text in texts.slice(start, batch_size).to_pylist()]
            vectors = embedder.embed(part)
            if len(vectors) != len(part):
                raise RuntimeError(f"{len(vectors)} vectors for {len(part)} texts")
            parts.append(_as_lists(vectors))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))

    return embed


def embed_column(
    df: DataFrame, text_col: str, embedder: Embedder, batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Replace the text column by `embedding`, at most `batch_size` texts per model call.

    Only this column travels to the embedder and only vectors come back. The function is declared
    nondeterministic so that Spark never evaluates it twice for one row.
    """
    embed = embed_texts(embedder, batch_size)

    def run(texts: pa.Array) -> pa.Array:
        return embed(texts)

    once = F.arrow_udf(run, "array<float>").asNondeterministic()
    return df.withColumn("embedding", once(F.col(text_col))).drop(text_col)
