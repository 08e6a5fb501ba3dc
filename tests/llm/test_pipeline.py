"""The pipeline over a small folder against brute force, stage by stage."""

import hashlib
import re

import corpus_pipeline
from farsight.llm import language
from tests.llm.test_small import WORDS, alike, brute_classes, brute_lines, line_rows, near_rows, shingles

SOURCES = ["a", "b", None, "c"]


def folder_of(spark, path):
    texts = [t for _, t in near_rows()] + [t for _, t in line_rows() if t] + ["", "123 456", None, "!!! ###"]
    item = " ".join(f"bench{w}" for w in WORDS)
    texts += [f"some words before {item} and after", item.upper(), " ".join(item.split()[:9])]
    rows = [(i, t, "en" if i < len(near_rows()) else "de", SOURCES[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return [(i, t, s) for i, t, _, s, _ in rows], item


def words_in(text):
    return len([w for w in re.split(r"[\x20\x09-\x0D]+", text) if w])


def brute_mix(rows):
    """Copies of each row."""
    sizes = {}
    for i, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words_in(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        level = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in rest)
        over = {s for s in rest if 2 * sizes[s] < weight[s] * level}
        if not over:
            break
        full |= over
    copies = {}
    for source in order:
        target = min(2.0 * sizes[source], weight[source] * level)
        whole = int(target // sizes[source]) if sizes[source] else 0
        need = target - whole * sizes[source]
        own = sorted(
            (int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:6], 16), i, words_in(t)) for i, t, s in rows if s == source
        )
        before, limit = 0, -1
        for draw in sorted({d for d, _, _ in own}):
            size = sum(n for d, _, n in own if d == draw)
            if need > 0 and before + size - need <= need - before:
                limit = draw
            before += size
        copies |= {i: whole + (d <= limit) for d, i, _ in own}
    return copies


def test_pipeline(spark, tmp_path):
    rows, item = folder_of(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = language.CompressionClassifier(language.language_dictionaries(docs))
    rows = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1]) and model.best(r[1])[1] > language.MARGIN]
    assert len(rows) > 40
    left = brute_lines([(i, t) for i, t, _ in rows])
    rows = [(i, left[i], s) for i, t, s in rows if left[i] == t or left[i].strip(" ")]
    root = brute_classes([(i, t) for i, t, _ in rows])
    rows = [r for r in rows if root[r[0]] == r[0]]
    size = len(item.split())

    def leaks(text):
        words = text.split()
        windows = (" ".join(words[k : k + size]) for k in range(len(words) - size + 1))
        return any(alike(shingles(item), shingles(window)) >= 0.8 for window in windows)

    assert any(leaks(t) for _, t, _ in rows)
    rows = [r for r in rows if not leaks(r[1])]
    copies = brute_mix(rows)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    wanted = sorted((i, t, epoch) for i, t, _ in rows for epoch in range(1, copies[i] + 1))
    assert sorted((r["doc_id"], r["text"], r["epoch"]) for r in found) == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_stages_of_an_empty_table(spark, tmp_path):
    folder_of(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs.limit(0), str(tmp_path))
        assert found.count() == 0 and found.columns[: len(docs.columns)] == docs.columns
