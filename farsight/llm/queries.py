"""The registered queries on text corpora, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm import (
    decontam,
    exact,
    language,
    lexical,
    licenses,
    lines,
    lm,
    mixing,
    near_dups,
    negatives,
    prefix_tokens,
    token_files,
    toxicity,
)


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _fold(doc_id: str | Column, folds: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity, learned from the labelled documents outside the held-out fold."""
    docs = _read(spark, folder, "documents")
    labels = _read(spark, folder, "labels").filter(_fold("doc_id", 4) != 2).select("doc_id", "toxic")
    labelled = toxicity.labelled_texts(docs, labels)
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(labelled))
    return scored.select(
        "doc_id",
        (_fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents under a model of those outside the held-out fold, and under a unigram model."""
    return lm.score_texts(_read(spark, folder, "documents"), _fold("doc_id", 7) == 2)


def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    return near_dups.near_groups(_read(spark, folder, "documents")).select("doc_id", "class_id", "kept")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the lines that came before, nearly or exactly."""
    return lines.dedup_lines(_read(spark, folder, "documents"), radius=None).select("doc_id", "n_lines", "n_dropped", "text")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents mixed to source weights 3, 1, 2 at 150 % of all words, at most twice each source."""
    mixed = mixing.mix(_read(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents with the same bytes."""
    return exact.exact_groups(_read(spark, folder, "documents"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that documents hold."""
    return decontam.contamination(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of whole documents, and whether they are over 1,024."""
    return prefix_tokens.token_counts(_read(spark, folder, "documents"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents, learned outside the held-out fold."""
    docs = _read(spark, folder, "documents")
    learned = language.language_dictionaries(docs.filter(_fold("doc_id", 4) != 2))
    found = language.identify(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", (_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in documents."""
    return licenses.scan_licenses(_read(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, labels of every seventh moved on by one."""
    vectors = _read(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return lexical.search_items(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document's token ids lie, and their checksum, as read back from the files."""
    found = token_files.encode_and_index(_read(spark, folder, "documents"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_lm_scores": op2_lm_scores,
    "op3_near_dedup": op3_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_license_scan": op10_license_scan,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_files": op13_token_files,
}

_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 6))::BIGINT AS draw
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, 2 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM totals),
steps AS (
  SELECT *, coalesce(sum(cap) OVER lower, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0) AS rest,
         1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM weighted
  WINDOW lower AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((total - capped::DOUBLE) / rest::DOUBLE) AS level FROM steps),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * level) AS target,
         CASE WHEN source_size > 0 THEN floor(least(cap::DOUBLE, weight * level) / source_size) ELSE 0 END AS whole
  FROM weighted, level),
draws AS (
  SELECT source, draw, sum(size) AS size FROM sized GROUP BY source, draw),
edges AS (
  SELECT d.source, d.draw, d.size, t.target - t.whole * t.source_size AS need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw) - d.size AS before
  FROM draws d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
limits AS (
  SELECT source, coalesce(max(draw) FILTER (need > 0 AND before + size - need <= need - before), -1) AS last
  FROM edges GROUP BY source)
SELECT s.doc_id, s.size, t.source_size, t.target,
       (s.size * (t.whole + CASE WHEN s.draw <= l.last THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
JOIN limits l ON s.source IS NOT DISTINCT FROM l.source
"""

_EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_quoted = lambda text: "'" + text.replace("'", "''") + "'"
_LICENSE_SQL = rf"""
WITH templates(license, text) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in licenses.TEMPLATES.items())}),
texts AS (
  SELECT license, NULL AS doc_id, regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+') AS words FROM templates
  UNION ALL
  SELECT NULL, doc_id, regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+') FROM documents),
shingles AS (
  SELECT DISTINCT license, doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT license, doc_id, words, unnest(range(1, len(words) - 3)) AS i
        FROM (SELECT license, doc_id, CASE WHEN license IS NULL THEN words ELSE list_filter(words, lambda w: w <> '') END AS words
              FROM texts))),
sought AS (SELECT license, shingle, count(*) OVER (PARTITION BY license) AS n FROM shingles WHERE license IS NOT NULL)
SELECT d.doc_id, s.license, count(*)::DOUBLE / s.n AS containment, count(*)::INTEGER AS shingles
FROM sought s JOIN shingles d ON d.license IS NULL AND d.shingle = s.shingle
GROUP BY d.doc_id, s.license, s.n HAVING count(*)::DOUBLE / s.n >= 0.8
"""

_NEGATIVES_SQL = """
WITH labelled AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
taking AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM labelled QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, embedding) = 1),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM taking a JOIN taking c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 3
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LEXICAL_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, doc_id,
         regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS terms
  FROM documents),
items AS (
  SELECT row_number() OVER () AS item, item_id,
         unnest(list_distinct(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}'))) AS term
  FROM benchmark),
sizes AS (SELECT doc, doc_id, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM sizes),
counts AS (
  SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY doc, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, totals GROUP BY term, docs),
impacts AS (
  SELECT doc, doc_id, term, 1000000000 * tf // (1000 * tf + 20 * (100 - 50 + 50 * n * docs // all_terms)) AS impact
  FROM counts JOIN sizes USING (doc), totals),
scores AS (
  SELECT item, item_id, doc, doc_id, sum(w * impact)::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item, item_id, doc, doc_id)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER best <= 50
"""

ORACLE_SQL = {
    "op11_hard_negatives": _NEGATIVES_SQL,
    "op12_lexical_search": _LEXICAL_SQL,
    "op10_license_scan": _LICENSE_SQL,
    "op5_mixing": _MIX_SQL,
    "op6_exact_dedup": _EXACT_SQL,
}
