"""The SQL that says what each registered query must return, for a plain SQL database."""

from __future__ import annotations

from ..functions.text import STOP_WORDS

_STOP_LIST = "[" + ", ".join(f"'{word}'" for word in STOP_WORDS) + "]"
_WORDS = r"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"
_TOKENS = (
    "list_distinct(list_filter(" + _WORDS + ", lambda t: length(t) BETWEEN 2 AND 40))"
)
_NAMESPACE = r"'\x6B\xA7\xB8\x10\x9D\xAD\x11\xD1\x80\xB4\x00\xC0\x4F\xD4\x30\xC8'::BLOB"


def words(text: str) -> str:
    return _WORDS.format(text=text)


def tokens(text: str) -> str:
    return _TOKENS.format(text=text)


def digest(text: str) -> str:
    return f"sha1({_NAMESPACE} || encode({text}))"


def uuid5(text: str) -> str:
    sha = digest(text)
    variant = f"translate(substr({sha}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"(substr({sha}, 1, 8) || '-' || substr({sha}, 9, 4) || '-5' || substr({sha}, 14, 3) "
        f"|| '-' || {variant} || substr({sha}, 18, 3) || '-' || substr({sha}, 21, 12))"
    )


def keywords(source: str, most: int | None = 12) -> str:
    """CTEs giving `extracted(id, keywords)` from a table or query with (id, text)."""
    more = "" if most is None else f"AND len(f.found) < {most}"
    shown = "" if most is None else f"[1:{most}]"
    return rf"""
    ascii_words AS (
        SELECT id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[a-z0-9]+') AS w
        FROM ({source})
    ),
    fold(id, place, found, previous) AS (
        SELECT id, 0, []::VARCHAR[], NULL::VARCHAR FROM ascii_words
        UNION ALL
        SELECT id, place + 1,
            CASE WHEN NOT counts THEN found
                 WHEN previous IS NOT NULL AND NOT list_contains(found, previous || word)
                 THEN list_concat(found, [word, previous || word])
                 ELSE list_concat(found, [word]) END,
            CASE WHEN counts THEN word END
        FROM (
            SELECT f.id, f.place, f.found, f.previous, a.w[f.place + 1] AS word,
                length(a.w[f.place + 1]) >= 2
                AND NOT list_contains({_STOP_LIST}, a.w[f.place + 1])
                AND NOT list_contains(f.found, a.w[f.place + 1]) AS counts
            FROM fold f JOIN ascii_words a ON a.id = f.id
            WHERE f.place < len(a.w) {more}
        )
    ),
    extracted AS (SELECT id, arg_max(found, place){shown} AS keywords FROM fold GROUP BY id)
    """


def hashed_counts(name: str, source: str, dim: int = 64) -> str:
    """A CTE giving (id, bucket, value) for each bucket whose signed counts do not cancel out."""
    return rf"""
    {name} AS (
        SELECT id, ('0x' || substr(h, 1, 8))::BIGINT % {dim} AS bucket,
            sum(CASE WHEN ('0x' || substr(h, 9, 2))::BIGINT % 2 = 1 THEN -1 ELSE 1 END)::DOUBLE
                AS value
        FROM (SELECT id, md5(unnest({words("text")})) AS h FROM ({source}))
        GROUP BY ALL HAVING value <> 0
    )
    """


def unit_values(name: str, counts: str) -> str:
    return f"""
    {name} AS (
        SELECT id, bucket,
            (value / sqrt(sum(value * value) OVER (PARTITION BY id)))::FLOAT AS value
        FROM {counts}
    )
    """


def dense(name: str, values: str, source: str, dim: int = 64) -> str:
    """A CTE giving (id, v) with v a list of `dim` values, zeros for a text without words."""
    return f"""
    {name} AS (
        SELECT s.id, list(coalesce(x.value, 0)::DOUBLE ORDER BY r.bucket) AS v
        FROM ({source}) s CROSS JOIN (SELECT unnest(range({dim})) AS bucket) r
        LEFT JOIN {values} x ON x.id = s.id AND x.bucket = r.bucket
        GROUP BY s.id
    )
    """


def cut(score: str) -> str:
    """A score's first twelve digits, by which points are ranked."""
    digits = f"(11 - floor(log10(abs({score}))))::INTEGER"
    return f"CASE WHEN {score} = 0 THEN 0 ELSE round({score}, {digits}) END"


_POINTS = """
    points AS (
        SELECT e.vec_id::VARCHAR AS id, coalesce(d.text, '') AS text, e.embedding::DOUBLE[] AS v
        FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id
    ),
    example AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 7)
"""
_SCORES = {
    "Cosine": ("list_cosine_similarity(v, qv)", "DESC"),
    "Dot": ("list_inner_product(v, qv)", "DESC"),
    "Euclid": ("list_distance(v, qv)", "ASC"),
    "Manhattan": (
        "list_sum(list_transform(list_zip(v, qv), lambda p: abs(p[1] - p[2])))",
        "ASC",
    ),
}


def topk(distance: str, limit: int, offset: int = 0, columns: str = "*") -> str:
    score, direction = _SCORES[distance]
    return f"""
    WITH {_POINTS}
    SELECT {columns} FROM (
        SELECT id AS "ID", text AS "TEXT", round(s, 6) AS "SCORE", 'what is the' AS "QUERY"
        FROM (SELECT *, {score} AS s FROM points, example)
        ORDER BY {cut("s")} {direction}, "ID" LIMIT {limit} OFFSET {offset}
    )
    """


def legs(limit: int) -> str:
    """CTEs up to `kept(query_id, id, leg, score, rank)` and `fused`, from `points` having tokens,
    `asked(query_id, query, qv)` and `extracted`."""
    vector, keyword = max(10 * limit, 50), max(4 * limit, 20)
    return f"""
    scored AS (
        SELECT a.query_id, p.id, p.toks, x.keywords,
            coalesce(nullif(list_cosine_similarity(p.v, a.qv), 'nan'::DOUBLE), 0) + 0.0::DOUBLE AS whole
        FROM points p CROSS JOIN asked a JOIN extracted x ON x.id = a.query_id
    ),
    digits AS (SELECT *, {cut("whole")} AS score FROM scored),
    legged AS (
        SELECT query_id, id, score, '' AS leg FROM digits
        UNION ALL
        SELECT query_id, id, score, unnest(list_intersect(keywords, toks)) AS leg FROM digits
    ),
    kept AS (
        SELECT *, row_number() OVER (
            PARTITION BY query_id, leg ORDER BY score DESC, id) AS rank
        FROM legged
        QUALIFY rank <= {vector} AND (leg = '' OR rank <= {keyword})
    ),
    fused AS (
        SELECT k.query_id, k.id,
            CASE WHEN len(any_value(x.keywords)) = 0 THEN max(k.score)
                 ELSE list_reduce(list_sort(list(1.0::DOUBLE / (60 + k.rank))), lambda a, b: a + b) END AS score
        FROM kept k JOIN extracted x ON x.id = k.query_id
        GROUP BY k.query_id, k.id
    )
    """


_HASHED_LEGS = f"""
    documents_in AS (SELECT doc_id AS id, text FROM documents),
    {hashed_counts("document_counts", "FROM documents_in")},
    {unit_values("document_units", "document_counts")},
    {dense("document_vectors", "document_units", "FROM documents_in")},
    points AS (
        SELECT d.id::VARCHAR AS id, d.text, x.v, {tokens("d.text")} AS toks
        FROM documents_in d JOIN document_vectors x ON x.id = d.id
    ),
    {hashed_counts("query_counts", "FROM queries_in")},
    {unit_values("query_units", "query_counts")},
    {dense("query_vectors", "query_units", "FROM queries_in")},
    asked AS (
        SELECT i.id AS query_id, i.text AS query, x.v AS qv
        FROM queries_in i JOIN query_vectors x ON x.id = i.id
    ),
    {keywords("FROM queries_in")}
"""


def hashed_legs(limit: int, queries: str) -> str:
    """`legs` over all documents, with hashed vectors, for the rows (id, text) of a query."""
    return f"WITH RECURSIVE queries_in AS ({queries}), {_HASHED_LEGS}, {legs(limit)}"


_ONE_ITEM = "SELECT item_id AS id, text FROM benchmark WHERE item_id = 0"
_ITEMS = "SELECT item_id AS id, text FROM benchmark"
_TURNS = "SELECT conv_id || '-' || turn AS id, text FROM conversations"


def hashed_hits(limit: int) -> str:
    return f"""
    {hashed_legs(limit, _ONE_ITEM)},
    hits AS (
        SELECT f.id AS "ID", p.text AS "TEXT", round(f.score, 9) AS "SCORE", a.query AS "QUERY"
        FROM fused f JOIN points p ON p.id = f.id JOIN asked a ON a.query_id = f.query_id
        ORDER BY f.score DESC, f.id LIMIT {limit}
    )
    """


_DELIVERIES = """
    first_load AS (
        SELECT lang || '-' || n_chars AS id, arg_max(text, doc_id) AS text
        FROM documents GROUP BY 1
    ),
    second_load AS (
        SELECT lang || '-' || n_chars AS id, max(d.doc_id) AS seq,
            arg_max('quality ' || quality || ': ' || text, d.doc_id) AS text
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1
    )
"""

_COLUMNS = """
    (VALUES (1, 'ID', 'string'), (2, 'TEXT', 'string'), (3, 'SCORE', 'double'),
            (4, 'QUERY', 'string')) AS c(position, column_name, data_type)
"""


def health(label: str, points: str) -> str:
    return f"""
    SELECT '{label}' AS collection, unnest([
        {{'place': 1, 'check': 'collection exists', 'ok': known > 0,
          'detail': collections || ' collection(s)'}},
        {{'place': 2, 'check': 'has points', 'ok': points > 0, 'detail': points || ' points'}},
        {{'place': 3, 'check': 'ids present', 'ok': no_id = 0,
          'detail': no_id || ' points without id'}},
        {{'place': 4, 'check': 'ids unique', 'ok': duplicates = 0,
          'detail': duplicates || ' ids stored more than once'}},
        {{'place': 5, 'check': 'vectors present', 'ok': no_vector = 0,
          'detail': no_vector || ' points without vector'}},
        {{'place': 6, 'check': 'vector sizes', 'ok': wrong_size = 0,
          'detail': wrong_size || ' vectors not of size 64'}},
        {{'place': 7, 'check': 'embedding round trip', 'ok': true,
          'detail': '64-dimensional vector returned'}},
        {{'place': 8, 'check': 'verdict',
          'ok': known > 0 AND points > 0 AND no_id = 0 AND duplicates = 0 AND no_vector = 0
                AND wrong_size = 0,
          'detail': CASE WHEN known > 0 AND points > 0 AND no_id = 0 AND duplicates = 0
                              AND no_vector = 0 AND wrong_size = 0
                         THEN 'all checks passed' ELSE 'some checks failed' END}}]) AS r
    FROM (
        SELECT count(*) AS points, count(*) FILTER (id IS NULL) AS no_id,
            count(*) FILTER (v IS NULL) AS no_vector,
            count(*) FILTER (len(v) <> 64) AS wrong_size,
            (SELECT count(*) FROM (
                SELECT id FROM {points} WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
            )) AS duplicates
        FROM {points}
    ), (
        SELECT count(*) AS collections, count(*) FILTER (name = '{label}') AS known FROM names
    )
    """


_SMALL = "list_transform(embedding, lambda x: (x * 1e-5::FLOAT)::FLOAT)::DOUBLE[]"

ORACLE_SQL = {
    "vector_topk_cosine": topk("Cosine", 10),
    "vector_topk_euclid": topk("Euclid", 10),
    "vector_topk_manhattan": topk("Manhattan", 10),
    "vector_topk_offset": topk("Cosine", 15, 20),
    "vector_topk_dot": f"""
        WITH {hashed_counts("document_counts", "SELECT doc_id AS id, text FROM documents")},
        {hashed_counts("query_counts", "SELECT item_id AS id, text FROM benchmark WHERE item_id = 0")},
        products AS (
            SELECT d.id, sum(d.value * q.value) AS dot
            FROM document_counts d JOIN query_counts q ON q.bucket = d.bucket GROUP BY d.id
        )
        SELECT d.doc_id::VARCHAR AS "ID", d.text AS "TEXT",
            round(coalesce(p.dot, 0), 6)::DOUBLE AS "SCORE", b.text AS "QUERY"
        FROM documents d JOIN benchmark b ON b.item_id = 0 LEFT JOIN products p ON p.id = d.doc_id
        ORDER BY "SCORE" DESC, "ID" LIMIT 10
    """,
    "score_filter": topk("Cosine", 50, 0, '"ID", "SCORE"') + ' WHERE "SCORE" > 0.2',
    "result_contract": f"""
        SELECT 'documents' AS collection,
            CASE WHEN lang <> 'fr' THEN d.doc_id::VARCHAR
                 WHEN source <> 'src3' THEN {uuid5("d.doc_id::VARCHAR")} ELSE '' END AS "ID",
            CASE WHEN lang <> 'de' THEN text ELSE '' END AS "TEXT",
            coalesce(quality, 0)::DOUBLE AS "SCORE", source AS "QUERY"
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    """,
    "keyword_leg": f"{hashed_legs(10, _ITEMS)} SELECT query_id::VARCHAR AS query_key, leg, id, round(score, 6) + 0.0 AS score, rank FROM kept",
    "search_after_upserts": f"{hashed_hits(10)} SELECT * FROM hits",
    "vector_topk_cells": " UNION ALL ".join(
        f"""SELECT '{metric}' AS metric, "ID" AS id, "SCORE" AS score FROM ({topk(metric, 10)})""" for metric in _SCORES
    ),
    "rrf_fusion": f"{hashed_legs(10, _ITEMS)} SELECT query_id::VARCHAR AS query_key, id, round(score, 9) AS score FROM fused",
    "rrf_fusion_deep": f"{hashed_legs(5000, _ONE_ITEM)} SELECT id, round(score, 9) AS score FROM fused ORDER BY fused.score DESC, id LIMIT 5000",
    "hybrid_search": f"{hashed_hits(10)} SELECT * FROM hits",
    "vector_topk_small_norm": " UNION ALL ".join(
        f"""
        SELECT '{metric}' AS metric, id AS "ID" FROM (
            SELECT *, {score} AS s
            FROM (SELECT vec_id::VARCHAR AS id, {_SMALL} AS v FROM embeddings), (SELECT {_SMALL} AS qv FROM embeddings WHERE vec_id = 7)
            ORDER BY {cut("s")} {direction}, id LIMIT 50)
        """
        for metric, (score, direction) in {
            "Dot": ("list_inner_product(v, qv)", "DESC"), "Euclid": _SCORES["Euclid"]}.items()
    ),
    "search_dirty_points": f"""
        WITH raw AS (
            SELECT CASE WHEN d.doc_id % 10 = 3 THEN NULL WHEN d.doc_id % 10 = 4 THEN d.doc_id - 1 ELSE d.doc_id END::VARCHAR AS given,
                d.text, d.doc_id, e.embedding::DOUBLE[] AS v, d.doc_id % 7 AS damage
            FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id),
        named AS (SELECT *, coalesce(given, {uuid5("text")}) AS id FROM raw),
        one AS (
            SELECT id, arg_min(struct_pack(v := v, damage := damage), struct_pack(text := text, doc_id := doc_id)) AS p FROM named GROUP BY id)
        SELECT id AS "ID", round(list_cosine_similarity(p.v, qv), 6) AS "SCORE"
        FROM one, (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 7)
        WHERE p.damage NOT IN (1, 2)
        ORDER BY {cut("list_cosine_similarity(p.v, qv)")} DESC, id LIMIT 40
    """,
    "hybrid_fallback": topk("Cosine", 12),
    "batch_hybrid": f"""
        {hashed_legs(10, _ITEMS)}
        SELECT f.query_id, f.id AS "ID", p.text AS "TEXT", round(f.score, 9) AS "SCORE", a.query AS "QUERY"
        FROM (
            FROM fused QUALIFY row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, id) <= 10
        ) f JOIN points p ON p.id = f.id JOIN asked a ON a.query_id = f.query_id
    """,
    "batch_hybrid_turns": f"""
        {hashed_legs(3, f"SELECT id, max(text) AS text FROM ({_TURNS}) GROUP BY id")}
        SELECT query_id, id AS "ID", round(score, 9) AS "SCORE"
        FROM fused QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 3
    """,
    "sql_table_function": f"""
        {hashed_legs(20, _ONE_ITEM)}
        SELECT f.id AS "ID", d.lang, d.source, round(f.score, 9) AS "SCORE", a.query AS "QUERY"
        FROM (FROM fused ORDER BY score DESC, id LIMIT 20) f
        JOIN documents d ON d.doc_id::VARCHAR = f.id JOIN asked a ON a.query_id = f.query_id
        WHERE f.score > 0.01
    """,
    "join_metadata": f"""
        {hashed_hits(25)}
        SELECT h."ID", d.lang, d.source, h."SCORE"
        FROM hits h JOIN documents d ON d.doc_id::VARCHAR = h."ID"
    """,
    "join_fact": f"""
        {hashed_hits(25)}
        SELECT e.event_id, e.user_id, e.event_type, h."ID", h."SCORE"
        FROM hits h JOIN events e ON e.user_id::VARCHAR = h."ID"
    """,
    "extract_keywords": f"""
        WITH RECURSIVE {keywords('''
            SELECT 'item-' || item_id AS id, text FROM benchmark UNION ALL
            SELECT 'turn-' || conv_id || '-' || turn, text FROM conversations
        ''')}
        SELECT id, array_to_string(keywords, ' ') AS keywords FROM extracted
    """,
    "extract_keywords_uncapped": f"""
        WITH RECURSIVE {keywords('''
            SELECT 'item-' || item_id AS id, text FROM benchmark UNION ALL
            SELECT 'turn-' || conv_id || '-' || turn, text FROM conversations
        ''', None)}
        SELECT id, array_to_string(keywords, ' ') AS keywords FROM extracted
    """,
    "text_index_postings": f"""
        SELECT token, count(*) AS documents
        FROM (SELECT unnest({tokens("text")}) AS token FROM documents) GROUP BY token
    """,
    "hash_embed": f"""
        WITH {hashed_counts("counts", "SELECT doc_id AS id, text FROM documents")},
        {unit_values("units", "counts")}
        SELECT id AS doc_id, bucket, round(value::DOUBLE, 6) AS value FROM units
    """,
    "batch_embed": f"""
        WITH {hashed_counts("counts", "SELECT doc_id AS id, substr(text, 1, 6000) AS text FROM documents")},
        {unit_values("units", "counts")}
        SELECT id AS doc_id, bucket, round(value::DOUBLE, 6) AS value FROM units
    """,
    "batch_embed_whole_text": f"""
        WITH {hashed_counts("counts", "SELECT doc_id AS id, text FROM documents")},
        {unit_values("units", "counts")}
        SELECT id AS doc_id, bucket, round(value::DOUBLE, 6) AS value FROM units
    """,
    "point_id_uuid5": f"""
        SELECT c_custkey, c_name, {uuid5("c_name")} AS point_id FROM customer
    """,
    "ingest_clean": """
        SELECT doc_id::VARCHAR AS original_id,
            CASE WHEN lang <> 'es' THEN text ELSE '' END AS text
        FROM documents WHERE source <> 'src3' AND lang <> 'de'
    """,
    "ingest_truncate": """
        SELECT doc_id, length(text) AS stored_chars, substr(text, 1, 6000) AS model_text
        FROM documents
    """,
    "ingest_concat_text": """
        SELECT p_partkey::VARCHAR AS original_id,
            p_name || ' by ' || p_brand || ', ' || p_type || ', size ' || p_size AS text
        FROM part
    """,
    "dimension_check": """
        SELECT count(*) FILTER (len(embedding[1:64 - label]) = 64) AS fitting,
            count(*) FILTER (len(embedding[1:64 - label]) <> 64) AS not_fitting
        FROM embeddings
    """,
    "ingest_documents": f"""
        SELECT {uuid5("doc_id::VARCHAR")} AS point_id, doc_id::VARCHAR AS id, text,
            len({tokens("text")}) AS n_tokens
        FROM documents
    """,
    "ingest_summary": f"""
        SELECT ('0x' || substr({digest("lang || '-' || n_chars")}, 1, 1))::INTEGER AS partition_id,
            count(*) AS upserted_count
        FROM documents GROUP BY 1
    """,
    "upsert_last_wins": f"""
        WITH {_DELIVERIES}
        SELECT f.id, coalesce(s.seq, o.seq) AS seq, coalesce(s.text, f.text) AS text
        FROM first_load f LEFT JOIN second_load s ON s.id = f.id
        JOIN (SELECT lang || '-' || n_chars AS id, max(doc_id) AS seq FROM documents GROUP BY 1) o
          ON o.id = f.id
    """,
    "stream_ingest": f"""
        WITH {_DELIVERIES}
        SELECT f.id, coalesce(s.text, f.text) AS text
        FROM first_load f LEFT JOIN second_load s ON s.id = f.id
    """,
    "create_collections": """
        WITH requests AS (
            SELECT doc_id AS seq, n_chars,
                CASE WHEN source = 'src9' THEN 'S' ELSE 's' END || substr(source, 2) || '_' || lang
                    AS name,
                source || '_' || lang AS key,
                CASE WHEN source = 'src4' THEN 'L2_norm' WHEN lang = 'fr' THEN 'Dot'
                     ELSE 'Cosine' END AS distance,
                CASE lang WHEN 'en' THEN 'nomic-embed-text' WHEN 'de' THEN 'all-MiniLM-L6-v2'
                     WHEN 'fr' THEN 'no-such-model' ELSE '' END AS model_name
            FROM documents
        ),
        sized AS (
            SELECT *, (CASE WHEN n_chars > 1000 THEN 64
                WHEN model_name = 'nomic-embed-text' THEN 768
                WHEN model_name = 'all-MiniLM-L6-v2' THEN 384 END)::INTEGER AS vector_size
            FROM requests
        ),
        judged AS (
            SELECT *, CASE WHEN distance = 'L2_norm' THEN 'error: invalid distance'
                WHEN vector_size IS NULL AND model_name = ''
                THEN 'error: no vector_size and no model_name'
                WHEN vector_size IS NULL
                THEN 'error: unknown model and no explicit vector_size' END AS problem
            FROM sized
        ),
        registered AS (
            SELECT DISTINCT source || '_' || lang AS key FROM documents
            WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
        ),
        firsts AS (SELECT key, min(seq) AS seq FROM judged WHERE problem IS NULL GROUP BY key)
        SELECT j.seq, j.name, j.vector_size, j.distance, j.model_name,
            CASE WHEN j.problem IS NOT NULL THEN j.problem
                 WHEN r.key IS NOT NULL AND r.key <> j.name
                 THEN 'error: name differs only by case'
                 WHEN r.key IS NULL AND j.seq = f.seq THEN 'created: ' || j.name
                 ELSE 'exists: ' || j.name END AS status
        FROM judged j LEFT JOIN registered r ON r.key = j.key LEFT JOIN firsts f ON f.key = j.key
    """,
    "list_collections": f"""
        SELECT upper(source) AS table_name, position, column_name, data_type
        FROM (SELECT DISTINCT source FROM documents), {_COLUMNS}
    """,
    "collection_filter": f"""
        SELECT upper(name) AS table_name, position, column_name, data_type
        FROM (SELECT DISTINCT source || '_' || lang AS name FROM documents), {_COLUMNS}
        WHERE name LIKE 'src1%\\_en' ESCAPE '\\' OR name LIKE 'src_\\_fr' ESCAPE '\\'
           OR name = 'src5_de'
    """,
    "collection_health": f"""
        WITH names AS (SELECT DISTINCT source AS name FROM documents),
        good AS (
            SELECT vec_id::VARCHAR AS id, coalesce(text, '') AS text, embedding AS v
            FROM embeddings LEFT JOIN documents ON doc_id = vec_id
        ),
        bad AS (
            SELECT CASE WHEN length(text) > 500 THEN id END AS id,
                CASE WHEN length(text) < 9000 THEN v[1:63] END AS v
            FROM (FROM good UNION ALL FROM good)
        )
        SELECT collection, r.place, r."check" AS "check",
            CASE WHEN r.ok THEN 'PASS' ELSE 'FAIL' END AS status, r.detail
        FROM ({health("src1", "good")} UNION ALL {health("missing", "bad")})
    """,
}
ORACLE_SQL["collection_health_sketch"] = """
    WITH again AS (SELECT doc_id IN (SELECT doc_id FROM labels) AS twice, coalesce(text, '') AS text FROM documents)
    SELECT count(*) + count_if(twice)::BIGINT AS points, count_if(twice)::BIGINT AS replaced,
        0::BIGINT AS no_id, 0::BIGINT AS no_vector, 0::BIGINT AS wrong_size,
        sum(strlen(text) * (1 + twice::INT))::BIGINT AS text_bytes, max(length(text))::BIGINT AS longest,
        true AS distinct_near, 'PASS' AS status
    FROM again
"""
ORACLE_SQL["keyword_leg_postings"] = ORACLE_SQL["keyword_leg"]
ORACLE_SQL["sql_search_many"] = ORACLE_SQL["batch_hybrid"]
ORACLE_SQL["ingest_by_cost"] = ORACLE_SQL["ingest_documents"]
