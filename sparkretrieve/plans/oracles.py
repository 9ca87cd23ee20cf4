"""DuckDB SQL oracles, one per registered query, over the driver tables.

These restate each operator's rules in plain SQL on the raw tables, so the
driver can compare them with the Spark plans value by value. They are test
oracles only; the library never runs them.
"""

from __future__ import annotations

TOP_K = 10
TOKEN_RE = "[A-Za-z0-9_.$:/-]+"
WHITESPACE_RE = (r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WHITESPACE_RE}+|{WHITESPACE_RE}+$', '', 'g')"

def _split_ctes(size: int, overlap: int) -> str:
    """The recursive character split in SQL, over positions in the text: split(document_id,
    chunk_index, text). Level k cuts the spans that hold separator k; spans of at
    least ``size`` go on to the next level, runs of shorter ones are merged. A
    window of pieces that begins at b is emitted before the first piece that
    ends beyond b + size; the next begins at the first piece within the overlap
    that leaves room for that one."""
    levels = ["""
n0 AS (SELECT document_id, 0::BIGINT AS s, text AS t FROM docs WHERE text <> '')"""]
    separators = ("chr(10)||chr(10)", "chr(10)", "'. '", "' '", "''")
    for k, sep in enumerate(separators):
        has = "TRUE" if k == 4 else f"contains(t, {sep})"
        levels.append(f"""
c{k} AS MATERIALIZED (
  SELECT document_id, s, j, pos, n, p, sum((n >= {size})::INT) OVER (PARTITION BY document_id, s ORDER BY j) AS longs
  FROM (SELECT document_id, s, j, p, length(p) AS n,
               s + coalesce(sum(length(p)) OVER (PARTITION BY document_id, s ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
        FROM (SELECT document_id, s, j, CASE WHEN j > 1 THEN {sep} || x ELSE x END AS p
              FROM (SELECT document_id, s, unnest(string_split(t, {sep})) AS x, generate_subscripts(string_split(t, {sep}), 1) AS j
                    FROM n{k} WHERE {has})))
  WHERE n > 0)""")
        if k < 4:
            levels.append(f"""
n{k + 1} AS MATERIALIZED (
  SELECT document_id, s, t FROM n{k} WHERE NOT contains(t, {sep})
  UNION ALL SELECT document_id, pos AS s, p AS t FROM c{k} WHERE n >= {size})""")
    pieces = " UNION ALL ".join(f"SELECT document_id || '|{k}|' || s || '|' || longs AS g, document_id, pos, pos + n AS e FROM c{k} WHERE n < {size}"
                                for k in range(5))
    return "," + ",".join(levels) + f""",
pieces AS MATERIALIZED ({pieces}),
runs AS (SELECT g, document_id, min(pos) AS first, max(e) AS last FROM pieces GROUP BY g, document_id),
stops AS (
  SELECT b.g, b.pos AS b, e.pos AS stop, least(e.pos, greatest(e.pos - {overlap}, e.e - {size})) AS since
  FROM (SELECT g, pos, pos + {size} AS reach FROM pieces) b ASOF JOIN pieces e ON b.g = e.g AND b.reach < e.e),
steps AS MATERIALIZED (SELECT x.g, x.b, x.stop, p.pos AS again FROM stops x ASOF JOIN pieces p ON x.g = p.g AND x.since <= p.pos),
walk AS (
  SELECT g, first AS b FROM runs
  UNION ALL SELECT w.g, n.again AS b FROM walk w JOIN steps n ON n.g = w.g AND n.b = w.b),
parts AS (
  SELECT r.document_id, w.b, {_strip("substring(d.text, w.b + 1, coalesce(n.stop, r.last) - w.b)")} AS text
  FROM walk w JOIN runs r ON r.g = w.g LEFT JOIN steps n ON n.g = w.g AND n.b = w.b JOIN docs d ON d.document_id = r.document_id),
split AS MATERIALIZED (
  SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY b) - 1 AS chunk_index, text
  FROM parts WHERE text <> '')"""


DOCS = """
docs AS (
  SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS document_id, source,
         CAST(doc_id AS VARCHAR) AS source_id,
         split_part(text, chr(10), 1) AS title,
         '1' AS version, '' AS updated_at, coalesce(text, '') AS text, lang, n_chars
  FROM documents)"""

CHUNKS = DOCS + """,
chunks AS (
  SELECT document_id || '_chunk_0' AS chunk_id, document_id, source, source_id, title,
         0 AS chunk_index, text
  FROM docs)"""

# The splitter's chunks (1200/200) in the place of whole documents.
SPLIT = DOCS + _split_ctes(1200, 200)
REAL_CHUNKS = SPLIT + """,
chunks AS MATERIALIZED (
  SELECT document_id || '_chunk_' || s.chunk_index AS chunk_id, document_id, d.source, d.source_id, d.title,
         s.chunk_index, s.text
  FROM split s JOIN docs d USING (document_id))"""


def _over_real_chunks(ctes: str) -> str:
    return ctes.replace(CHUNKS, REAL_CHUNKS)


CTOKS = CHUNKS + f""",
ctoks AS (
  SELECT chunk_id, list_transform(regexp_extract_all(text, '{TOKEN_RE}'), lambda t: lower(t)) AS toks
  FROM chunks)"""

BM25_INDEX = CTOKS + """,
cstats AS (SELECT count(*) AS n, CAST(coalesce(sum(len(toks)), 0) AS BIGINT) AS total FROM ctoks),
post AS (
  SELECT term, chunk_id, dl, count(*) AS tf
  FROM (SELECT chunk_id, len(toks) AS dl, unnest(toks) AS term FROM ctoks)
  GROUP BY term, chunk_id, dl),
dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term),
raw AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw_idf FROM dfs, cstats),
mean AS (SELECT avg(raw_idf) AS mean_idf FROM raw),
idf AS (
  SELECT term, df, CASE WHEN raw_idf < 0 THEN 0.25 * mean_idf ELSE raw_idf END AS idf
  FROM raw, mean)"""

QTERMS = f""",
qterms AS (
  SELECT query_id, term, count(*) AS qf
  FROM (SELECT item_id AS query_id,
               unnest(list_transform(regexp_extract_all(text, '{TOKEN_RE}'), lambda t: lower(t))) AS term
        FROM benchmark)
  GROUP BY query_id, term)"""

BM25_MATCH = BM25_INDEX + QTERMS + """,
matches AS (
  SELECT q.query_id, p.chunk_id,
         sum(q.qf * i.idf * p.tf * 2.5
             / (p.tf + 1.5 * (0.25 + 0.75 * p.dl / (c.total::DOUBLE / c.n)))) AS score,
         count(*) AS overlap
  FROM qterms q JOIN post p ON p.term = q.term JOIN idf i ON i.term = q.term, cstats c
  GROUP BY q.query_id, p.chunk_id)"""

BM25_RANKED = BM25_MATCH + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id
                               ORDER BY round(score, 9) DESC, overlap DESC, chunk_id) AS rank
  FROM matches)"""


def _with(ctes: str, body: str) -> str:
    return ("WITH RECURSIVE " if "walk AS" in ctes else "WITH ") + ctes.strip() + "\n" + body.strip()


def _hash_cells(name: str, source: str) -> str:
    """Hashing-encoder vectors (64 buckets) as sparse (record_id, dim, value)
    rows, float32-rounded like the stored vectors. ``source`` yields (record_id, text)."""
    return f""",
{name}_tok AS (
  SELECT record_id, lower(t) AS term
  FROM (SELECT record_id, unnest(regexp_extract_all(text, '{TOKEN_RE}')) AS t FROM ({source}))),
{name}_cnt AS (
  SELECT record_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS dim,
         sum(CASE WHEN ('0x' || substr(md5(term), 9, 1))::INT % 2 = 0 THEN 1 ELSE -1 END) AS c
  FROM {name}_tok GROUP BY ALL),
{name}_nrm AS (SELECT record_id, sqrt(sum(c * c)) AS nrm FROM {name}_cnt GROUP BY record_id),
{name} AS (
  SELECT record_id, dim, ((c / nrm)::FLOAT)::DOUBLE AS value
  FROM {name}_cnt JOIN {name}_nrm USING (record_id) WHERE c <> 0)"""


EMB = """
ev AS (SELECT 'doc_' || CAST(vec_id AS VARCHAR) || '_chunk_0' AS record_id, vec_id,
              CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""

# Benchmark texts as dense 64-dimensional vectors, against all embeddings.
QUERY_VECTORS = EMB + _hash_cells("qv", f"SELECT item_id AS record_id, text FROM benchmark WHERE {_strip('text')} <> ''") + f""",
qd AS (SELECT b.item_id AS query_id,
              list_transform(range(0, 64), lambda i: coalesce(list_extract(list_filter(
                list_zip(dims, vals), lambda z: z[1] = i), 1)[2], 0.0::DOUBLE)) AS v
       FROM benchmark b LEFT JOIN (SELECT record_id, list(dim) AS dims, list(value) AS vals FROM qv GROUP BY 1) x
         ON x.record_id = b.item_id
       WHERE {_strip('b.text')} <> '')"""

KNN_SCORE = {
    "cosine": """CASE WHEN list_dot_product(q.v, q.v) = 0 OR list_dot_product(e.v, e.v) = 0 THEN 0.0
         ELSE list_dot_product(q.v, e.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(e.v, e.v)))
         END""",
    "ip": "list_dot_product(q.v, e.v)",
    "l2": "-list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - e.v[i]) * (q.v[i] - e.v[i])))",
}


def _knn_ctes(metric: str, only: str = "") -> str:
    return f""",
pairs AS (SELECT q.query_id, e.record_id, {KNN_SCORE[metric]} AS score FROM qd q, ev e{only}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, record_id) AS rank
           FROM pairs)"""


_KNN_ROWS = f"SELECT query_id, rank, record_id, round(score, 6) AS score FROM ranked WHERE rank <= {TOP_K}"

# IVF over fixed cells: the vectors of the eight smallest ids are the centroids.
IVF_CELLS = QUERY_VECTORS + """,
cents AS (SELECT row_number() OVER (ORDER BY vec_id) AS cell, v FROM ev ORDER BY vec_id LIMIT 8),
cell_of AS (SELECT e.record_id, arg_max(c.cell, list_cosine_similarity(e.v, c.v)) AS cell
            FROM ev e, cents c GROUP BY e.record_id),
probes AS (SELECT q.query_id, c.cell, row_number() OVER (
             PARTITION BY q.query_id ORDER BY list_cosine_similarity(q.v, c.v) DESC, c.cell) AS turn
           FROM qd q, cents c)"""


def _probed(nprobe: int) -> str:
    return f""" JOIN cell_of USING (record_id)
  WHERE EXISTS (SELECT 1 FROM probes p WHERE p.query_id = q.query_id AND p.cell = cell_of.cell AND turn <= {nprobe})"""


SEM_CTES = (_hash_cells("dv", "SELECT chunk_id AS record_id, text FROM chunks")
            + _hash_cells("qv", f"SELECT item_id AS record_id, text FROM benchmark WHERE {_strip('text')} <> ''")
            + f""",
dn AS (SELECT record_id, sqrt(sum(value * value)) AS n FROM dv GROUP BY record_id),
qn AS (SELECT record_id, sqrt(sum(value * value)) AS n FROM qv GROUP BY record_id),
dots AS (SELECT q.record_id AS query_id, d.record_id, sum(q.value * d.value) AS dot
         FROM qv q JOIN dv d ON d.dim = q.dim GROUP BY ALL),
pairs AS (
  SELECT b.item_id AS query_id, c.chunk_id AS record_id,
         CASE WHEN coalesce(qn.n, 0) = 0 OR coalesce(dn.n, 0) = 0 THEN 0.0
              ELSE coalesce(dots.dot, 0.0) / (qn.n * dn.n) END AS score
  FROM (SELECT item_id FROM benchmark WHERE {_strip('text')} <> '') b CROSS JOIN chunks c
  LEFT JOIN qn ON qn.record_id = b.item_id LEFT JOIN dn ON dn.record_id = c.chunk_id
  LEFT JOIN dots ON dots.query_id = b.item_id AND dots.record_id = c.chunk_id),
sranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, record_id) AS rank
            FROM pairs)""")
SEMANTIC = CHUNKS + SEM_CTES

FUSION = """,
lex AS (SELECT query_id, chunk_id, rank, score FROM ranked WHERE rank <= 50),
sem AS (SELECT query_id, record_id AS chunk_id, rank, score FROM sranked
        WHERE rank <= 50 AND record_id IN (SELECT chunk_id FROM chunks)),
lexagg AS (SELECT query_id, chunk_id, sum(1.0::DOUBLE / (60 + rank)) AS bf, max(rank) AS bm25_rank,
                  arg_max(score, rank) AS bm25_score, min(rank) AS bfirst FROM lex GROUP BY ALL),
semagg AS (SELECT query_id, chunk_id, sum(1.0::DOUBLE / (60 + rank)) AS sf, max(rank) AS semantic_rank,
                  arg_max(score, rank) AS semantic_score, min(rank) AS sfirst FROM sem GROUP BY ALL),
merged AS (
  SELECT coalesce(l.query_id, s.query_id) AS query_id, coalesce(l.chunk_id, s.chunk_id) AS chunk_id,
         coalesce(bf, 0.0) + coalesce(sf, 0.0) AS fused_score, bm25_score, semantic_score,
         bm25_rank, semantic_rank, bfirst, sfirst,
         CASE WHEN bm25_rank IS NOT NULL AND semantic_rank IS NOT NULL THEN 'bm25,semantic'
              WHEN bm25_rank IS NOT NULL THEN 'bm25' ELSE 'semantic' END AS matched_by
  FROM lexagg l FULL OUTER JOIN semagg s ON l.query_id = s.query_id AND l.chunk_id = s.chunk_id),
fused AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(fused_score, 12) DESC,
                               bfirst NULLS LAST, sfirst NULLS LAST) AS rank
  FROM merged)"""

HYBRID = BM25_RANKED + SEM_CTES + FUSION

# The semantic leg over embeddings whose chunk ids partly do not exist.
HYBRID_UNKNOWN = (BM25_RANKED + "," + QUERY_VECTORS.replace("CAST(vec_id AS VARCHAR)", "CAST(vec_id * 3 AS VARCHAR)")
                  + _knn_ctes("cosine").replace("ranked AS", "sranked AS") + FUSION)

HYBRID_ROWS = f"""
SELECT f.query_id, f.rank, f.chunk_id, c.document_id, round(f.fused_score, 9) AS fused_score,
       round(f.bm25_score, 6) AS bm25_score, round(f.semantic_score, 6) AS semantic_score,
       f.bm25_rank, f.semantic_rank, f.matched_by
FROM fused f JOIN chunks c ON c.chunk_id = f.chunk_id
WHERE f.rank <= {TOP_K}"""

CASES = """,
cases AS (
  SELECT b.item_id AS case_id, b.text AS query, 'doc_' || CAST(min(d.doc_id) AS VARCHAR) AS expected_document_id
  FROM benchmark b JOIN documents d ON contains(d.text, b.text)
  GROUP BY b.item_id, b.text)"""


def _eval(results_cte: str) -> str:
    """Per-case evaluation over ``res(case_id, rank, chunk_id, document_id)``."""
    return results_cte + """,
ev AS (
  SELECT k.case_id, k.query, k.expected_document_id,
         min(r.rank) FILTER (WHERE r.document_id = k.expected_document_id) AS matched_rank,
         arg_min(r.chunk_id, r.rank) FILTER (WHERE r.document_id = k.expected_document_id) AS matched_chunk_id,
         count(r.rank) AS n_results
  FROM cases k LEFT JOIN res r ON r.case_id = k.case_id
  GROUP BY ALL)"""


EVAL_BM25 = BM25_RANKED + CASES + _eval(""",
res AS (SELECT r.query_id AS case_id, r.rank, r.chunk_id, c.document_id, c.title, r.score
        FROM ranked r JOIN chunks c ON c.chunk_id = r.chunk_id WHERE r.rank <= 5)""")

EVAL_HYBRID = HYBRID + CASES + _eval(""",
res AS (SELECT f.query_id AS case_id, f.rank, f.chunk_id, c.document_id
        FROM fused f JOIN chunks c ON c.chunk_id = f.chunk_id WHERE f.rank <= 5)""")

EVAL_ROWS = """
SELECT case_id, matched_rank IS NOT NULL AS hit,
       CASE WHEN matched_rank IS NOT NULL THEN expected_document_id END AS matched_document_id,
       matched_chunk_id, matched_rank, n_results
FROM ev"""


ORACLES: dict[str, str] = {
    "canonical_documents": _with(DOCS, """
SELECT document_id, source, source_id, title, version, updated_at, text,
       'lang=' || lang || ';n_chars=' || CAST(n_chars AS VARCHAR) AS metadata
FROM docs"""),
    "tokenize_terms": _with(CTOKS, """
SELECT chunk_id, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, ' ') AS tokens
FROM ctoks"""),
    "bm25_stats": _with(BM25_INDEX, """
SELECT CAST(n AS BIGINT) AS n_chunks, total AS total_tokens, round(total::DOUBLE / n, 6) AS avgdl,
       (SELECT count(*) FROM dfs) AS vocabulary, round(mean_idf, 9) AS mean_idf
FROM cstats, mean"""),
    "bm25_idf": _with(BM25_INDEX, """
SELECT term, df, round(idf, 9) AS idf FROM idf"""),
    "bm25_match": _with(BM25_MATCH, """
SELECT query_id, count(*) AS matches, round(min(score), 6) AS lowest, round(max(score), 6) AS highest,
       max(overlap) AS most_overlap
FROM matches GROUP BY query_id"""),
    "bm25_topk": _with(BM25_RANKED, f"""
SELECT r.query_id, r.rank, r.chunk_id, c.document_id, c.title, round(r.score, 6) AS score,
       r.overlap, substring(c.text, 1, 700) AS preview
FROM ranked r JOIN chunks c ON c.chunk_id = r.chunk_id
WHERE r.rank <= {TOP_K}"""),
    "chunk_lossless": _with(DOCS, f"""
SELECT document_id, md5(regexp_replace(text, '{WHITESPACE_RE}', '', 'g')) AS digest,
       TRUE AS within_size
FROM docs"""),
}
ORACLES["chunk_lossless_small"] = ORACLES["chunk_lossless"]

ORACLES.update({
    "metadata_flatten": _with(DOCS, """
SELECT document_id,
       'document_id=' || document_id || ';lang=' || lang || ';n_chars=' || CAST(n_chars AS VARCHAR)
       || ';source=' || source || ';source_id=' || source_id || ';title=' || title
       || ';updated_at=' || updated_at || ';version=' || version AS metadata
FROM docs"""),
    "embedding_request": _with(CHUNKS, """
SELECT c.chunk_id AS record_id, c.text,
       'chunk_id=' || c.chunk_id || ';chunk_index=0;document_id=' || c.document_id
       || ';lang=' || d.lang || ';n_chars=' || CAST(d.n_chars AS VARCHAR)
       || ';source=' || c.source || ';source_id=' || c.source_id || ';title=' || c.title
       || ';updated_at=;version=1' AS metadata
FROM chunks c JOIN docs d ON d.document_id = c.document_id"""),
    "safe_record_id": """
SELECT page_id, url, translate(url, ':/\\', '___') AS safe_id FROM pages""".strip(),
    "hash_embed": _with(CHUNKS + _hash_cells("dv", "SELECT chunk_id AS record_id, text FROM chunks"), """
SELECT record_id, CAST(dim AS BIGINT) AS dim, round(value, 6) AS value FROM dv"""),
    "embedding_manifest": _with(CHUNKS, """
SELECT chunk_id AS record_id, chunk_id, document_id, 'hashing' AS provider, 'md5-bucket-64' AS model,
       CAST(64 AS BIGINT) AS dimensions,
       'embeddings/' || translate(chunk_id, ':/\\', '___') || '.json' AS output_path
FROM chunks"""),
    "vector_validate": _with(EMB, """
SELECT record_id, CAST(len(v) AS BIGINT) AS n_dims,
       CASE WHEN v IS NULL OR len(v) = 0 THEN 'embedding record vector must be a non-empty list'
            WHEN len(v) <> 64 THEN 'expected vector dimension 64, got ' || CAST(len(v) AS VARCHAR)
                                   || ' for record_id=' || record_id
            WHEN count(*) OVER (PARTITION BY record_id) > 1 THEN 'duplicate vector record_id: ' || record_id
            ELSE 'valid' END AS status
FROM ev"""),
    "vector_reject": """
WITH spoilt AS (
  SELECT CASE vec_id % 10 WHEN 2 THEN chr(9) WHEN 6 THEN 'dup_' || (vec_id // 20) ELSE 'rec_' || vec_id END AS record_id,
         CASE vec_id % 10 WHEN 1 THEN 0 WHEN 5 THEN 63 ELSE 64 END::BIGINT AS n_dims, vec_id % 10 AS digit
  FROM embeddings)
SELECT record_id, n_dims,
       CASE digit WHEN 1 THEN 'embedding record vector must be a non-empty list'
                  WHEN 2 THEN 'embedding record record_id must be a non-empty string'
                  WHEN 3 THEN 'embedding record chunk_id must be a non-empty string'
                  WHEN 4 THEN 'embedding record document_id must be a non-empty string'
                  WHEN 5 THEN 'expected vector dimension 64, got 63 for record_id=' || record_id
                  ELSE CASE WHEN count(*) OVER (PARTITION BY record_id) > 1
                            THEN 'duplicate vector record_id: ' || record_id ELSE 'valid' END END AS status
FROM spoilt""".strip(),
    "index_info": """
SELECT 'exact' AS name, CAST(max(len(embedding)) AS BIGINT) AS dimensions, 'cosine' AS metric,
       count(*) AS records_count
FROM embeddings""".strip(),
    "knn_cosine": _with(QUERY_VECTORS + _knn_ctes("cosine"), _KNN_ROWS),
    "knn_l2": _with(QUERY_VECTORS + _knn_ctes("l2"), _KNN_ROWS),
    "knn_ip": _with(QUERY_VECTORS + _knn_ctes("ip"), _KNN_ROWS),
    "semantic_search": _with(SEMANTIC, f"""
SELECT r.query_id, r.rank, r.record_id AS chunk_id, c.document_id, round(r.score, 6) AS score
FROM sranked r JOIN chunks c ON c.chunk_id = r.record_id
WHERE r.rank <= {TOP_K}"""),
    "hybrid_rrf": _with(HYBRID, HYBRID_ROWS),
    "hybrid_ivf": _with(HYBRID, HYBRID_ROWS),
    "hybrid_drop_unknown": _with(HYBRID_UNKNOWN, HYBRID_ROWS),
    "hybrid_matched_by": _with(HYBRID, """
SELECT query_id, chunk_id, round(fused_score, 9) AS fused_score, matched_by FROM merged"""),
    "eval_cases": _with(DOCS + CASES, """
SELECT case_id, query, expected_document_id FROM cases"""),
    "eval_hit_at_k": _with(EVAL_BM25, EVAL_ROWS),
    "eval_summary": _with(EVAL_BM25, """
SELECT count(*) AS total_cases, count(matched_rank) AS hits, count(*) - count(matched_rank) AS misses,
       round(CASE WHEN count(*) > 0 THEN count(matched_rank) / count(*) ELSE 0.0 END, 6) AS hit_rate
FROM ev"""),
    "eval_misses": _with(EVAL_BM25, """
SELECT ev.case_id, ev.expected_document_id,
       coalesce((SELECT string_agg(printf('%s | %s | %s | score=%.4f', r.document_id, r.chunk_id, r.title, r.score),
                                   chr(10) ORDER BY r.rank)
                 FROM res r WHERE r.case_id = ev.case_id AND r.rank <= 3), 'no results') AS retrieved
FROM ev WHERE ev.matched_rank IS NULL"""),
    "eval_hybrid": _with(EVAL_HYBRID, EVAL_ROWS),
})

PAGES = """
pages_src AS (
  SELECT split_part(text, chr(10), 1) AS title, CAST(doc_id AS VARCHAR) AS page_id,
         CAST(n_chars AS VARCHAR) AS revision_id, '2024-04-15T14:38:04Z' AS timestamp, text
  FROM documents),
pages_ok AS (SELECT * FROM pages_src WHERE title <> '' AND page_id <> '' AND revision_id <> '')"""

ORACLES.update({
    "dump_page_parse": _with(PAGES, "SELECT title, page_id, revision_id, timestamp, text FROM pages_ok"),
    "ingest_manifest": _with(PAGES, """
SELECT 'wikipedia_' || page_id AS document_id, 'wikipedia' AS source, page_id AS source_id, title,
       revision_id AS version, timestamp AS updated_at,
       'canonical/wikipedia/wikipedia_' || page_id || '.json' AS output_path, 'saved' AS status
FROM pages_ok"""),
})
ORACLES.update({
    "chunk_documents": _with(REAL_CHUNKS, """
SELECT chunk_id, document_id, chunk_index, title, length(text) AS n_chars, md5(text) AS digest FROM chunks"""),
    "chunk_summary": _with(SPLIT, """
SELECT (SELECT count(*) FROM docs) AS documents_processed, (SELECT count(*) FROM split) AS chunks_saved"""),
    "chunk_manifest": _with(REAL_CHUNKS, """
SELECT document_id, chunk_id, 'chunks/' || chunk_id || '.json' AS output_path, 'saved' AS status FROM chunks"""),
    "bm25_chunk_search": _with(_over_real_chunks(BM25_RANKED), f"""
SELECT r.query_id, r.rank, r.chunk_id, c.document_id, round(r.score, 6) AS score, r.overlap
FROM ranked r JOIN chunks c ON c.chunk_id = r.chunk_id WHERE r.rank <= {TOP_K}"""),
    "eval_real_chunks": _with(_over_real_chunks(EVAL_HYBRID), EVAL_ROWS),
    "bm25_update": _with(BM25_RANKED, f"""
SELECT query_id, rank, chunk_id, round(score, 6) AS score, overlap, n AS n_chunks, (SELECT count(*) FROM idf) AS vocabulary
FROM ranked, cstats WHERE rank <= {TOP_K}"""),
    "stream_upsert": f"""
WITH d AS (
  SELECT 'doc_' || doc_id AS document_id, coalesce(text, '') AS old,
         CASE WHEN doc_id % 3 = 0 THEN substring(coalesce(text, ''), 1, length(coalesce(text, '')) // 2) ELSE coalesce(text, '') END AS new,
         doc_id % 2 = 0 OR doc_id % 10 = 1 AS early
  FROM documents)
SELECT document_id, md5(regexp_replace(new, '{WHITESPACE_RE}', '', 'g')) AS digest,
       ((early AND {_strip("old")} <> '')::INT + (NOT early OR old <> new)::INT)::BIGINT AS emitted
FROM d WHERE {_strip("new")} <> ''""",
    "page_validity": _with(PAGES, """
SELECT title, page_id, revision_id, timestamp, text FROM pages_ok WHERE page_id::BIGINT % 5 > 1"""),
    "ingest_upsert": _with(PAGES, """
SELECT 'wikipedia_' || page_id AS document_id, title, (revision_id::BIGINT + second)::VARCHAR AS version,
       md5(text) AS digest, (first + second)::BIGINT AS n_manifest
FROM (SELECT *, (page_id::BIGINT % 2 = 0 OR page_id::BIGINT % 10 = 1)::INT AS first,
             (page_id::BIGINT % 2 = 1 OR page_id::BIGINT % 10 = 2)::INT AS second FROM pages_ok)"""),
})
ORACLES["ann_full_probe"] = ORACLES["knn_cosine"]
ORACLES["ann_ivf"] = _with(IVF_CELLS + _knn_ctes("cosine", _probed(7)), _KNN_ROWS)
ORACLES["ann_recall"] = _with(IVF_CELLS + f""",
scored AS (SELECT q.query_id, e.record_id, {KNN_SCORE["cosine"]} AS score, turn
           FROM qd q, ev e JOIN cell_of USING (record_id) JOIN probes ON probes.cell = cell_of.cell
           WHERE probes.query_id = q.query_id),
widths AS (SELECT unnest([1, 2, 4, 7, 8])::BIGINT AS nprobe),
probed AS (SELECT nprobe, query_id, record_id, row_number() OVER (
             PARTITION BY nprobe, query_id ORDER BY round(score, 9) DESC, record_id) AS rank
           FROM scored, widths WHERE turn <= nprobe),
exact AS (SELECT query_id, record_id FROM probed WHERE nprobe = 8 AND rank <= 10)""", """
SELECT nprobe, count(e.query_id) AS found
FROM widths LEFT JOIN (SELECT * FROM probed WHERE rank <= 10) p USING (nprobe)
LEFT JOIN exact e ON e.query_id = p.query_id AND e.record_id = p.record_id
GROUP BY nprobe""")
ORACLES["stream_chunk"] = ORACLES["chunk_lossless"]
