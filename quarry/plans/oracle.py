"""DuckDB SQL equivalents of ``plans.catalog`` queries (tables pre-registered as
views).  Float constants are written ``1e0`` style so both engines read DOUBLE."""

from __future__ import annotations

TOKEN_RE = r"[\p{L}\p{N}_]+"

# Shared CTE fragments -------------------------------------------------------
CORPUS = """corpus AS (
  SELECT doc_id, 'documents' AS source, split_part(text, chr(10), 1) AS title,
         text AS content, text AS contents FROM documents)"""

DOC_TOKENS = f"""doc_tokens AS (
  SELECT doc_id, coalesce(regexp_extract_all(lower(coalesce(contents, content, '')), '{TOKEN_RE}'), []) AS toks
  FROM corpus)"""

BM25_INDEX = f"""{CORPUS},
{DOC_TOKENS},
doc_len AS (SELECT doc_id, len(toks)::BIGINT AS doc_len FROM doc_tokens),
postings AS (
  SELECT doc_id, token, count(*) AS tf
  FROM (SELECT doc_id, unnest(toks) AS token FROM doc_tokens) GROUP BY doc_id, token),
cstats AS (SELECT count(*) AS n_docs, sum(doc_len) AS n_tokens, sum(doc_len) / count(*) AS avgdl FROM doc_len),
dfreq AS (SELECT token, count(*) AS df FROM postings GROUP BY token),
idf_raw AS (SELECT token, df, ln(n_docs - df + 0.5e0) - ln(df + 0.5e0) AS idf_raw FROM dfreq, cstats),
avg_idf AS (SELECT avg(idf_raw) AS avg_idf, count(*) AS n_terms FROM idf_raw),
term_stats AS (
  SELECT token, df, CASE WHEN idf_raw < 0 THEN 0.25e0 * avg_idf ELSE idf_raw END AS idf
  FROM idf_raw, avg_idf)"""


def bm25_scores_cte(queries_sql: str, name: str = "bm25_scores") -> str:
    return f"""{name}_q AS (
  SELECT qid, token, count(*) AS qtf
  FROM (SELECT qid, unnest(coalesce(regexp_extract_all(lower(question), '{TOKEN_RE}'), [])) AS token
        FROM ({queries_sql}))
  GROUP BY qid, token),
{name} AS (
  SELECT q.qid, p.doc_id,
         sum(q.qtf * t.idf * p.tf * 2.5e0 / (p.tf + 1.5e0 * (0.25e0 + 0.75e0 * d.doc_len / c.avgdl))) AS score
  FROM {name}_q q JOIN term_stats t USING (token) JOIN postings p USING (token)
       JOIN doc_len d USING (doc_id) CROSS JOIN cstats c
  GROUP BY q.qid, p.doc_id)"""


BENCH_QUERIES = "SELECT item_id AS qid, text AS question FROM benchmark"


def topk_cte(name: str, src: str, k: int) -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT qid, doc_id, score,
           row_number() OVER (PARTITION BY qid ORDER BY round(score, 6) DESC, doc_id) AS rank
    FROM {src}) WHERE rank <= {k})"""


SQL: dict[str, str] = {}

SQL["bm25_topk"] = f"""WITH {BM25_INDEX},
{bm25_scores_cte(BENCH_QUERIES)},
{topk_cte('ranked', 'bm25_scores', 20)}
SELECT qid, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM ranked"""

SQL["bm25_appended"] = SQL["bm25_topk"]

# ---------------------------------------------------------------- building blocks
UNIFIED = """unified AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'documents' AS source, split_part(text, chr(10), 1) AS title,
         text AS content, text AS contents FROM documents
  UNION ALL
  SELECT 'page_' || CAST(page_id AS VARCHAR) AS doc_id, 'pages' AS source, url AS title,
         html AS content, url || ' ' || html AS contents FROM pages)"""

CONV_QUERIES = ("SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS qid, text AS question "
                "FROM conversations WHERE role = 'user'")


def hash_vectors_cte(name: str, src_sql: str, id_col: str, text_col: str, dim: int) -> str:
    """Dense, L2-normalized feature-hashing vectors as DOUBLE[] of width ``dim``."""
    return f"""{name}_tok AS (
  SELECT {id_col} AS vid, unnest(coalesce(regexp_extract_all(lower(coalesce(CAST({text_col} AS VARCHAR), '')), '{TOKEN_RE}'), [])) AS token
  FROM ({src_sql})),
{name}_h AS (SELECT vid, ('0x' || substr(md5(token), 1, 8))::BIGINT AS h FROM {name}_tok),
{name}_b AS (SELECT vid, (h % {dim})::INTEGER AS dim, sum(1e0 - 2e0 * ((h // {dim}) % 2)) AS v FROM {name}_h GROUP BY ALL),
{name}_grid AS (SELECT s.{id_col} AS vid, g.dim::INTEGER AS dim FROM ({src_sql}) s, range({dim}) g(dim)),
{name}_raw AS (
  SELECT g.vid, list(coalesce(b.v, 0e0) ORDER BY g.dim) AS e
  FROM {name}_grid g LEFT JOIN {name}_b b ON g.vid = b.vid AND g.dim = b.dim GROUP BY g.vid),
{name} AS (
  SELECT vid AS {id_col}, CASE WHEN nrm > 0 THEN list_transform(e, lambda x: x / nrm) ELSE e END AS v
  FROM (SELECT vid, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS nrm FROM {name}_raw))"""


def long_vectors_sql(name: str, id_col: str = "doc_id", nonzero: bool = True) -> str:
    cond = "WHERE value <> 0" if nonzero else ""
    return f"""SELECT {id_col} AS doc_id, dim, value FROM (
  SELECT {id_col}, (generate_subscripts(v, 1) - 1)::INTEGER AS dim, round(unnest(v), 6) AS value FROM {name}) {cond}"""


DOC_SRC = "SELECT doc_id, text AS contents FROM documents"
Q_SRC = "SELECT item_id AS qid, text AS question FROM benchmark"

NORM_EMB = """nv AS (
  SELECT vec_id AS doc_id, label, CASE WHEN nrm > 0 THEN list_transform(e, lambda x: x / nrm) ELSE e END AS v
  FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e,
               sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS nrm FROM embeddings))"""


def dense_pairs_cte(name: str, qvec: str, dvec: str, qid: str, exclude_self: bool = False) -> str:
    cond = "WHERE q.qid <> d.doc_id" if exclude_self else ""
    return f"""{name} AS (
  SELECT q.qid, d.doc_id, round(list_dot_product(q.v, d.v), 6) AS score
  FROM (SELECT {qid} AS qid, v FROM {qvec}) q, {dvec} d {cond})"""


def rrf_cte(name: str, lists: list[str], k: int) -> str:
    parts = "\n  UNION ALL ".join(
        f"SELECT qid, doc_id, rank, {i} AS list_no FROM {src}" for i, src in enumerate(lists))
    return f"""{name}_u AS (
  {parts}),
{name}_g AS (
  SELECT qid, doc_id,
         list_reduce(list(1e0 / (60 + rank) ORDER BY list_no), lambda a, b: a + b) AS score,
         min(list_no * 1000000 + rank) AS first_key
  FROM {name}_u GROUP BY qid, doc_id),
{name} AS (
  SELECT * FROM (
    SELECT qid, doc_id, score,
           row_number() OVER (PARTITION BY qid ORDER BY score DESC, first_key) AS rank
    FROM {name}_g) WHERE rank <= {k})"""


def retrieval_ctes() -> str:
    """BM25 (depth 100 / top 20), dense over hashed text (depth 100 / top 20), fused top 20."""
    return f"""{BM25_INDEX},
{bm25_scores_cte(BENCH_QUERIES)},
{topk_cte('bm25_100', 'bm25_scores', 100)},
{hash_vectors_cte('dv', DOC_SRC, 'doc_id', 'contents', 128)},
{hash_vectors_cte('qv', Q_SRC, 'qid', 'question', 128)},
{dense_pairs_cte('dense_scores', 'qv', 'dv', 'qid')},
{topk_cte('dense_100', 'dense_scores', 100)},
{rrf_cte('rrf_20', ['bm25_100', 'dense_100'], 20)},
ranked_all AS (
  SELECT qid, doc_id, score, rank, 'bm25' AS method FROM bm25_100 WHERE rank <= 20
  UNION ALL SELECT qid, doc_id, score, rank, 'dense' AS method FROM dense_100 WHERE rank <= 20
  UNION ALL SELECT qid, doc_id, score, rank, 'rrf' AS method FROM rrf_20),
results AS (
  SELECT r.qid, r.method, r.rank::INTEGER AS rank, r.score, r.doc_id, CAST(r.doc_id AS VARCHAR) AS id,
         c.title, CASE WHEN length(c.content) > 500 THEN substring(c.content, 1, 500) || '...' ELSE c.content END AS content
  FROM ranked_all r JOIN corpus c USING (doc_id)),
kw_dec AS (SELECT item_id AS qid, lower(text) AS kw FROM benchmark),
kw_sup AS (
  SELECT DISTINCT qid, token AS kw FROM (
    SELECT item_id AS qid, unnest(coalesce(regexp_extract_all(lower(text), '{TOKEN_RE}'), [])) AS token FROM benchmark)
  WHERE token IN (SELECT t.token FROM term_stats t, avg_idf a WHERE t.idf >= a.avg_idf)),
judged AS (
  SELECT r.*,
    CASE WHEN EXISTS (SELECT 1 FROM kw_dec k WHERE k.qid = r.qid AND contains(r.txt, k.kw)) THEN 2
         WHEN (SELECT count(*) FROM kw_sup k WHERE k.qid = r.qid AND contains(r.txt, k.kw)) >= 2 THEN 1
         ELSE 0 END::INTEGER AS gain
  FROM (SELECT *, lower(coalesce(title, '') || ' ' || coalesce(content, '')) AS txt FROM results) r)"""


def metric_ctes(judged: str, methods: str | None = None, gold_counts: str | None = None) -> str:
    where = f"WHERE method IN ({methods})" if methods else ""
    denom = "coalesce(gc.n_relevant, 0)" if gold_counts else "p.num_rel"
    gc_join = f"LEFT JOIN {gold_counts} gc ON gc.qid = p.qid" if gold_counts else ""
    return f"""g AS (
  SELECT qid, method, gain,
         row_number() OVER (PARTITION BY qid, method ORDER BY coalesce(rank, 999)) AS pos,
         row_number() OVER (PARTITION BY qid, method ORDER BY gain DESC, coalesce(rank, 999)) AS ipos
  FROM {judged} {where}),
ks AS (SELECT * FROM (VALUES (5), (10), (20)) t(k)),
per AS (
  SELECT g.qid, g.method, ks.k,
         coalesce(min(pos) FILTER (WHERE gain >= 1), 0) AS first_rel,
         count(*) FILTER (WHERE gain >= 1) AS num_rel,
         count(*) FILTER (WHERE gain >= 1 AND pos <= ks.k) AS rel_k,
         coalesce(sum(gain / log2(pos + 1)) FILTER (WHERE pos <= ks.k AND gain > 0), 0e0) AS dcg,
         coalesce(sum(gain / log2(ipos + 1)) FILTER (WHERE ipos <= ks.k AND gain > 0), 0e0) AS idcg
  FROM g, ks GROUP BY g.qid, g.method, ks.k),
mq AS (
  SELECT p.qid, p.method, 'hit' AS metric, p.k,
         CASE WHEN first_rel > 0 AND first_rel <= p.k THEN 1e0 ELSE 0e0 END AS value FROM per p
  UNION ALL SELECT p.qid, p.method, 'mrr', p.k,
         CASE WHEN first_rel > 0 AND first_rel <= p.k THEN 1e0 / first_rel ELSE 0e0 END FROM per p
  UNION ALL SELECT p.qid, p.method, 'recall', p.k,
         CASE WHEN {denom} > 0 THEN rel_k / {denom} END FROM per p {gc_join}
  UNION ALL SELECT p.qid, p.method, 'ndcg', p.k, CASE WHEN idcg > 0 THEN dcg / idcg END FROM per p
  UNION ALL SELECT p.qid, p.method, 'dcg', p.k, dcg FROM per p
  UNION ALL SELECT p.qid, p.method, 'idcg', p.k, idcg FROM per p)"""


SUMMARY = """summary AS (
  SELECT s.method, s.metric, s.k, s.value, s.n_values, n.n_queries FROM (
    SELECT method, metric, k, avg(value) AS value, count(value) AS n_values
    FROM mq WHERE metric IN ('hit', 'mrr', 'recall', 'ndcg') GROUP BY method, metric, k) s
  LEFT JOIN (SELECT method, count(DISTINCT qid) AS n_queries FROM mq GROUP BY method) n USING (method))"""

LATENCY = """latency AS (
  SELECT r.method, avg(length(b.text)::DOUBLE) AS avg_latency_ms, count(*) AS n_queries
  FROM (SELECT DISTINCT qid, method FROM results WHERE method IN ('dense', 'rrf')) r
  JOIN benchmark b ON b.item_id = r.qid GROUP BY r.method)"""

KW_METRICS = f"""WITH {retrieval_ctes()},
{metric_ctes('judged', "'dense', 'rrf'")}"""

SUMMARY_OUT = "SELECT method, metric, k, round(value, 6) AS value, n_values, n_queries FROM summary"

# ---------------------------------------------------------------- query texts
PADDED = f"""{BM25_INDEX},
{bm25_scores_cte(BENCH_QUERIES)},
{topk_cte('matched', 'bm25_scores', 500)},
first_ids AS (SELECT doc_id FROM corpus ORDER BY doc_id LIMIT 500),
pads AS (
  SELECT q.qid, f.doc_id, 0e0 AS score FROM ({BENCH_QUERIES}) q CROSS JOIN first_ids f
  WHERE NOT EXISTS (SELECT 1 FROM bm25_scores s WHERE s.qid = q.qid AND s.doc_id = f.doc_id)),
m AS (SELECT qid, count(*) AS m FROM matched GROUP BY qid),
padn AS (SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY doc_id) AS pad_pos FROM pads),
padk AS (SELECT p.qid, p.doc_id, p.score FROM padn p LEFT JOIN m USING (qid)
         WHERE pad_pos <= 500 - coalesce(m.m, 0)),
both_ AS (SELECT qid, doc_id, score FROM matched UNION ALL SELECT qid, doc_id, score FROM padk),
{topk_cte('ranked', 'both_', 500)}"""

SQL["bm25_padded"] = f"""WITH {PADDED}
SELECT qid, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM ranked"""

SQL["rrf2_padded"] = f"""WITH {PADDED},
{hash_vectors_cte('dv', DOC_SRC, 'doc_id', 'contents', 128)},
{hash_vectors_cte('qv', Q_SRC, 'qid', 'question', 128)},
{dense_pairs_cte('dense_scores', 'qv', 'dv', 'qid')},
{topk_cte('dense_500', 'dense_scores', 500)},
{rrf_cte('fused', ['ranked', 'dense_500'], 20)}
SELECT qid, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM fused"""

SQL["conversation_bm25"] = f"""WITH {BM25_INDEX},
{bm25_scores_cte(CONV_QUERIES)},
{topk_cte('ranked', 'bm25_scores', 20)}
SELECT qid, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM ranked"""

SQL["tokenize"] = f"""WITH {CORPUS}, {DOC_TOKENS}
SELECT doc_id, (generate_subscripts(toks, 1) - 1)::INTEGER AS pos, unnest(toks) AS token FROM doc_tokens"""

SQL["term_frequency"] = f"""WITH {BM25_INDEX}
SELECT p.doc_id, p.token, p.tf, d.doc_len FROM postings p JOIN doc_len d USING (doc_id)"""

SQL["doc_lengths"] = f"""WITH {BM25_INDEX}
SELECT doc_id, doc_len FROM doc_len"""

SQL["corpus_stats"] = f"""WITH {BM25_INDEX}
SELECT n_docs, n_tokens::BIGINT AS n_tokens, round(avgdl, 6) AS avgdl, n_terms, round(avg_idf, 6) AS avg_idf
FROM cstats, avg_idf"""

# Its own short form: only tokens and their document frequencies, no postings.
SQL["term_idf"] = f"""WITH t AS (
  SELECT unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '{TOKEN_RE}'))) AS token FROM documents),
f AS (SELECT token, count(*) AS df FROM t GROUP BY token),
r AS (SELECT token, df, ln((SELECT count(*) FROM documents) - df + 0.5e0) - ln(df + 0.5e0) AS raw FROM f)
SELECT token, df, round(CASE WHEN raw < 0 THEN 0.25e0 * (SELECT avg(raw) FROM r) ELSE raw END, 6) AS idf FROM r"""

SQL["corpus_unify"] = f"""WITH {UNIFIED}
SELECT doc_id, source, title, content, contents FROM unified"""

SQL["corpus_jsonl_roundtrip"] = SQL["corpus_unify"]

SQL["corpus_source_counts"] = f"""WITH {UNIFIED}
SELECT source, count(*) AS n_docs FROM unified GROUP BY ROLLUP (source)"""

SQL["contents_concat"] = """SELECT 'page_' || CAST(page_id AS VARCHAR) AS doc_id, url || ' ' || html AS contents FROM pages"""

SQL["text_fallback"] = f"""WITH {UNIFIED}
SELECT doc_id, coalesce(contents, content, '') AS lex_text FROM unified"""

SQL["encoder_text_clean"] = """SELECT doc_id, coalesce(CAST(text AS VARCHAR), '') AS clean_text FROM documents"""

SQL["snippet"] = """SELECT doc_id,
  CASE WHEN length(text) > 500 THEN substring(text, 1, 500) || '...' ELSE text END AS snippet
FROM documents"""

SQL["fixed_chunks"] = f"""WITH {CORPUS},
starts AS (
  SELECT doc_id, contents, unnest(range(0, ceil(length(contents) / 1000)::BIGINT)) AS chunk_no
  FROM corpus WHERE length(contents) > 0)
SELECT doc_id, chunk_no::INTEGER AS chunk_no, substring(contents, chunk_no * 1000 + 1, 1000) AS chunk FROM starts"""



def _chunk_level(items: str, separator: str) -> str:
    """Items above 1000 characters cut after each separator and merged greedily; the others as they are."""
    pieces = (f"list_filter(list_transform(string_split(x, '{separator}'), "
              f"lambda p, i: CASE WHEN i < len(string_split(x, '{separator}')) THEN p || '{separator}' ELSE p END), lambda p: p <> '')")
    state = "{{'o': {0}, 'c': {1}}}".format
    done = "CASE WHEN a.c <> '' THEN list_append(a.o, a.c) ELSE a.o END"
    step = (f"CASE WHEN length(a.c) + length(p.c) <= 1000 THEN {state('a.o', 'a.c || p.c')} "
            f"WHEN length(p.c) > 1000 THEN {state(f'list_append({done}, p.c)', repr(''))} ELSE {state(done, 'p.c')} END")
    made = (f"list_reduce(list_transform({pieces}, lambda p: {state('[]::VARCHAR[]', 'p')}), lambda a, p: {step}, "
            f"{state('[]::VARCHAR[]', repr(''))})")
    end = f"list_transform([{made}], lambda a: {done})[1]"
    return f"flatten(list_transform({items}, lambda x: CASE WHEN length(x) > 1000 THEN {end} ELSE [x] END))"


# Separators as SQL text: a line feed is written as it is.
SQL["recursive_chunks"] = f"""WITH l0 AS (SELECT doc_id, row_number() OVER () AS r, [text] AS items FROM documents WHERE coalesce(text, '') <> ''),
{", ".join(f"l{n + 1} AS (SELECT doc_id, r, " + _chunk_level('items', sep) + f" AS items FROM l{n})"
           for n, sep in enumerate((chr(10) + chr(10), chr(10), '. ', ' ')))},
l5 AS (SELECT doc_id, r, flatten(list_transform(items, lambda x: CASE WHEN length(x) > 1000
         THEN regexp_extract_all(x, '(?s).{{1,1000}}') ELSE [x] END)) AS items FROM l4)
SELECT doc_id, (generate_subscripts(items, 1) - 1)::INTEGER AS chunk_no, unnest(items) AS chunk FROM l5"""

SQL["l2_normalize"] = f"""WITH {NORM_EMB}
{long_vectors_sql('nv', 'doc_id', nonzero=False)}"""

SQL["dense_topk"] = f"""WITH {NORM_EMB},
{dense_pairs_cte('pairs', 'nv', 'nv', 'doc_id', exclude_self=True)},
{topk_cte('ranked', 'pairs', 20)}
SELECT qid, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM ranked"""

SQL["hash_encode"] = f"""WITH {hash_vectors_cte('dv', DOC_SRC, 'doc_id', 'contents', 128)}
{long_vectors_sql('dv')}"""

SQL["encode_values"] = SQL["hash_encode"]
SQL["encode_pooled"] = f"""WITH {hash_vectors_cte('dv', DOC_SRC, 'doc_id', 'contents', 32)}
{long_vectors_sql('dv')}"""
SQL["stream_encode_pooled"] = SQL["encode_pooled"]
SQL["encode_retry"] = """SELECT doc_id, 1::BIGINT AS n_ok, CASE WHEN contains(text, 'Licensed under') THEN 1 ELSE 0 END::BIGINT AS n_error
FROM documents"""
SQL["two_encoders_topk"] = f"""WITH {hash_vectors_cte('dv', DOC_SRC, 'doc_id', 'contents', 32)},
{hash_vectors_cte('qv', Q_SRC, 'qid', 'question', 32)},
{dense_pairs_cte('pairs', 'qv', 'dv', 'qid')},
{topk_cte('ranked', 'pairs', 20)}
SELECT qid, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM ranked"""
SQL["incremental_encode"] = SQL["hash_encode"]
SQL["stream_encode"] = SQL["hash_encode"]

SQL["dense_text_topk"] = f"""WITH {hash_vectors_cte('dv', DOC_SRC, 'doc_id', 'contents', 128)},
{hash_vectors_cte('qv', Q_SRC, 'qid', 'question', 128)},
{dense_pairs_cte('pairs', 'qv', 'dv', 'qid')},
{topk_cte('ranked', 'pairs', 20)}
SELECT qid, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM ranked"""

SQL["encode_quarantine"] = """SELECT doc_id,
  CASE WHEN contains(text, 'Licensed under') THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN contains(text, 'Licensed under') THEN NULL ELSE 128 END::INTEGER AS dims
FROM documents"""

SQL["vector_coverage"] = f"""WITH {UNIFIED},
{hash_vectors_cte('dv', DOC_SRC, 'doc_id', 'contents', 128)},
v AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, v, list_sum(list_transform(v, lambda x: x * x)) AS ss FROM dv),
j AS (SELECT u.doc_id IS NOT NULL AS has_d, v.doc_id IS NOT NULL AS has_v, v.v, v.ss
      FROM unified u FULL OUTER JOIN v ON u.doc_id = v.doc_id)
SELECT count(*) FILTER (WHERE has_d) AS n_docs, count(*) FILTER (WHERE has_v) AS n_vectors,
       count(*) FILTER (WHERE has_d AND NOT has_v) AS missing, count(*) FILTER (WHERE has_v AND NOT has_d) AS orphan,
       count(*) FILTER (WHERE has_v AND v IS NULL) AS errors,
       count(*) FILTER (WHERE has_v AND v IS NOT NULL AND ss = 0) AS zero_vectors
FROM j"""

SQL["rrf2"] = f"""WITH {retrieval_ctes()}
SELECT qid, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM rrf_20"""

SQL["rrf3"] = f"""WITH {BM25_INDEX},
{bm25_scores_cte(BENCH_QUERIES)},
{topk_cte('bm25_100', 'bm25_scores', 100)},
{hash_vectors_cte('dv', DOC_SRC, 'doc_id', 'contents', 128)},
{hash_vectors_cte('qv', Q_SRC, 'qid', 'question', 128)},
{dense_pairs_cte('d128', 'qv', 'dv', 'qid')},
{topk_cte('d128_100', 'd128', 100)},
{hash_vectors_cte('dv32', DOC_SRC, 'doc_id', 'contents', 32)},
{hash_vectors_cte('qv32', Q_SRC, 'qid', 'question', 32)},
{dense_pairs_cte('d32', 'qv32', 'dv32', 'qid')},
{topk_cte('d32_100', 'd32', 100)},
{rrf_cte('fused', ['bm25_100', 'd128_100', 'd32_100'], 20)}
SELECT qid, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM fused"""


def _results_sql(method: str) -> str:
    return f"""WITH {retrieval_ctes()}
SELECT qid, method, rank, round(score, 6) AS score, id, title, content FROM results WHERE method = '{method}'"""


SQL["retrieve_bm25"] = _results_sql("bm25")
SQL["retrieve_dense"] = _results_sql("dense")
SQL["retrieve_rrf"] = _results_sql("rrf")

SQL["result_preview"] = f"""WITH {retrieval_ctes()}
SELECT qid, rank, id, substring(title, 1, 50) AS title, round(score, 6) AS score
FROM results WHERE method = 'rrf' AND rank <= 3"""

_RUN_FLAT = f"""WITH {retrieval_ctes()},
rr AS (SELECT r.*, count(*) OVER (PARTITION BY r.qid) AS num_results FROM results r WHERE method = 'rrf')
SELECT @QID@ AS qid, b.text AS question, rr.method, 'RRF-2 (BM25 + Dense)' AS retriever,
       round(length(b.text)::DOUBLE, 6) AS latency_ms, num_results::INTEGER AS num_results,
       rr.rank, round(rr.score, 6) AS score, rr.id, rr.title, rr.content
FROM rr JOIN benchmark b ON b.item_id = rr.qid"""

SQL["run_flat"] = _RUN_FLAT.replace("@QID@", "rr.qid")
SQL["run_nested"] = _RUN_FLAT.replace("@QID@", "CAST(rr.qid AS VARCHAR)")

SQL["run_object"] = f"""SELECT f.*, 'B' AS answer, 'B: ' || f.question AS chosen FROM ({SQL['run_nested']}) f"""

SQL["timed_run"] = f"""WITH {retrieval_ctes()}
SELECT m.method, (SELECT count(*) FROM benchmark) AS n_queries, count(r.qid) AS n_results, true AS in_range
FROM (VALUES ('bm25'), ('dense')) m(method) LEFT JOIN ranked_all r USING (method) GROUP BY m.method"""

SQL["query_request_join"] = f"""WITH q AS ({CONV_QUERIES}),
r AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn - 1 AS VARCHAR) AS qid, text AS answer
      FROM conversations WHERE role = 'assistant')
SELECT q.qid, q.question, r.answer FROM q LEFT JOIN r USING (qid)"""

SQL["requests_roundtrip"] = SQL["query_request_join"]

KNOWN_ITEM = """known AS (
  SELECT b.item_id AS qid, d.doc_id, 2::INTEGER AS relevance_score
  FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""

SQL["known_item_gold"] = f"""WITH {KNOWN_ITEM} SELECT qid, doc_id, relevance_score FROM known"""

SQL["gold_roundtrip"] = f"""WITH {KNOWN_ITEM}
SELECT CAST(qid AS VARCHAR) AS qid, CAST(doc_id AS VARCHAR) AS id, relevance_score::DOUBLE AS relevance_score FROM known"""

SQL["keyword_relevance"] = f"""WITH {retrieval_ctes()}
SELECT qid, rank, doc_id, gain FROM judged WHERE method = 'rrf'"""

SQL["gold_relevance"] = f"""WITH {retrieval_ctes()},
gold AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 2 WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END AS s
         FROM labels)
SELECT r.qid, r.rank, r.doc_id, coalesce(gold.s, 0)::INTEGER AS gain
FROM results r LEFT JOIN gold USING (doc_id) WHERE r.method = 'rrf'"""

SQL["gains"] = f"""{KW_METRICS}
SELECT qid, method, pos::INTEGER AS pos, gain FROM g"""

for _m in ("hit", "mrr", "recall", "dcg", "idcg", "ndcg"):
    SQL[f"{_m}_at_k"] = f"""{KW_METRICS}
SELECT qid, method, metric, k, round(value, 6) AS value FROM mq WHERE metric = '{_m}'"""

SQL["recall_gold_at_k"] = f"""WITH {retrieval_ctes()},
{KNOWN_ITEM},
gjudged AS (SELECT r.qid, r.method, r.rank, coalesce(kn.relevance_score, 0) AS gain
            FROM results r LEFT JOIN known kn ON kn.qid = r.qid AND kn.doc_id = r.doc_id WHERE r.method = 'rrf'),
gcounts AS (SELECT qid, count(*) AS n_relevant FROM known WHERE relevance_score >= 1 GROUP BY qid),
{metric_ctes('gjudged', None, 'gcounts')}
SELECT qid, method, metric, k, round(value, 6) AS value FROM mq WHERE metric = 'recall'"""

SQL["metrics_per_query"] = f"""{KW_METRICS}
SELECT qid, method, metric, k, round(value, 6) AS value FROM mq WHERE metric IN ('hit', 'mrr', 'recall', 'ndcg')"""

SQL["metrics_summary"] = f"""{KW_METRICS},
{SUMMARY}
{SUMMARY_OUT}"""

SQL["evaluate_run"] = f"SELECT * FROM ({SQL['metrics_summary']}) WHERE method = 'rrf'"

_WITH_EMPTY = metric_ctes('judged', "'bm25'").replace("mq AS (", """per_all AS (
  SELECT q.qid, 'bm25' AS method, ks.k, coalesce(x.first_rel, 0) AS first_rel, coalesce(x.num_rel, 0) AS num_rel,
         coalesce(x.rel_k, 0) AS rel_k, coalesce(x.dcg, 0e0) AS dcg, coalesce(x.idcg, 0e0) AS idcg
  FROM (SELECT item_id AS qid FROM benchmark UNION ALL SELECT -1) q CROSS JOIN ks
       LEFT JOIN per x ON x.qid = q.qid AND x.k = ks.k),
mq AS (""").replace("FROM per p", "FROM per_all p")

SQL["summary_with_empty"] = f"""WITH {retrieval_ctes()},
{_WITH_EMPTY},
{SUMMARY}
{SUMMARY_OUT}"""

SQL["avg_latency"] = f"""WITH {retrieval_ctes()},
{LATENCY}
SELECT method, round(avg_latency_ms, 6) AS avg_latency_ms, n_queries FROM latency"""

SQL["compare_methods"] = f"""{KW_METRICS},
{SUMMARY},
{LATENCY}
SELECT s.method, CASE s.method WHEN 'dense' THEN 'Dense (baseline)' ELSE 'RRF-2 (BM25 + Dense)' END AS name,
       s.metric, s.k, round(s.value, 6) AS value, round(l.avg_latency_ms, 6) AS avg_latency_ms
FROM summary s LEFT JOIN latency l USING (method)"""

SQL["report_roundtrip"] = f"""SELECT CASE method WHEN 'dense' THEN 'baseline' ELSE 'rrf2' END AS role, name, metric, k, value, avg_latency_ms
FROM ({SQL['compare_methods']}) WHERE value IS NOT NULL"""

SQL["improvement"] = f"""{KW_METRICS},
{SUMMARY}
SELECT b.metric, b.k, round(b.value, 6) AS base, round(n.value, 6) AS new, round(n.value - b.value, 6) AS delta,
       round(CASE WHEN b.value > 0 THEN (n.value - b.value) / b.value * 100 ELSE 0e0 END, 6) AS pct
FROM summary b JOIN summary n ON b.metric = n.metric AND b.k = n.k
WHERE b.method = 'dense' AND n.method = 'rrf' AND b.value IS NOT NULL AND n.value IS NOT NULL"""

SQL["metric_pivot"] = f"""{KW_METRICS},
{SUMMARY}
SELECT metric, method,
       round(max(value) FILTER (WHERE k = 5), 6) AS at_5,
       round(max(value) FILTER (WHERE k = 10), 6) AS at_10,
       round(max(value) FILTER (WHERE k = 20), 6) AS at_20
FROM summary GROUP BY metric, method"""

SQL["label_dense_metrics"] = f"""WITH {NORM_EMB},
{dense_pairs_cte('pairs', 'nv', 'nv', 'doc_id', exclude_self=True)},
{topk_cte('ranked', 'pairs', 20)},
ljudged AS (
  SELECT r.qid, 'dense' AS method, r.rank, (d.label = q.label)::INTEGER AS gain
  FROM ranked r JOIN nv d ON d.doc_id = r.doc_id JOIN nv q ON q.doc_id = r.qid),
{metric_ctes('ljudged')},
{SUMMARY}
{SUMMARY_OUT}"""
