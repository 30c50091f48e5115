"""Named queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads whole tables and returns a DataFrame.  Index builds,
checkpoints and size probes run while a query is planned; the result itself is
computed by the caller.  Doubles are rounded to 6 decimals in the final projection only, so
that the DuckDB oracle (``plans.oracle``) can compare values exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import clean_text, lexical_text, snippet, tokens
from quarry.operators import bm25, dense, encode, evaluate, fusion, metrics, relevance, report
from quarry.operators import corpus as corpus_ops
from quarry.operators import retrieve as retrieve_ops
from quarry.operators.lexical_index import LexicalIndex
from quarry.plans.workspace import Workspace
from quarry.session import materialize, scratch_path
from quarry.sources import fixtures as fx
from quarry.sources import readers, tables, writers
from quarry.streaming import incremental

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Cut-offs, list sizes and encoder widths used by the fixtures.
K_VALUES = (5, 10, 20)
TOP_K = 20
DEPTH = 100
PAD_K = 500
HASH_DIM = 128
SMALL_HASH_DIM = 32
QUARANTINE_MARKER = "Licensed under"
METHOD_NAMES = {"dense": "Dense (baseline)", "rrf": "RRF-2 (BM25 + Dense)"}


class MarkerFactory:
    """Hashing encoder that refuses texts with a marker (as a model refuses
    contents it cannot take); used to exercise per-row quarantine."""

    def __init__(self, marker: str):
        self.marker = marker

    def __call__(self):
        inner = encode.HashingEncoder(HASH_DIM)
        marker = self.marker

        def run(texts):
            for t in texts:
                if marker in t:
                    raise ValueError(f"text with {marker!r}")
            return inner(texts)
        return run


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def r6(col: str) -> F.Column:
    return F.round(F.col(col), 6).alias(col)


def ranking_out(df: DataFrame, qid: str = "qid", id_col: str = "doc_id") -> DataFrame:
    return df.select(qid, id_col, r6("score"), F.col("rank").cast("int").alias("rank"))


# ---------------------------------------------------------------- lexical
def _doc_index(spark, sf_dir) -> bm25.Bm25Index:
    return Workspace.of(spark, sf_dir).index()


@register("bm25_topk")
def bm25_topk(spark, sf_dir):
    idx = _doc_index(spark, sf_dir)
    ranking = bm25.top_k_lexical(idx, fx.benchmark_queries(spark, sf_dir), k=TOP_K)
    return ranking_out(ranking)


@register("bm25_padded")
def bm25_padded(spark, sf_dir):
    docs = fx.documents_corpus(spark, sf_dir)
    idx = _doc_index(spark, sf_dir)
    ranking = bm25.top_k_lexical(idx, fx.benchmark_queries(spark, sf_dir), k=PAD_K,
                                 pad_unmatched=True, corpus_ids=docs)
    return ranking_out(ranking)


@register("conversation_bm25")
def conversation_bm25(spark, sf_dir):
    idx = _doc_index(spark, sf_dir)
    return ranking_out(bm25.top_k_lexical(idx, fx.conversation_queries(spark, sf_dir), k=TOP_K))


@register("bm25_appended")
def bm25_appended(spark, sf_dir):
    """Two thirds of the documents are indexed, the rest is appended, and the index opened again by its path."""
    docs = fx.documents_corpus(spark, sf_dir)
    late = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    path = scratch_path(spark, "appended_index")
    LexicalIndex.build(docs.where(~late), path)
    LexicalIndex.open(spark, path).append(docs.where(late))
    return ranking_out(LexicalIndex.open(spark, path).top_k(fx.benchmark_queries(spark, sf_dir), k=TOP_K))


@register("tokenize")
def tokenize(spark, sf_dir):
    docs = fx.documents_corpus(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(tokens(lexical_text())).alias("pos", "token")) \
               .select("doc_id", F.col("pos").cast("int").alias("pos"), "token")


@register("term_frequency")
def term_frequency(spark, sf_dir):
    return _doc_index(spark, sf_dir).postings.select("doc_id", "token", "tf", "doc_len")


@register("doc_lengths")
def doc_lengths(spark, sf_dir):
    dt = bm25.document_tokens(fx.documents_corpus(spark, sf_dir))
    return bm25.doc_lengths(dt)


@register("corpus_stats")
def corpus_stats(spark, sf_dir):
    cs = _doc_index(spark, sf_dir).corpus_stats
    return cs.select("n_docs", "n_tokens", r6("avgdl"), "n_terms", r6("avg_idf"))


@register("term_idf")
def term_idf(spark, sf_dir):
    return _doc_index(spark, sf_dir).term_stats.select("token", "df", r6("idf"))


# ---------------------------------------------------------------- corpus preparation
def _unified(spark, sf_dir):
    return corpus_ops.unify([fx.documents_as_source(spark, sf_dir), fx.pages_corpus(spark, sf_dir)])


@register("corpus_unify")
def corpus_unify(spark, sf_dir):
    return _unified(spark, sf_dir).select(*corpus_ops.CORPUS_COLUMNS)


@register("corpus_source_counts")
def corpus_source_counts(spark, sf_dir):
    return corpus_ops.source_counts(_unified(spark, sf_dir))


@register("contents_concat")
def contents_concat(spark, sf_dir):
    return fx.pages_corpus(spark, sf_dir).select("doc_id", "contents")


@register("text_fallback")
def text_fallback(spark, sf_dir):
    return _unified(spark, sf_dir).select("doc_id", lexical_text().alias("lex_text"))


@register("encoder_text_clean")
def encoder_text_clean(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return d.select("doc_id", clean_text("text").alias("clean_text"))


@register("snippet")
def snippet_q(spark, sf_dir):
    return fx.documents_corpus(spark, sf_dir).select("doc_id", snippet("content").alias("snippet"))


@register("fixed_chunks")
def fixed_chunks(spark, sf_dir):
    return corpus_ops.fixed_chunks(fx.documents_corpus(spark, sf_dir), "doc_id", "contents", 1000)


@register("recursive_chunks")
def recursive_chunks(spark, sf_dir):
    return corpus_ops.recursive_chunks(fx.documents_corpus(spark, sf_dir), "doc_id", "contents", 1000)


# ---------------------------------------------------------------- dense
def _embedding_vectors(spark, sf_dir):
    return dense.normalize(fx.embedding_vectors(spark, sf_dir))


def _doc_hash_vectors(spark, sf_dir, dim=HASH_DIM):
    return Workspace.of(spark, sf_dir).doc_vectors(dim)


def _doc_hash_blocks(spark, sf_dir, dim=HASH_DIM):
    return Workspace.of(spark, sf_dir).doc_blocks(dim)


def _query_hash_vectors(spark, sf_dir, dim=HASH_DIM):
    return Workspace.of(spark, sf_dir).query_vectors(dim)


def long_vectors(df: DataFrame, id_col: str = "doc_id", vec_col: str = "embedding",
                 nonzero: bool = True) -> DataFrame:
    out = (df.select(id_col, F.posexplode(vec_col).alias("dim", "value"))
             .select(id_col, F.col("dim").cast("int").alias("dim"), F.round("value", 6).alias("value")))
    return out.where(F.col("value") != 0) if nonzero else out


@register("l2_normalize")
def l2_normalize_q(spark, sf_dir):
    return long_vectors(_embedding_vectors(spark, sf_dir), nonzero=False)


@register("dense_topk")
def dense_topk(spark, sf_dir):
    v = _embedding_vectors(spark, sf_dir)
    ranking = dense.topk(v, v.withColumnRenamed("doc_id", "qid"), k=TOP_K, exclude_self=True)
    return ranking_out(ranking)


@register("hash_encode")
def hash_encode_q(spark, sf_dir):
    return long_vectors(_doc_hash_vectors(spark, sf_dir))


@register("dense_text_topk")
def dense_text_topk(spark, sf_dir):
    ranking = dense.topk(_doc_hash_blocks(spark, sf_dir), _query_hash_vectors(spark, sf_dir), k=TOP_K)
    return ranking_out(ranking)


@register("encode_values")
def encode_values(spark, sf_dir):
    docs = fx.documents_corpus(spark, sf_dir)
    made = encode.encode(docs, encoder_factory=encode.HashingEncoderFactory(HASH_DIM))
    return long_vectors(made.select("doc_id", "embedding"))


@register("encode_pooled")
def encode_pooled(spark, sf_dir):
    """Token states pooled per text; sub-batches of an odd size, as no vector depends on its neighbours."""
    docs = fx.documents_corpus(spark, sf_dir)
    made = encode.encode(docs, encoder_factory=encode.PooledHashingEncoderFactory(SMALL_HASH_DIM), batch_size=7)
    return long_vectors(made.select("doc_id", "embedding"))


@register("two_encoders_topk")
def two_encoders_topk(spark, sf_dir):
    """Documents by the document encoder (pooled token states), queries by the query encoder, then exact search."""
    pair = encode.EncoderPair(encode.PooledHashingEncoderFactory(SMALL_HASH_DIM), encode.HashingEncoderFactory(SMALL_HASH_DIM))
    docs = pair.documents(fx.documents_corpus(spark, sf_dir)).select("doc_id", "embedding")
    stored = scratch_path(spark, "pair_vectors")
    writers.write_vectors(docs, f"{stored}/table", float32=False)
    asked = pair.queries(fx.benchmark_queries(spark, sf_dir)).select("qid", "embedding")
    return ranking_out(dense.topk(readers.read_vectors(spark, f"{stored}/table"), asked, k=TOP_K))


@register("encode_quarantine")
def encode_quarantine(spark, sf_dir):
    d = fx.documents_corpus(spark, sf_dir)
    out = encode.encode(d, id_col="doc_id", text_col="contents",
                        encoder_factory=MarkerFactory(QUARANTINE_MARKER))
    dims = F.when(F.col("embedding").isNotNull(), F.size("embedding"))
    return out.select("doc_id", "status", dims.cast("int").alias("dims"))


@register("vector_coverage")
def vector_coverage(spark, sf_dir):
    vecs = _doc_hash_vectors(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("string"))
    return dense.coverage(_unified(spark, sf_dir), vecs)


# ---------------------------------------------------------------- fusion / retrieval
def _bench_ranking(spark, sf_dir, method, k=TOP_K, depth=DEPTH):
    return Workspace.of(spark, sf_dir).ranking(method, k, depth)


@register("rrf2")
def rrf2(spark, sf_dir):
    return ranking_out(_bench_ranking(spark, sf_dir, "rrf"))


@register("rrf2_padded")
def rrf2_padded(spark, sf_dir):
    """Fusion of a lexical list filled up with unmatched documents, as when every document has a rank."""
    ws, docs = Workspace.of(spark, sf_dir), fx.documents_corpus(spark, sf_dir)
    return ranking_out(retrieve_ops.retrieve(
        fx.benchmark_queries(spark, sf_dir), method="rrf", k=TOP_K, depth=PAD_K, bm25_index=ws.index(),
        doc_vectors=ws.doc_blocks(HASH_DIM), query_vectors=ws.query_vectors(HASH_DIM), pad_unmatched=True, corpus_ids=docs))


@register("rrf3")
def rrf3(spark, sf_dir):
    q, dims = fx.benchmark_queries(spark, sf_dir), (HASH_DIM, SMALL_HASH_DIM)
    lists = [bm25.top_k_lexical(_doc_index(spark, sf_dir), q, k=DEPTH)]
    Workspace.of(spark, sf_dir).encode_documents(*dims)
    for dim in dims:
        lists.append(dense.topk(_doc_hash_blocks(spark, sf_dir, dim),
                                _query_hash_vectors(spark, sf_dir, dim), k=DEPTH))
    return ranking_out(fusion.rrf(lists, k=TOP_K))


def _results(spark, sf_dir, method):
    return Workspace.of(spark, sf_dir).results(method, TOP_K, DEPTH)


def results_out(df: DataFrame) -> DataFrame:
    return df.select("qid", "method", F.col("rank").cast("int").alias("rank"), r6("score"),
                     "id", "title", "content")


@register("retrieve_bm25")
def retrieve_bm25(spark, sf_dir):
    return results_out(_results(spark, sf_dir, "bm25"))


@register("retrieve_dense")
def retrieve_dense(spark, sf_dir):
    return results_out(_results(spark, sf_dir, "dense"))


@register("retrieve_rrf")
def retrieve_rrf(spark, sf_dir):
    return results_out(_results(spark, sf_dir, "rrf"))


@register("result_preview")
def result_preview(spark, sf_dir):
    p = corpus_ops.preview(_results(spark, sf_dir, "rrf"))
    return p.select("qid", F.col("rank").cast("int").alias("rank"), "id", "title", r6("score"))


def _run(spark, sf_dir, method):
    q = fx.benchmark_queries(spark, sf_dir)
    return retrieve_ops.build_run(_results(spark, sf_dir, method), q,
                                  latency_ms=synthetic_latency())


def synthetic_latency():
    """Fixed stand-in for a per-query wall clock: 1 ms per question character."""
    return F.length("question").cast("double")


@register("run_flat")
def run_flat(spark, sf_dir):
    flat = retrieve_ops.flatten_run(_run(spark, sf_dir, "rrf"))
    return flat.select("qid", "question", "method", "retriever", r6("latency_ms"),
                       F.col("num_results").cast("int").alias("num_results"),
                       F.col("rank").cast("int").alias("rank"), r6("score"), "id", "title", "content")


@register("run_nested")
def run_nested(spark, sf_dir):
    path = scratch_path(spark, "run_nested")
    writers.write_run(_run(spark, sf_dir, "rrf"), path)
    flat = retrieve_ops.flatten_run(readers.read_run(spark, path, layout="lines"))
    return flat.select("qid", "question", "method", "retriever", r6("latency_ms"),
                       F.col("num_results").cast("int").alias("num_results"),
                       F.col("rank").cast("int").alias("rank"), r6("score"), "id", "title", "content")


@register("timed_run")
def timed_run(spark, sf_dir):
    """Measured runs of two methods: what they returned, and that the measured latency is a plausible one."""
    ws, queries, out = Workspace.of(spark, sf_dir), fx.benchmark_queries(spark, sf_dir), []
    for method in ("bm25", "dense"):
        ranking = retrieve_ops.retrieve(queries, method=method, k=TOP_K, bm25_index=ws.index(),
                                        doc_vectors=ws.doc_blocks(HASH_DIM), query_vectors=ws.query_vectors(HASH_DIM))
        stored, took = retrieve_ops.timed(ranking, queries, f"timed_{method}")
        run = retrieve_ops.build_run(retrieve_ops.format_results(stored, ws.corpus()), queries,
                                     latency_ms=took["latency_ms"], methods=[method])
        fine = (F.col("avg_latency_ms") > 0) & (F.col("avg_latency_ms") * F.col("n_queries") < 3_600_000)
        out.append(metrics.avg_latency(run).select("method", "n_queries", F.lit(took["n_results"]).cast("long").alias("n_results"),
                                                   fine.alias("in_range")))
    return out[0].unionByName(out[1])


@register("run_object")
def run_object(spark, sf_dir):
    """A run with its requests, written as JSON objects keyed by query id and read back."""
    queries, path = fx.benchmark_queries(spark, sf_dir), scratch_path(spark, "run_object")
    requests = queries.select("qid", F.col("qid").cast("string").alias("id"), "question", F.create_map(
        F.lit("A"), F.substring("question", 1, 20), F.lit("B"), F.concat(F.lit("B: "), "question")).alias("options"), F.lit("B").alias("answer"))
    run = retrieve_ops.build_run(_results(spark, sf_dir, "rrf"), queries, requests, latency_ms=synthetic_latency())
    writers.write_run(run, path, layout="object", queries_per_object=50)
    back = readers.read_run(spark, path, layout="object_lines", method="rrf")
    asked = back.select("qid", F.col("full_question.options").alias("options"), F.col("full_question.answer").alias("answer"))
    flat = retrieve_ops.flatten_run(back).join(asked, "qid")
    return flat.select("qid", "question", "method", "retriever", r6("latency_ms"), F.col("num_results").cast("int").alias("num_results"),
                       F.col("rank").cast("int").alias("rank"), r6("score"), "id", "title", "content", "answer",
                       F.try_element_at("options", F.col("answer")).alias("chosen"))


@register("requests_roundtrip")
def requests_roundtrip(spark, sf_dir):
    """Queries and requests as JSON arrays, read back in splits and joined by key."""
    queries, requests = fx.conversation_queries(spark, sf_dir), fx.conversation_requests(spark, sf_dir)
    path = scratch_path(spark, "request_files")
    asked = queries.select(F.col("qid").alias("id"), "question")
    writers.write_json_array(asked, f"{path}/queries", "id", per_file=200)
    options = F.create_map(F.lit("A"), F.col("answer"), F.lit("B"), F.lit('none of "these"\n},'))
    full = requests.select(F.col("qid").alias("id"), F.lit(None).cast("string").alias("question"), options.alias("options"),
                           F.lit("A").alias("answer"))
    writers.write_json_array(full, f"{path}/requests", "id", per_file=200)
    back = readers.read_requests(spark, f"{path}/requests").select("qid", "options", F.col("answer").alias("letter"))
    return readers.read_queries(spark, f"{path}/queries").join(back, "qid", "left").select(
        "qid", "question", F.try_element_at("options", F.col("letter")).alias("answer"))


@register("gold_roundtrip")
def gold_roundtrip(spark, sf_dir):
    """Known-item gold as a JSON object keyed by query, read back."""
    gold, path = _known_item(spark, sf_dir), scratch_path(spark, "gold_file")
    item = F.struct(F.col("doc_id").cast("string").alias("id"), F.col("relevance_score").cast("double").alias("relevance_score"))
    per_q = gold.groupBy("qid").agg(F.array_sort(F.collect_list(item)).alias("manually_selected_top_5"))
    writers.write_json_object(per_q, path, "qid", per_file=10)
    return readers.read_gold(spark, path).select("qid", "id", "relevance_score")


@register("query_request_join")
def query_request_join(spark, sf_dir):
    q = fx.conversation_queries(spark, sf_dir)
    return q.join(fx.conversation_requests(spark, sf_dir), "qid", "left").select(
        "qid", "question", "answer")


# ---------------------------------------------------------------- relevance / metrics
@register("known_item_gold")
def known_item_gold(spark, sf_dir):
    return _known_item(spark, sf_dir)


def _known_item(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    idx = ws.index()
    return relevance.known_item_gold(ws.corpus(), fx.benchmark_queries(spark, sf_dir),
                                     postings=idx.postings, doc_freq=idx.term_stats)


def _keyword_rules(spark, sf_dir):
    index = _doc_index(spark, sf_dir)
    return fx.benchmark_keyword_rules(spark, sf_dir, index.term_stats, index.corpus_stats.select("avg_idf").scalar())


def _keyword_judged(spark, sf_dir, method):
    return relevance.keyword_gains(_results(spark, sf_dir, method),
                                   _keyword_rules(spark, sf_dir))


@register("keyword_relevance")
def keyword_relevance(spark, sf_dir):
    j = _keyword_judged(spark, sf_dir, "rrf")
    return j.select("qid", F.col("rank").cast("int").alias("rank"), "doc_id", "gain")


@register("gold_relevance")
def gold_relevance(spark, sf_dir):
    j = relevance.gold_gains(_results(spark, sf_dir, "rrf"), fx.label_gold(spark, sf_dir),
                             id_col="doc_id", gold_id_col="doc_id")
    return j.select("qid", F.col("rank").cast("int").alias("rank"), "doc_id", "gain")


def _gains(spark, sf_dir):
    judged = _keyword_judged(spark, sf_dir, "dense").unionByName(
        _keyword_judged(spark, sf_dir, "rrf"))
    return metrics.ordered_gains(judged)


@register("gains")
def gains(spark, sf_dir):
    g = _gains(spark, sf_dir)
    return g.select("qid", "method", F.col("pos").cast("int").alias("pos"), "gain")


def _asked(queries, *methods):
    """(qid, method) of every query asked, with or without results."""
    return queries.select("qid", F.explode(F.array(*[F.lit(m) for m in methods])).alias("method"))


def _metrics_q(spark, sf_dir, with_dcg=False):
    asked = _asked(fx.benchmark_queries(spark, sf_dir), "dense", "rrf")
    return metrics.per_query(_gains(spark, sf_dir), K_VALUES, with_dcg=with_dcg, queries=asked)


def metric_out(df: DataFrame) -> DataFrame:
    return df.select("qid", "method", "metric", F.col("k").cast("int").alias("k"), r6("value"))


def _one_metric(name):
    def q(spark, sf_dir):
        m = _metrics_q(spark, sf_dir, with_dcg=name in ("dcg", "idcg"))
        return metric_out(m.where(F.col("metric") == name))
    return q


for _m in ("hit", "mrr", "recall", "dcg", "idcg", "ndcg"):
    register(f"{_m}_at_k")(_one_metric(_m))


@register("recall_gold_at_k")
def recall_gold_at_k(spark, sf_dir):
    gold = _known_item(spark, sf_dir)
    judged = relevance.gold_gains(_results(spark, sf_dir, "rrf"), gold,
                                  id_col="doc_id", gold_id_col="doc_id")
    counts = gold.where(F.col("relevance_score") >= 1).groupBy("qid").agg(
        F.count(F.lit(1)).alias("n_relevant"))
    m = metrics.per_query(metrics.ordered_gains(judged), K_VALUES, gold_counts=counts,
                          metrics=("recall",), queries=_asked(fx.benchmark_queries(spark, sf_dir), "rrf"))
    return metric_out(m)


@register("metrics_per_query")
def metrics_per_query(spark, sf_dir):
    return metric_out(_metrics_q(spark, sf_dir))


def _summary(spark, sf_dir):
    return metrics.summarize(_metrics_q(spark, sf_dir))


def summary_out(df: DataFrame) -> DataFrame:
    return df.select("method", "metric", F.col("k").cast("int").alias("k"), r6("value"),
                     "n_values", "n_queries")


@register("metrics_summary")
def metrics_summary(spark, sf_dir):
    return summary_out(_summary(spark, sf_dir))


#: A query whose one token is in no document.
UNMATCHED_QID, UNMATCHED_TEXT = -1, "zzqxnotoken"


@register("summary_with_empty")
def summary_with_empty(spark, sf_dir):
    """BM25 over the benchmark queries and one that no document matches; it counts in every average."""
    bench = fx.benchmark_queries(spark, sf_dir)
    extra = spark.range(1).select(F.lit(UNMATCHED_QID).cast(bench.schema["qid"].dataType).alias("qid"),
                                  F.lit(UNMATCHED_TEXT).alias("question"))
    queries, ws = bench.unionByName(extra), Workspace.of(spark, sf_dir)
    ranking = retrieve_ops.retrieve(queries, method="bm25", k=TOP_K, bm25_index=ws.index())
    results = retrieve_ops.format_results(ranking, ws.corpus())
    judged = relevance.keyword_gains(results, _keyword_rules(spark, sf_dir))
    m = metrics.per_query(metrics.ordered_gains(judged), K_VALUES, queries=_asked(queries, "bm25"))
    return summary_out(metrics.summarize(m))


def _latency(spark, sf_dir):
    runs = _run(spark, sf_dir, "dense").unionByName(_run(spark, sf_dir, "rrf"))
    return metrics.avg_latency(runs)


@register("avg_latency")
def avg_latency(spark, sf_dir):
    return _latency(spark, sf_dir).select("method", r6("avg_latency_ms"), "n_queries")


@register("compare_methods")
def compare_methods(spark, sf_dir):
    c = report.comparison(_summary(spark, sf_dir), _latency(spark, sf_dir), METHOD_NAMES)
    return c.select("method", "name", "metric", F.col("k").cast("int").alias("k"), r6("value"),
                    r6("avg_latency_ms"))


@register("report_roundtrip")
def report_roundtrip(spark, sf_dir):
    """The comparison report, written as JSON and read back."""
    path = scratch_path(spark, "report")
    roles = {"baseline": ("dense", METHOD_NAMES["dense"]), "rrf2": ("rrf", METHOD_NAMES["rrf"])}
    writers.write_report(report.report_frame(_summary(spark, sf_dir), _latency(spark, sf_dir), roles, K_VALUES), path)
    saved = readers.read_report(spark, path, list(roles))
    return saved.select("role", "name", "metric", "k", r6("value"), r6("avg_latency_ms"))


@register("improvement")
def improvement(spark, sf_dir):
    imp = report.improvement(_summary(spark, sf_dir), "dense", "rrf")
    return imp.select("metric", F.col("k").cast("int").alias("k"), r6("base"), r6("new"),
                      r6("delta"), r6("pct"))


@register("metric_pivot")
def metric_pivot(spark, sf_dir):
    p = report.metric_table(_summary(spark, sf_dir), K_VALUES)
    return p.select("metric", "method", *[r6(f"at_{k}") for k in K_VALUES])


@register("evaluate_run")
def evaluate_run(spark, sf_dir):
    """Evaluation of one run from its results alone."""
    done = evaluate.evaluate(_results(spark, sf_dir, "rrf"), rules=_keyword_rules(spark, sf_dir), k_values=K_VALUES,
                             queries=_asked(fx.benchmark_queries(spark, sf_dir), "rrf"))
    return summary_out(done.summary)


@register("label_dense_metrics")
def label_dense_metrics(spark, sf_dir):
    v = _embedding_vectors(spark, sf_dir)
    ranking = dense.topk(v, v.withColumnRenamed("doc_id", "qid"), k=TOP_K, exclude_self=True)
    labels = fx.embedding_vectors(spark, sf_dir).select("doc_id", "label")
    judged = (ranking.join(labels, "doc_id")
                     .join(labels.withColumnRenamed("doc_id", "qid")
                                 .withColumnRenamed("label", "qlabel"), "qid")
                     .withColumn("gain", (F.col("label") == F.col("qlabel")).cast("int"))
                     .withColumn("method", F.lit("dense")))
    asked = _asked(labels.withColumnRenamed("doc_id", "qid"), "dense")
    # Stored, since the summary reads it twice: averages, and the number of queries.
    m = materialize(metrics.per_query(metrics.ordered_gains(judged), K_VALUES, queries=asked), "label_metrics")
    return summary_out(metrics.summarize(m))


# ---------------------------------------------------------------- incremental / streaming
@register("incremental_encode")
def incremental_encode(spark, sf_dir):
    docs = fx.documents_corpus(spark, sf_dir)
    path = scratch_path(spark, "incremental_encode")
    # state left by an interrupted earlier run: one third of the corpus encoded
    first = encode.hash_encode(docs.where(F.col("doc_id") % 3 == 0), "doc_id", "contents")
    first.write.mode("overwrite").parquet(path)
    incremental.encode_missing(docs, path, id_col="doc_id", text_col="contents")
    return long_vectors(spark.read.parquet(path).select("doc_id", "embedding"))


def _land(docs, landing):
    """Four landed folders, as a producer would drop them, of files of about a bucket's size."""
    files = -(-tables.choose_buckets(docs, minimum=4) // 4)
    (docs.withColumn("part", F.col("doc_id") % 4).repartition(4 * files, "part", F.pmod(F.xxhash64("doc_id"), F.lit(files)))
         .write.mode("overwrite").partitionBy("part").parquet(landing))


@register("stream_encode")
def stream_encode(spark, sf_dir):
    docs = fx.documents_corpus(spark, sf_dir)
    landing = scratch_path(spark, "stream_landing")
    _land(docs, landing)
    out = scratch_path(spark, "stream_vectors")
    ckpt = scratch_path(spark, "stream_checkpoint")
    incremental.run_encode_stream(spark, landing, docs.schema, out, ckpt,
                                  id_col="doc_id", text_col="contents")
    return long_vectors(spark.read.parquet(out).select("doc_id", "embedding"))


@register("encode_retry")
def encode_retry(spark, sf_dir):
    """Failed documents keep their row, are left alone by a plain resume, and are encoded once when retried."""
    docs, path = fx.documents_corpus(spark, sf_dir), f"{scratch_path(spark, 'encode_retry')}/table"
    failing, healthy = MarkerFactory(QUARANTINE_MARKER), encode.HashingEncoderFactory(HASH_DIM)
    for factory, retry in ((failing, False), (healthy, False), (healthy, True), (healthy, True)):
        incremental.encode_missing(docs, path, encoder="model", encoder_factory=factory, retry_failed=retry)
    return spark.read.parquet(path).groupBy("doc_id").agg(
        F.count_if(F.col("status") == "ok").alias("n_ok"), F.count_if(F.col("status") == "error").alias("n_error"))


@register("stream_encode_pooled")
def stream_encode_pooled(spark, sf_dir):
    """The encoding stream with a model-shaped encoder, fed by landed files and run twice."""
    docs, landing = fx.documents_corpus(spark, sf_dir), scratch_path(spark, "pooled_landing")
    _land(docs, landing)
    out, state = f"{scratch_path(spark, 'pooled_vectors')}/table", scratch_path(spark, "pooled_checkpoint")
    for _ in range(2):
        incremental.run_encode_stream(spark, landing, docs.schema, out, state, encoder="model",
                                      encoder_factory=encode.PooledHashingEncoderFactory(SMALL_HASH_DIM))
    return long_vectors(spark.read.parquet(out).select("doc_id", "embedding"))


@register("corpus_jsonl_roundtrip")
def corpus_jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "corpus_jsonl")
    writers.write_corpus(_unified(spark, sf_dir), path, fmt="json")
    return readers.read_corpus(spark, path, fmt="json").select(*corpus_ops.CORPUS_COLUMNS)
