"""Retrieval API over a table of queries: bm25, dense, or fused.

``retrieve`` returns the ranking (qid, doc_id, score, rank, method);
``format_results`` attaches the document fields (rank, score, id, title,
snippet, full content); ``build_run`` nests the results per query next to the
question, the request and the latency; ``flatten_run`` undoes the nesting.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.text import snippet
from quarry.operators import bm25 as bm25_ops
from quarry.operators import dense as dense_ops
from quarry.operators.fusion import RRF_K, rrf
from quarry.plans import sizing
from quarry.session import materialize

# Method names accepted and the retriever label reported for each.
METHOD_ALIASES = {"bm25": "bm25", "dense": "dense", "medcpt": "dense", "rrf": "rrf", "rrf2": "rrf"}
RETRIEVER_NAMES = {"bm25": "BM25", "dense": "Dense", "rrf": "RRF-2 (BM25 + Dense)"}


def canonical_method(method: str) -> str:
    try:
        return METHOD_ALIASES[method]
    except KeyError:
        raise ValueError(f"Unknown method: {method}") from None


def retrieve(queries: DataFrame, *, method: str = "rrf", k: int = 20, depth: int = 100,
             bm25_index: bm25_ops.Bm25Index | None = None,
             doc_vectors: DataFrame | None = None, query_vectors: DataFrame | None = None,
             rrf_k: int = RRF_K, qid_col: str = "qid", text_col: str = "question",
             id_col: str = "doc_id", vec_col: str = "embedding",
             pad_unmatched: bool = False, corpus_ids: DataFrame | None = None) -> DataFrame:
    """Rank documents for every query at once.

    ``bm25`` / ``dense``: top k of that retriever.  ``rrf``: each retriever to
    ``depth``, fused, first k kept.
    """
    m = canonical_method(method)

    def lexical(n):
        if bm25_index is None:
            raise ValueError("bm25 needs bm25_index")
        return bm25_ops.top_k_lexical(bm25_index, queries, k=n, qid_col=qid_col,
                                      text_col=text_col, pad_unmatched=pad_unmatched,
                                      corpus_ids=corpus_ids)

    def semantic(n):
        if doc_vectors is None or query_vectors is None:
            raise ValueError("dense needs doc_vectors and query_vectors")
        return dense_ops.topk(doc_vectors, query_vectors, k=n, id_col=id_col, qid_col=qid_col,
                              vec_col=vec_col)

    if m == "bm25":
        out = lexical(k)
    elif m == "dense":
        out = semantic(k)
    else:
        out = rrf([lexical(depth), semantic(depth)], k=k, rrf_k=rrf_k, qid_col=qid_col,
                  id_col=id_col)
    return out.select(qid_col, id_col, "score", "rank", F.lit(m).alias("method"))


def format_results(ranking: DataFrame, corpus: DataFrame, id_col: str = "doc_id",
                   snippet_chars: int = 500) -> DataFrame:
    """Join the ranked ids to the corpus (the ranking side is broadcast when small,
    so the corpus is streamed once and never shuffled)."""
    docs = corpus.select(F.col(id_col), "title", "content")
    side = sizing.broadcast_if_small(ranking)
    joined = side.join(docs, id_col, "inner")
    return joined.select(*[c for c in ranking.columns],
                         F.col(id_col).cast("string").alias("id"), "title",
                         snippet("content", snippet_chars).alias("content"),
                         F.col("content").alias("full_content"))


def timed(ranking: DataFrame, queries: DataFrame, name: str = "run", qid_col: str = "qid") -> tuple[DataFrame, dict]:
    """Runs a ranking and measures it: the ranking as stored, and what the run took.

    The rows of the one job that computes and writes the ranking are counted
    where they pass (``Observation``); its wall time is shared by all queries
    asked, so ``latency_ms`` is a query's share of the batch.
    """
    watch = Observation(name)
    n = queries.select(qid_col).count()
    start = time.perf_counter()
    stored = materialize(ranking.observe(watch, F.count(F.lit(1)).alias("n_results")), "timed_run")
    wall = 1000 * (time.perf_counter() - start)
    return stored, {"n_queries": n, "n_results": watch.get["n_results"], "wall_ms": wall, "latency_ms": wall / max(n, 1)}


RESULT_STRUCT = ["rank", "score", "id", "title", "content"]


def build_run(results: DataFrame, queries: DataFrame, requests: DataFrame | None = None,
              latency_ms=None, qid_col: str = "qid", question_col: str = "question",
              methods: Sequence[str] | None = None) -> DataFrame:
    """One row per query: question, request, retriever, latency_ms, top_results.

    A query without results has an empty list, under each of ``methods`` (by
    default all methods of ``results``).

    ``requests`` is joined on the query id (left join), never by position.
    ``latency_ms``: a number or a Column; null when absent.
    """
    per_q = results.groupBy(qid_col, "method").agg(
        F.sort_array(F.collect_list(F.struct(*RESULT_STRUCT))).alias("top_results"))
    asked = queries.select(qid_col, question_col)
    if methods is None:
        asked = asked.withColumn("method", F.explode_outer(results.agg(F.collect_set("method")).scalar()))
    else:
        asked = asked.withColumn("method", F.explode(F.array(*[F.lit(canonical_method(m)) for m in methods])))
    empty = F.array().cast(per_q.schema["top_results"].dataType)
    run = asked.join(per_q, [qid_col, "method"], "left").withColumn("top_results", F.coalesce("top_results", empty))
    if requests is not None:
        req_cols = [c for c in requests.columns if c != qid_col]
        run = run.join(requests.select(qid_col, F.struct(*req_cols).alias("full_question")),
                       qid_col, "left")
    else:
        run = run.withColumn("full_question", F.lit(None).cast("string"))
    names = F.create_map(*[x for kv in RETRIEVER_NAMES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    lat = latency_ms if isinstance(latency_ms, F.Column) else F.lit(latency_ms).cast("double")
    return run.select(qid_col, question_col, "full_question", "method",
                      names[F.col("method")].alias("retriever"), lat.alias("latency_ms"),
                      F.size("top_results").alias("num_results"), "top_results")


def flatten_run(run: DataFrame, qid_col: str = "qid") -> DataFrame:
    """One row per result; a query without results keeps one row with a null result."""
    keep = [c for c in run.columns if c not in ("top_results", "full_question")]
    return (run.select(*keep, F.posexplode_outer("top_results").alias("_pos", "r"))
               .select(*keep, "_pos", "r.*"))
