"""BM25 (Okapi) lexical retrieval as Spark tables.

Index build (once, storable as parquet):

* ``postings``     token, doc_id, tf, doc_len        explode + groupBy(doc, token)
* ``term_stats``   token, df, idf                    groupBy(token), map-side combined
* ``corpus_stats`` n_docs, n_tokens, avgdl, n_terms, avg_idf   (one row)

Scoring joins the (small) query-term table to postings on ``token`` - a
broadcast hash join after a size check, so postings are streamed, never
shuffled, and a hot token cannot pile up in one task - then sums per
``(qid, doc_id)`` and keeps the top k per query with a two-level window limit.

Formula: ``idf = ln(N - df + 0.5) - ln(df + 0.5)``; a negative idf is replaced
by ``epsilon * avg_idf`` (mean over all terms, negatives included);
``score = sum over query tokens (with repeats) of
idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * doc_len / avgdl))``.
Documents without tokens still count in N and in avgdl.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import lexical_text, tokens
from quarry.operators.topk import SCORE_PRECISION, top_k, top_k_by_score, ranked_score
from quarry.plans import sizing


@dataclass(frozen=True)
class Bm25Params:
    # Library defaults of the Okapi variant.
    k1: float = 1.5
    b: float = 0.75
    epsilon: float = 0.25


@dataclass
class Bm25Index:
    postings: DataFrame
    term_stats: DataFrame
    corpus_stats: DataFrame
    params: Bm25Params
    id_col: str = "doc_id"
    #: Posting lists by block of the same documents (``lexical_index.LexicalIndex``), if stored.
    lists: object = None

    def write(self, path: str, buckets: int | None = None,
              already_bucketed: bool = False) -> "Bm25Index":
        """Persist the index and return it re-opened from storage.

        ``postings`` is written bucketed by the document id (see
        ``sources.tables``); when the index was built from a corpus bucketed
        the same way, no shuffle is added.  Term and corpus statistics are then
        computed from the stored postings, so tokenization runs only once.
        """
        from quarry.sources import tables
        spark = self.postings.sparkSession
        n = buckets or tables.choose_buckets(self.postings)
        postings = tables.write_bucketed(self.postings, f"{path}/postings", self.id_col, n,
                                         already_bucketed=already_bucketed)
        dfreq_path = f"{path}/doc_freq"
        postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")) \
                .write.mode("overwrite").parquet(dfreq_path)
        dfreq = spark.read.parquet(dfreq_path)
        n_docs = self.corpus_stats.select("n_docs").scalar()
        term_stats, avg_idf = idf_table(dfreq, n_docs, self.params)
        term_stats.write.mode("overwrite").parquet(f"{path}/term_stats")
        term_stats = spark.read.parquet(f"{path}/term_stats")
        n_tokens = postings.agg(F.coalesce(F.sum("tf"), F.lit(0))).scalar()
        stats = (self.corpus_stats.select("n_docs")
                 .select("n_docs", n_tokens.alias("n_tokens"),
                         F.when(F.col("n_docs") > 0, n_tokens / F.col("n_docs")).alias("avgdl"),
                         dfreq.agg(F.count(F.lit(1))).scalar().alias("n_terms"),
                         avg_idf.alias("avg_idf")))
        stats.write.mode("overwrite").parquet(f"{path}/corpus_stats")
        return Bm25Index.read(spark, path, self.params, self.id_col)

    @classmethod
    def read(cls, spark, path: str, params: Bm25Params | None = None,
             id_col: str = "doc_id") -> "Bm25Index":
        from quarry.sources import tables
        return cls(postings=tables.register(spark, f"{path}/postings"),
                   term_stats=spark.read.parquet(f"{path}/term_stats"),
                   corpus_stats=spark.read.parquet(f"{path}/corpus_stats"),
                   params=params or Bm25Params(), id_col=id_col)


def default_text(corpus: DataFrame) -> Column:
    """``contents``, falling back to ``content`` when the corpus has both columns."""
    cols = set(corpus.columns)
    if {"contents", "content"} <= cols:
        return lexical_text()
    return F.coalesce(F.col("contents" if "contents" in cols else "content"), F.lit(""))


def document_tokens(corpus: DataFrame, id_col: str = "doc_id", text: Column | None = None) -> DataFrame:
    text = default_text(corpus) if text is None else text
    return corpus.select(F.col(id_col), tokens(text).alias("tokens"))


def doc_lengths(doc_tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return doc_tokens.select(id_col, F.size("tokens").cast("long").alias("doc_len"))


def term_frequencies(doc_tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, token, tf, doc_len); a document's tokens come from one row, so the
    partial aggregate before the shuffle already collapses repeats."""
    return (doc_tokens.select(id_col, F.size("tokens").cast("long").alias("doc_len"),
                              F.explode("tokens").alias("token"))
                      .groupBy(id_col, "token", "doc_len")
                      .agg(F.count(F.lit(1)).alias("tf"))
                      .select("token", id_col, "tf", "doc_len"))


def build_index(corpus: DataFrame, id_col: str = "doc_id", text: Column | None = None,
                params: Bm25Params | None = None) -> Bm25Index:
    params = params or Bm25Params()
    dt = document_tokens(corpus, id_col, text)
    postings = term_frequencies(dt, id_col)
    sizes = corpus.agg(F.count(F.lit(1)).alias("n_docs")).select(
        "n_docs", doc_lengths(dt, id_col).agg(F.coalesce(F.sum("doc_len"), F.lit(0))).scalar()
        .alias("n_tokens"))
    n_docs = sizes.select("n_docs").scalar()
    dfreq = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    term_stats, avg_idf = idf_table(dfreq, n_docs, params)
    corpus_stats = sizes.select(
        "n_docs", "n_tokens",
        F.when(F.col("n_docs") > 0, F.col("n_tokens") / F.col("n_docs")).alias("avgdl"),
        dfreq.agg(F.count(F.lit(1))).scalar().alias("n_terms"),
        avg_idf.alias("avg_idf"))
    return Bm25Index(postings, term_stats, corpus_stats, params, id_col)


def idf_table(dfreq: DataFrame, n_docs: Column, params: Bm25Params):
    """(token, df, idf) with the negative-idf floor, and the avg_idf scalar."""
    raw = dfreq.withColumn("idf_raw", F.log(n_docs - F.col("df") + F.lit(0.5))
                           - F.log(F.col("df") + F.lit(0.5)))
    avg_idf = raw.agg(F.avg("idf_raw")).scalar()
    term_stats = raw.select(
        "token", "df",
        F.when(F.col("idf_raw") < 0, F.lit(params.epsilon) * avg_idf)
         .otherwise(F.col("idf_raw")).alias("idf"))
    return term_stats, avg_idf


def query_terms(queries: DataFrame, qid_col: str = "qid", text_col: str = "question") -> DataFrame:
    """(qid, token, qtf): a token repeated in the query counts that many times."""
    return (queries.select(qid_col, F.explode(tokens(text_col)).alias("token"))
                   .groupBy(qid_col, "token")
                   .agg(F.count(F.lit(1)).alias("qtf")))


def _block_scores(index: Bm25Index, qt: DataFrame, qid_col: str) -> DataFrame:
    p = index.params
    weighted = F.broadcast(F.broadcast(qt).join(index.term_stats.select("token", "idf"), "token"))
    avgdl = index.corpus_stats.select("avgdl").scalar()
    tf, dl = F.col("tf"), F.col("doc_len")
    term = (F.col("qtf") * F.col("idf") * tf * F.lit(p.k1 + 1)
            / (tf + F.lit(p.k1) * (F.lit(1 - p.b) + F.lit(p.b) * dl / avgdl)))
    return (index.postings.join(weighted, "token")   # unknown tokens add 0
                 .groupBy(qid_col, index.id_col)
                 .agg(F.sum(term).alias("score")))


def query_blocks(qt: DataFrame, qid_col: str, max_bytes: int = sizing.DEFAULT_MAX_BYTES,
                 max_rows: int = sizing.DEFAULT_MAX_ROWS) -> list[DataFrame]:
    """Split the query-term table into hash blocks of queries that each fit the
    broadcast bound (one block in the common case)."""
    size = sizing.measure(qt, max_rows=10 * max_rows)
    n_blocks = max(1, -(-size.bytes // max_bytes), -(-size.rows // max_rows))
    if size.exceeded:  # more rows than even the probe read: split harder
        n_blocks *= 16
    if n_blocks == 1:
        return [qt]
    block = F.pmod(F.xxhash64(F.col(qid_col)), F.lit(n_blocks))
    return [qt.where(block == b) for b in range(n_blocks)]


def scores(index: Bm25Index, queries: DataFrame, qid_col: str = "qid",
           text_col: str = "question",
           max_broadcast_bytes: int = sizing.DEFAULT_MAX_BYTES) -> DataFrame:
    """(qid, doc_id, score) for every document sharing a token with the query.

    The query-term side is broadcast after a size check; a query set larger
    than the bound is split into blocks of whole queries, each broadcast, so the
    postings are never shuffled.  With postings bucketed by document the sum per
    (qid, doc) runs inside the scan task.
    """
    qt = query_terms(queries, qid_col, text_col)
    parts = [_block_scores(index, b, qid_col)
             for b in query_blocks(qt, qid_col, max_bytes=max_broadcast_bytes)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def top_k_lexical(index: Bm25Index, queries: DataFrame, k: int = 100, qid_col: str = "qid",
                  text_col: str = "question", pad_unmatched: bool = False,
                  corpus_ids: DataFrame | None = None,
                  precision: int | None = SCORE_PRECISION) -> DataFrame:
    """(qid, doc_id, score, rank), rank from 1.

    With stored posting lists blocks are searched with score bounds; else every
    posting of every query token is added up.  ``pad_unmatched``: when fewer than k documents share a token with a query,
    fill up with score-0 documents, lowest ids first (needs ``corpus_ids``).
    """
    if index.lists is not None:
        ranked = index.lists.top_k(queries, k, qid_col, text_col, precision, index.term_stats)
    else:
        ranked = top_k_by_score(scores(index, queries, qid_col, text_col), k, qid_col, index.id_col, precision=precision)
    if not pad_unmatched:
        return ranked
    if corpus_ids is None:
        raise ValueError("pad_unmatched needs corpus_ids")
    id_col = index.id_col
    # The first k ids of the corpus always hold enough unmatched documents.
    first_ids = (corpus_ids.select(id_col).orderBy(id_col).limit(k)
                           .agg(F.sort_array(F.collect_list(id_col))).scalar())
    matched = ranked.drop("rank")
    # Padding is used only when fewer than k documents match, and then all of them
    # are in ``matched``: the anti-join needs only that bounded (Q x k) table.
    pads = (queries.select(qid_col, F.explode(first_ids).alias(id_col))
                   .join(matched.select(qid_col, id_col), [qid_col, id_col], "left_anti")
                   .withColumn("score", F.lit(0.0)))
    n_matched = matched.groupBy(qid_col).agg(F.count(F.lit(1)).alias("_m"))
    pads = (top_k(pads, k, [qid_col], [F.col(id_col).asc()], "_pad_pos")
            .join(n_matched, qid_col, "left")
            .where(F.col("_pad_pos") <= F.lit(k) - F.coalesce(F.col("_m"), F.lit(0)))
            .select(qid_col, id_col, "score"))
    both = matched.select(qid_col, id_col, "score").unionByName(pads)
    return top_k(both, k, [qid_col],
                 [ranked_score("score", precision).desc(), F.col(id_col).asc()])
