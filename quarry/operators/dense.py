"""Exact dense (inner-product) retrieval and vector-table checks.

Exhaustive search is a block join with a two-level top-k; neither side passes
through the driver:

1. Documents are dealt into hash blocks of at most ``BLOCK_BYTES`` on average,
   queries likewise, and every pair of a document block and a query block is one
   co-group.  ``store_blocks`` writes the document side dealt and bucketed by
   block, so that searches of up to one query block read it without a shuffle;
   a larger query set copies the documents once per further query block.
2. A co-group is a matrix product in single precision over Arrow buffers, walked
   in tiles that stay in cache.  Its error is bounded, so that only pairs which
   may still be among a query's k best are multiplied again in double precision
   and ranked: at most k rows per query and block.
3. A window ``row_number() <= k`` per query (partial limit before the shuffle).

Order is (score rounded to ``precision``) descending, then id ascending - the
same rule at every level, so the result equals a full sort.  No pair scores
leave the task except the per-block top k.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.vectors import l2_norm, l2_normalize
from quarry.operators.topk import SCORE_PRECISION, top_k_by_score

BLOCK_BYTES = 32 * 1024 * 1024
MATRIX_BYTES = 64 * 1024 * 1024
#: Queries and documents of a tile, and its groups of documents, whose maxima are looked at first.
TILE_QUERIES, TILE_DOCS, TILE_GROUPS = 128, 8192, 256
#: No scaled score is below its negative.
MOST = np.float32(1e30)
BLOCK = "_block"


def normalize(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """L2-normalize a vector column (array<double>); zero vectors stay zero."""
    return df.withColumn(vec_col, l2_normalize(vec_col))


def _batch_top(S: np.ndarray, ids_sorted: np.ndarray, k: int):
    """Exact top-k per column of S (rows already sorted by id)."""
    n = S.shape[0]
    kk = min(k, n)
    kth = -np.partition(-S, kk - 1, axis=0)[kk - 1]          # k-th largest per column
    above = S > kth
    need = kk - above.sum(axis=0)                            # slots left for ties
    at = S == kth
    take = above | (at & (np.cumsum(at, axis=0) <= need))    # lowest ids among ties
    rows, cols = np.nonzero(take)
    return cols, S[rows, cols], ids_sorted[rows]


def _all_scores(D: np.ndarray, Q: np.ndarray, k: int, precision: int | None, own: tuple[np.ndarray, np.ndarray] | None):
    """(query, row, score) of the k best rows of ``D`` per query from every score in double precision; for values that are not finite."""
    found = []
    # score matrix bounded to ~MATRIX_BYTES: walk the queries in column chunks
    step = max(1, MATRIX_BYTES // (8 * len(D)))
    for lo in range(0, len(Q), step):
        S = D @ Q[lo:lo + step].T
        if precision is not None:
            S = np.round(S, precision)
        if own is not None:
            for q, (a, b) in enumerate(zip(own[0][lo:lo + step], own[1][lo:lo + step])):
                S[a:b, q] = -np.inf
        c, scores, rows = _batch_top(S, np.arange(len(D)), k)
        fine = np.isfinite(scores)
        found.append((c[fine] + lo, rows[fine], scores[fine]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _unit(M: np.ndarray, axis: int | None) -> tuple[np.ndarray, np.ndarray]:
    """``M`` by rows (``axis`` 1) or as a whole divided by its largest absolute value, in single precision, and that value."""
    most = np.abs(M).max(axis=axis, keepdims=True, initial=0.0)
    most = np.where(most > 0, most, 1.0)
    return (M / most).astype(np.float32), most


def _nearest(D: np.ndarray, Q: np.ndarray, k: int, precision: int | None, own: tuple[np.ndarray, np.ndarray] | None):
    """(query, row, score) of the k best rows of ``D`` per query: by score, then by row.  ``own``: a query's rows to leave out.

    A product of whole vectors in single precision is off by at most (d + 2) * 2**-24 of the product of their lengths;
    twice that is allowed here.  Rows that this cannot rule out are scored in double precision.
    """
    n, d = D.shape
    D32, unit = _unit(D, None)
    Q32, units = _unit(Q, 1)
    groups = max(TILE_GROUPS, 4 * k)
    width = -(-min(TILE_DOCS, n) // groups)
    tile = groups * width
    DT = np.zeros((d, -(-n // tile) * tile), np.float32)
    DT[:, :n] = D32.T
    lengths = np.sqrt(np.einsum("ij,ij->i", D32, D32, dtype=np.float64).max()) * np.sqrt(np.einsum("ij,ij->i", Q32, Q32, dtype=np.float64))
    error = (d + 4) * 2.0 ** -23 * lengths + d * 1e-37
    with np.errstate(over="ignore", divide="ignore"):
        shown = np.zeros(len(Q)) if precision is None else 10.0 ** -precision / units[:, 0] / unit[0, 0]
    found = []
    for lo in range(0, len(Q), TILE_QUERIES):
        asked = slice(lo, min(lo + TILE_QUERIES, len(Q)))
        m = asked.stop - lo
        last = np.full(m, -np.inf)  # the k-th best score so far; a later row must beat it
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for at in range(0, n, tile):
            S = Q32[asked] @ DT[:, at:at + tile]
            S[:, n - at:] = -np.inf
            if own is not None:
                for q in np.flatnonzero((own[0][asked] < at + tile) & (own[1][asked] > at)):
                    S[q, max(own[0][lo + q] - at, 0):max(own[1][lo + q] - at, 0)] = -np.inf
            S = S.reshape(m, width, groups)
            most = S.max(axis=1)
            floor = np.partition(most, groups - k, axis=1)[:, groups - k] - 2 * error[asked] - shown[asked]
            with np.errstate(over="ignore"):
                floor = np.maximum(floor, last / units[asked, 0] / unit[0, 0] - error[asked])
                # Compared in single precision: the next number below, so that nothing is lost; rows left out are below all.
                floor = np.nextafter(np.maximum(floor, -MOST).astype(np.float32), np.float32(-np.inf))
            floor = np.maximum(floor, -MOST)
            q, group = np.nonzero(most >= floor[:, None])
            pair, step = np.nonzero(S[q, :, group] >= floor[q][:, None])
            q, row = q[pair], at + step * groups + group[pair]
            score = _scores(D, Q, q + lo, row, asked, slice(at, min(at + tile, n)))
            if precision is not None:
                score = np.round(score, precision)
            fine = np.isfinite(score) & (score > last[q])
            best = tuple(np.r_[a, b[fine]] for a, b in zip(best, (q, row, score)))
            if fine.any():
                order = np.lexsort((best[1], -best[2], best[0]))
                q, row, score = (x[order] for x in best)
                first = np.searchsorted(q, np.arange(m + 1))
                kept = np.arange(len(q)) - first[q] < k
                best = q[kept], row[kept], score[kept]
                full = np.flatnonzero(np.diff(first) >= k)
                last[full] = score[first[full] + k - 1]
        found.append((best[0] + lo, best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _scores(D: np.ndarray, Q: np.ndarray, q: np.ndarray, row: np.ndarray, asked: slice, rows: slice) -> np.ndarray:
    """The products of pairs of ``q`` and ``row``, all of one tile; at once if they are many."""
    if len(q) * 64 > (asked.stop - asked.start) * (rows.stop - rows.start):
        return (Q[asked] @ D[rows].T)[q - asked.start, row - rows.start]
    step = max(1, MATRIX_BYTES // (16 * D.shape[1]))
    parts = [np.einsum("ij,ij->i", Q[q[i:i + step]], D[row[i:i + step]]) for i in range(0, len(q), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _places(ids: np.ndarray, qids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From where to where the sorted ``ids`` equal each of ``qids``; an unknown id (NaN) equals none."""
    lo, hi = np.searchsorted(ids, qids, "left"), np.searchsorted(ids, qids, "right")
    return lo, np.where(qids == qids, hi, lo)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The rows of an array<double> column; all must have one length."""
    arrays = column.combine_chunks()
    values = arrays.flatten().to_numpy(zero_copy_only=False)
    if len(values) % max(len(arrays), 1) or len(set(arrays.value_lengths().unique().to_pylist())) > 1:
        raise ValueError("vectors of unequal length")
    return values.reshape(len(arrays), -1)


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks().to_numpy(zero_copy_only=False)
    return values.astype(str) if values.dtype == object else values


def block_topk_fn(k: int, id_col: str, vec_col: str, qid_col: str, precision: int | None,
                  exclude_self: bool):
    """Co-group function: the k best documents of one block for each query of one block."""
    def run(docs: pa.Table, queries: pa.Table) -> pa.Table:
        names = [qid_col, id_col, "score"]
        kinds = [queries.schema.field(qid_col).type, docs.schema.field(id_col).type, pa.float64()]
        if not docs.num_rows or not queries.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        ids, qids = _keys(docs.column(id_col)), _keys(queries.column(qid_col))
        order = np.argsort(ids, kind="stable")
        D, Q = _matrix(docs.column(vec_col))[order], _matrix(queries.column("_qv"))
        if D.shape[1] != Q.shape[1]:
            raise ValueError("documents and queries have vectors of unequal length")
        own = _places(ids[order], qids) if exclude_self else None
        search = _nearest if np.isfinite(D).all() and np.isfinite(Q).all() else _all_scores
        c, rows, scores = search(D, Q, k, precision, own)
        rows = order[rows]
        return pa.table([queries.column(qid_col).take(pa.array(c)), docs.column(id_col).take(pa.array(rows)),
                         pa.array(scores, pa.float64())], names=names)
    return run


def _block_of(key: str, rows: Column, dim: Column | int, bytes_per_block: int, least: int = 1) -> Column:
    n = F.greatest(F.ceil(rows * dim * 8 / bytes_per_block), F.lit(least)).cast("long")
    return F.pmod(F.xxhash64(F.col(key)), n)


def store_blocks(vectors: DataFrame, path: str, *, id_col: str = "doc_id", vec_col: str = "embedding",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The vectors as a table dealt into hash blocks and bucketed by them; ``topk`` reads it without a shuffle.

    Four blocks to a bucket and more, so that buckets come out even.
    """
    from quarry.sources import tables
    buckets = tables.choose_buckets(vectors)
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec_col)).alias("d"))
    block = _block_of(id_col, shape.select("n").scalar(), F.coalesce(shape.select("d").scalar(), F.lit(1)),
                      block_bytes, 4 * buckets)
    dealt = vectors.select(F.col(id_col), F.col(vec_col).cast("array<double>").alias(vec_col), block.alias(BLOCK))
    return tables.write_bucketed(dealt, path, BLOCK, buckets)


def topk(doc_vectors: DataFrame, query_vectors: DataFrame, k: int = 100, *,
         id_col: str = "doc_id", qid_col: str = "qid", vec_col: str = "embedding",
         query_vec_col: str | None = None, precision: int | None = SCORE_PRECISION,
         exclude_self: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(qid, doc_id, score, rank): exact inner-product top k per query.

    Vectors are used as given (normalize both sides first for cosine).  Rows with
    a null vector are skipped.  Fewer than k rows when the table is smaller.
    ``doc_vectors`` may be a table of ``store_blocks``.  Vectors of unequal
    length raise ``ValueError``.
    """
    spark = doc_vectors.sparkSession
    qcol = query_vec_col or vec_col
    qv = query_vectors.where(F.col(qcol).isNotNull()).select(
        F.col(qid_col), F.col(qcol).cast("array<double>").alias("_qv"))
    shape = qv.agg(F.count(F.lit(1)).alias("q"), F.max(F.size("_qv")).alias("d")).first()
    dim = max(int(shape["d"] or 0), 1)
    q_blocks = max(1, math.ceil(int(shape["q"]) * dim * 8 / block_bytes))
    if BLOCK in doc_vectors.columns:
        docs = doc_vectors
        last = docs.agg(F.coalesce(F.max(BLOCK), F.lit(-1))).scalar()
    else:
        least = spark.sparkContext.defaultParallelism
        rows = doc_vectors.agg(F.count(F.lit(1))).scalar()
        docs = doc_vectors.withColumn(BLOCK, _block_of(id_col, rows, dim, block_bytes, least))
        last = F.greatest(F.ceil(rows * dim * 8 / block_bytes), F.lit(least)) - 1
    docs = docs.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col), F.col(vec_col).cast("array<double>").alias(vec_col), BLOCK)
    every = F.sequence(F.lit(0).cast("long"), last.cast("long"))
    qv = qv.withColumn(BLOCK, F.explode(F.when(last >= 0, every)))
    deal = [BLOCK]
    if q_blocks > 1:
        deal.append("_qblock")
        docs = docs.withColumn("_qblock", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        qv = qv.withColumn("_qblock", F.pmod(F.xxhash64(qid_col), F.lit(q_blocks)).cast("int"))
    out_schema = T.StructType([query_vectors.schema[qid_col], doc_vectors.schema[id_col],
                               T.StructField("score", T.DoubleType())])
    cand = docs.groupBy(*deal).cogroup(qv.groupBy(*deal)).applyInArrow(
        block_topk_fn(k, id_col, vec_col, qid_col, precision, exclude_self), out_schema)
    return top_k_by_score(cand, k, qid_col, id_col, precision=precision)


def coverage(corpus: DataFrame, vectors: DataFrame, id_col: str = "doc_id",
             vec_col: str = "embedding", status_col: str | None = "status") -> DataFrame:
    """One row: documents, vectors, missing (no vector), orphan (no document),
    error (quarantined) and zero vectors.  One full-outer join on the id."""
    v = vectors.select(id_col, F.col(vec_col).alias("_v"),
                       (F.col(status_col) if status_col and status_col in vectors.columns
                        else F.lit("ok")).alias("_st"), F.lit(True).alias("_has_v"))
    c = corpus.select(id_col, F.lit(True).alias("_has_d"))
    j = c.join(v, id_col, "full_outer")
    has_d, has_v = F.col("_has_d").isNotNull(), F.col("_has_v").isNotNull()
    return j.agg(
        F.count_if(has_d).alias("n_docs"),
        F.count_if(has_v).alias("n_vectors"),
        F.count_if(has_d & ~has_v).alias("missing"),
        F.count_if(has_v & ~has_d).alias("orphan"),
        F.count_if(has_v & ((F.col("_st") != "ok") | F.col("_v").isNull())).alias("errors"),
        F.count_if(has_v & F.col("_v").isNotNull() & (l2_norm("_v") == 0)).alias("zero_vectors"),
    )
