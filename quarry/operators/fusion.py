"""Reciprocal rank fusion of any number of ranked lists.

``score(d) = sum over lists containing d of 1 / (rrf_k + rank)``, ranks from 1;
original scores are ignored.  The lists are unioned with their list number and
aggregated per ``(qid, doc_id)`` - no full outer joins, any number of lists.

Summation runs in list order (``aggregate`` over the sorted contributions) so
the double result is bit-stable.  Ties keep the order of first appearance:
earlier list first, then the rank inside it - what a stable sort over
insertion order gives.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.topk import top_k

# Fixed value: the fusion constant.
RRF_K = 60


def rrf(rankings: Sequence[DataFrame], k: int = 20, rrf_k: int = RRF_K,
        qid_col: str = "qid", id_col: str = "doc_id", rank_col: str = "rank") -> DataFrame:
    """(qid, doc_id, score, rank) of the fused list, first k per query."""
    if not rankings:
        raise ValueError("no rankings to fuse")
    parts = [r.select(qid_col, id_col, F.col(rank_col).cast("int").alias("_rank"),
                      F.lit(i).alias("_list"))
             for i, r in enumerate(rankings)]
    u = reduce(DataFrame.unionByName, parts)
    contrib = F.lit(1.0) / (F.lit(rrf_k) + F.col("_rank"))
    fused = u.groupBy(qid_col, id_col).agg(
        F.aggregate(F.array_sort(F.collect_list(F.struct(F.col("_list"), contrib.alias("c")))),
                    F.lit(0.0), lambda acc, x: acc + x["c"]).alias("score"),
        F.min(F.struct("_list", "_rank")).alias("_first"))
    order = [F.col("score").desc(), F.col("_first._list").asc(), F.col("_first._rank").asc()]
    return top_k(fused, k, [qid_col], order).select(qid_col, id_col, "score", "rank")
