"""Ranking metrics: Hit, MRR, Recall, DCG / IDCG / nDCG at several k.

Input: judged results (keys, rank, gain).  Positions are assigned by sorting on
``coalesce(rank, 999)`` (a missing rank sorts last); the metric position is
that sort position, not the stored rank.  The ideal order for IDCG sorts the
gains of the whole retrieved list descending, then cuts to k.

Per (keys) one aggregation computes, for every k at once:
  first_rel  = first position with gain >= 1 (0 if none)
  hit@k      = 1 if 0 < first_rel <= k else 0
  mrr@k      = 1 / first_rel if 0 < first_rel <= k else 0
  recall@k   = relevant in first k / relevant in the list   (null if none)
               (or / relevant in the gold set with ``gold_counts``)
  dcg@k      = sum gain / log2(pos + 1) over the first k  (linear gain)
  ndcg@k     = dcg@k / idcg@k                              (null if idcg = 0)
Output is long: (keys, metric, k, value).  Averages skip nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Default cut-offs, metric names, and the sort value of a missing rank.
K_VALUES = (5, 10, 20)
METRICS = ("hit", "mrr", "recall", "ndcg")
MISSING_RANK = 999


def ordered_gains(judged: DataFrame, keys: Sequence[str] = ("qid", "method"),
                  rank_col: str = "rank", gain_col: str = "gain",
                  tiebreak_col: str | None = None) -> DataFrame:
    """keys + pos + ipos + gain; ``ipos`` is the position in the ideal order."""
    keys = list(keys)
    order = [F.coalesce(F.col(rank_col), F.lit(MISSING_RANK))]
    if tiebreak_col:
        order.append(F.col(tiebreak_col))
    w = Window.partitionBy(*keys).orderBy(*order)
    wi = Window.partitionBy(*keys).orderBy(F.col(gain_col).desc(), *order)
    return judged.select(*keys, F.col(gain_col).alias("gain"),
                         F.row_number().over(w).alias("pos"),
                         F.row_number().over(wi).alias("ipos"))


def _discount(pos):
    return F.log2(pos + F.lit(1))


def per_query(gains: DataFrame, k_values: Sequence[int] = K_VALUES,
              keys: Sequence[str] = ("qid", "method"),
              gold_counts: DataFrame | None = None, gold_qid_col: str = "qid",
              metrics: Sequence[str] = METRICS, with_dcg: bool = False,
              queries: DataFrame | None = None) -> DataFrame:
    """(keys, metric, k, value) from ``ordered_gains`` output.

    ``gold_counts`` (qid, n_relevant) switches recall to the gold denominator.
    ``with_dcg`` adds the raw ``dcg`` and ``idcg`` rows.  ``queries`` (the keys)
    adds those without any result: hit and mrr 0, recall and ndcg null.
    """
    keys = list(keys)
    rel = F.col("gain") >= 1
    pos, ipos, gain = F.col("pos"), F.col("ipos"), F.col("gain").cast("double")
    aggs = [F.coalesce(F.min(F.when(rel, pos)), F.lit(0)).alias("first_rel"),
            F.count_if(rel).alias("num_rel")]
    for k in k_values:
        aggs += [F.count_if(rel & (pos <= k)).alias(f"rel_{k}"),
                 F.coalesce(F.sum(F.when((pos <= k) & (gain > 0), gain / _discount(pos))),
                            F.lit(0.0)).alias(f"dcg_{k}"),
                 F.coalesce(F.sum(F.when((ipos <= k) & (gain > 0), gain / _discount(ipos))),
                            F.lit(0.0)).alias(f"idcg_{k}")]
    per = gains.groupBy(*keys).agg(*aggs)
    if queries is not None:
        per = queries.select(*keys).distinct().join(per, keys, "left").fillna(
            0, [c for c in per.columns if c not in keys])
    denom = F.col("num_rel")
    if gold_counts is not None:
        per = per.join(gold_counts.withColumnRenamed(gold_qid_col, keys[0]), keys[0], "left")
        denom = F.coalesce(F.col("n_relevant"), F.lit(0))
    fr = F.col("first_rel")
    found = lambda k: (fr > 0) & (fr <= k)
    entries = []
    for k in k_values:
        value = {
            "hit": F.when(found(k), F.lit(1.0)).otherwise(F.lit(0.0)),
            "mrr": F.when(found(k), F.lit(1.0) / fr).otherwise(F.lit(0.0)),
            "recall": F.when(denom > 0, F.col(f"rel_{k}") / denom),
            "ndcg": F.when(F.col(f"idcg_{k}") > 0, F.col(f"dcg_{k}") / F.col(f"idcg_{k}")),
            "dcg": F.col(f"dcg_{k}"),
            "idcg": F.col(f"idcg_{k}"),
        }
        names = list(metrics) + (["dcg", "idcg"] if with_dcg else [])
        for m in names:
            entries.append(F.struct(F.lit(m).alias("metric"), F.lit(k).alias("k"),
                                    value[m].cast("double").alias("value")))
    return (per.select(*keys, F.explode(F.array(*entries)).alias("e"))
               .select(*keys, "e.metric", "e.k", "e.value"))


def gains_list(gains: DataFrame, keys: Sequence[str] = ("qid", "method"), n: int = 20) -> DataFrame:
    """First n gains per query in position order, as an array."""
    keys = list(keys)
    return gains.groupBy(*keys).agg(
        F.slice(F.transform(F.sort_array(F.collect_list(F.struct("pos", "gain"))),
                            lambda x: x["gain"]), 1, n).alias("gains"))


def summarize(metrics_q: DataFrame, group: Sequence[str] = ("method",),
              qid_col: str = "qid") -> DataFrame:
    """(group, metric, k, value = mean of non-null values, n_values, n_queries)."""
    group = list(group)
    s = metrics_q.groupBy(*group, "metric", "k").agg(F.avg("value").alias("value"),
                                                     F.count("value").alias("n_values"))
    if not group:
        return s.withColumn("n_queries", metrics_q.agg(F.countDistinct(qid_col)).scalar())
    nq = metrics_q.groupBy(*group).agg(F.countDistinct(qid_col).alias("n_queries"))
    return s.join(nq, group, "left")


def avg_latency(run: DataFrame, group: Sequence[str] = ("method",),
                latency_col: str = "latency_ms") -> DataFrame:
    """Mean latency over the queries that have one; null if none."""
    return run.groupBy(*group).agg(F.avg(latency_col).alias("avg_latency_ms"),
                                   F.count(F.lit(1)).alias("n_queries"))
