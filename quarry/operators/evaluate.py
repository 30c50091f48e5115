"""Single-run evaluation: judged gains -> per-query metrics -> summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from quarry.operators import metrics, relevance


@dataclass
class Evaluation:
    gains: DataFrame          # qid, method, pos, ipos, gain
    per_query: DataFrame      # qid, method, metric, k, value
    summary: DataFrame        # method, metric, k, value, n_values, n_queries
    gains_list: DataFrame     # qid, method, gains (first 20)


def evaluate(results: DataFrame, *, rules: DataFrame | None = None, gold: DataFrame | None = None,
             k_values: Sequence[int] = metrics.K_VALUES, qid_col: str = "qid",
             id_col: str = "id", gold_id_col: str = "id", gold_denominator: bool = False,
             queries: DataFrame | None = None) -> Evaluation:
    """Evaluate a result table (qid, method, rank, id, title, content).

    ``rules`` given: keyword relevance; else gold labels (``ValueError`` when
    ``gold`` is missing).  ``gold_denominator`` uses the number of relevant gold
    entries per query for recall instead of the relevant count in the list.
    Queries without results count: those of ``queries`` (qid, method), by
    default all of ``results``, where such a query has a row with a null id.
    """
    asked = (queries if queries is not None else results).select(qid_col, "method")
    results = results.where(f"`{id_col}` IS NOT NULL")
    if rules is not None:
        judged = relevance.keyword_gains(results, rules, qid_col)
    else:
        judged = relevance.gold_gains(results, gold, qid_col, id_col, gold_id_col)
    keys = [qid_col, "method"]
    # equal or missing ranks keep the list order of the run (a stable sort)
    tiebreak = "_pos" if "_pos" in judged.columns else id_col
    gains = metrics.ordered_gains(judged, keys, tiebreak_col=tiebreak)
    counts = None
    if gold_denominator and gold is not None:
        from pyspark.sql import functions as F
        counts = (relevance.dedup_gold(gold, [qid_col, gold_id_col])
                  .where(F.col("relevance_score") >= 1)
                  .groupBy(qid_col).agg(F.count(F.lit(1)).alias("n_relevant")))
    per_q = metrics.per_query(gains, k_values, keys, gold_counts=counts, gold_qid_col=qid_col,
                              queries=asked)
    return Evaluation(gains=gains, per_query=per_q,
                      summary=metrics.summarize(per_q, ("method",), qid_col),
                      gains_list=metrics.gains_list(gains, keys))
