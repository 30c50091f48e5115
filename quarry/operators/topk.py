"""Per-group top-k by window ``row_number``.

``row_number() <= k`` is planned by Catalyst as a partial ``WindowGroupLimit``
before the shuffle and a final one after it, so each task forwards at most k
rows per group: the top-k of a hot group never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: scores are compared at 6 decimals before ties are broken by id,
# so rankings do not depend on summation order or partitioning.
SCORE_PRECISION = 6


def ranked_score(score: str = "score", precision: int | None = SCORE_PRECISION) -> Column:
    col = F.col(score)
    return col if precision is None else F.round(col, precision)


def top_k(df: DataFrame, k: int, partition_by: Sequence[str], order_by: Sequence[Column],
          rank_col: str = "rank") -> DataFrame:
    if k < 1:
        raise ValueError("k must be at least 1")
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) <= k))


def top_k_by_score(df: DataFrame, k: int, qid_col: str = "qid", id_col: str = "doc_id",
                   score_col: str = "score", precision: int | None = SCORE_PRECISION,
                   rank_col: str = "rank") -> DataFrame:
    """Top k per query: rounded score descending, then id ascending."""
    order = [ranked_score(score_col, precision).desc(), F.col(id_col).asc()]
    return top_k(df, k, [qid_col], order, rank_col)
