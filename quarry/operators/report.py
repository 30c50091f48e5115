"""Method comparison: improvement table, metric table, nested report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.metrics import K_VALUES


def improvement(summary: DataFrame, base_method: str, new_method: str,
                method_col: str = "method") -> DataFrame:
    """(metric, k, base, new, delta, pct) for pairs where both values exist.

    ``pct = delta / base * 100`` when ``base > 0``, else 0.
    """
    b = summary.where(F.col(method_col) == base_method).select(
        "metric", "k", F.col("value").alias("base"))
    n = summary.where(F.col(method_col) == new_method).select(
        "metric", "k", F.col("value").alias("new"))
    j = b.join(n, ["metric", "k"], "inner").where(F.col("base").isNotNull() & F.col("new").isNotNull())
    delta = F.col("new") - F.col("base")
    return j.select("metric", "k", "base", "new", delta.alias("delta"),
                    F.when(F.col("base") > 0, delta / F.col("base") * 100)
                     .otherwise(F.lit(0.0)).alias("pct"))


def metric_table(summary: DataFrame, k_values: Sequence[int] = K_VALUES,
                 method_col: str = "method") -> DataFrame:
    """Rows = (metric, method), one column ``at_<k>`` per cut-off (null = N/A)."""
    p = (summary.groupBy("metric", method_col).pivot("k", list(k_values))
                .agg(F.first("value")))
    return p.select("metric", method_col, *[F.col(str(k)).alias(f"at_{k}") for k in k_values])


def comparison(summary: DataFrame, latency: DataFrame | None, names: dict[str, str],
               method_col: str = "method") -> DataFrame:
    """Long comparison table: (method, name, metric, k, value, avg_latency_ms)."""
    label = F.create_map(*[x for kv in names.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    s = summary.where(F.col(method_col).isin(list(names))).select(
        method_col, label[F.col(method_col)].alias("name"), "metric", "k", "value")
    if latency is not None:
        s = s.join(latency.select(method_col, "avg_latency_ms"), method_col, "left")
    else:
        s = s.withColumn("avg_latency_ms", F.lit(None).cast("double"))
    return s


def report_frame(summary: DataFrame, latency: DataFrame | None, roles: dict[str, tuple[str, str]],
                 k_values: Sequence[int] = K_VALUES, evaluation_method: str = "auto_relevance",
                 method_col: str = "method") -> DataFrame:
    """One row shaped like the saved report:
    ``evaluation_method, k_values, <role>: {name, summary: {metric: {k: value}}, avg_latency_ms}``.

    ``roles`` maps a report key (e.g. ``baseline``) to (method, display name).
    The summary is tiny (methods x metrics x k), so nesting it is bounded.
    """
    per_metric = (summary.groupBy(method_col, "metric")
                         .agg(F.map_from_entries(F.collect_list(
                              F.struct(F.col("k").cast("string"), F.col("value")))).alias("by_k")))
    per_method = per_metric.groupBy(method_col).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "by_k"))).alias("summary"))
    if latency is not None:
        per_method = per_method.join(latency.select(method_col, "avg_latency_ms"), method_col, "left")
    else:
        per_method = per_method.withColumn("avg_latency_ms", F.lit(None).cast("double"))
    cols = []
    for role, (method, name) in roles.items():
        entry = F.first(F.when(F.col(method_col) == method,
                               F.struct(F.lit(name).alias("name"), "summary", "avg_latency_ms")),
                        ignorenulls=True)
        cols.append(entry.alias(role))
    return per_method.agg(F.lit(evaluation_method).alias("evaluation_method"),
                          F.array(*[F.lit(k) for k in k_values]).alias("k_values"), *cols)
