"""Sinks: corpus, vectors, BM25 index, run and report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_corpus(corpus: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: str | None = "source") -> None:
    """One table partitioned by source replaces per-source files plus a combined copy."""
    out = corpus.withColumnRenamed("doc_id", "id") if fmt == "json" else corpus
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    getattr(w, fmt)(path)


def write_vectors(vectors: DataFrame, path: str, vec_col: str = "embedding",
                  float32: bool = True, mode: str = "overwrite") -> None:
    out = vectors.withColumn(vec_col, F.col(vec_col).cast("array<float>")) if float32 else vectors
    out.write.mode(mode).parquet(path)


def _laid_out(entries: DataFrame, order: Column, text: Column, brackets: str, path: str, per_file: int) -> None:
    """Files of one JSON array or object each, entries two spaces in and in order, of about ``per_file`` entries."""
    files = F.greatest(F.ceil(entries.agg(F.count(F.lit(1))).scalar() / per_file), F.lit(1)).cast("long")
    entry = F.struct(order.alias("order"), F.concat(F.lit("  "), F.regexp_replace(text, "\n", "\n  ")).alias("text"))
    dealt = entries.select(F.pmod(F.xxhash64(order), files).alias("file"), entry.alias("entry"))
    whole = dealt.groupBy("file").agg(F.array_sort(F.collect_list("entry")).alias("e"))
    body = F.concat(F.lit(brackets[0] + "\n"), F.array_join(F.col("e.text"), ",\n"), F.lit("\n" + brackets[1]))
    whole.select(body.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def write_json_array(df: DataFrame, path: str, order_by: str, per_file: int = 100_000) -> None:
    """Rows as JSON arrays of objects, laid out as the readers cut them."""
    _laid_out(df, F.col(order_by).cast("string"), F.to_json(F.struct(*df.columns), {"pretty": "true"}), "[]", path, per_file)


def write_json_object(df: DataFrame, path: str, key: str, per_file: int = 100_000) -> None:
    """Rows as JSON objects keyed by one column (one row per key)."""
    quoted = F.to_json(F.array(F.col(key).cast("string")))
    entry = F.to_json(F.struct(*[c for c in df.columns if c != key]), {"pretty": "true"})
    text = F.concat(F.substring(quoted, F.lit(2), F.char_length(quoted) - 2), F.lit(": "), entry)
    _laid_out(df, F.col(key).cast("string"), text, "{}", path, per_file)


def write_run(run: DataFrame, path: str, layout: str = "lines", queries_per_object: int = 1000,
              qid_col: str = "qid") -> None:
    """The run by query id, with the request (``full_question``) where the run has one.

    ``lines``: JSON lines, one object per query, sorted by query id across the
    part files.  ``object``: JSON objects keyed by query id, each on one line of
    a file of its own and of about ``queries_per_object`` queries, so files are
    written and read in parallel.  Spark's commit shows all files or none.
    """
    if layout == "lines":
        keep = [c for c in run.columns if c != "full_question" or run.schema[c].dataType != T.StringType()]
        by_id = F.col(qid_col).cast("string")
        run.select(*keep).repartitionByRange(by_id).sortWithinPartitions(by_id).write.mode("overwrite").json(path)
        return
    if layout != "object":
        raise ValueError(f"unknown layout {layout}")
    entry = [c for c in ("question", "full_question", "retriever", "latency_ms") if c in run.columns]
    quoted = F.to_json(F.array(F.col(qid_col).cast("string")))
    key = F.substring(quoted, F.lit(2), F.char_length(quoted) - 2)
    line = F.concat(key, F.lit(":"), F.to_json(F.struct(*entry, F.col("top_results").alias("top_20_results"))))
    files = F.greatest(F.ceil(run.agg(F.count(F.lit(1))).scalar() / queries_per_object), F.lit(1))
    dealt = run.select(F.pmod(F.xxhash64(qid_col), files.cast("long")).alias("file"), line.alias("line"))
    objects = dealt.groupBy("file").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    whole = F.concat(F.lit("{"), F.array_join("lines", ","), F.lit("}"))
    objects.select(whole.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report frame as JSON (``report.report_frame``)."""
    report.coalesce(1).write.mode("overwrite").json(path)
