"""Readers with declared schemas (never inferred).

* corpus: JSON lines ``{id, title, content, contents}`` or parquet
* query set / request set: a JSON array of objects, read in splits
* run: per-query rows (JSON lines, the layout ``writers.write_run`` produces) or
  one JSON object keyed by query id (the single-file layout)
* gold labels: one JSON object ``qid -> {manually_selected_top_5: [{id, relevance_score}]}``
* vectors: parquet ``(doc_id, embedding array<float>)``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORPUS_JSON_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("contents", T.StringType()),
])

QUERY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("question", T.StringType()),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("options", T.MapType(T.StringType(), T.StringType())),
    T.StructField("answer", T.StringType()),
])

RESULT_ITEM = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
])

RUN_ENTRY = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("full_question", REQUEST_SCHEMA),
    T.StructField("retriever", T.StringType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("top_20_results", T.ArrayType(RESULT_ITEM)),
])

GOLD_ENTRY = T.StructType([
    T.StructField("manually_selected_top_5", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("relevance_score", T.DoubleType()),
    ]))),
])


def read_corpus(spark: SparkSession, path: str, fmt: str = "json", source: str | None = None) -> DataFrame:
    """Corpus table: ``doc_id, source, title, content, contents``."""
    if fmt == "json":
        schema = CORPUS_JSON_SCHEMA
        df = spark.read.schema(schema.add("source", T.StringType())
                               if source is None else schema).json(path)
        if "source" not in df.columns or source is not None:
            df = df.withColumn("source", F.lit(source))
        return df.withColumnRenamed("id", "doc_id")
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown format {fmt}")


def _records(spark: SparkSession, path: str, opening: str, schema: T.DataType, indent: int) -> DataFrame:
    """``v``: the parsed records of JSON arrays or objects, read in splits.

    A file laid out with ``indent`` spaces is cut where an entry of the outermost
    level closes (a line feed, the indent, brace and comma occur nowhere else), so
    large files are read by many tasks.  A record lacks its closing brace, but for
    the last one; a file laid out otherwise is one record.
    """
    raw = spark.read.option("lineSep", "\n" + " " * indent + "},").text(path).where(F.trim("value") != "")
    body = F.concat(F.lit(opening), F.regexp_replace("value", r"^\s*" + ("\\[" if opening == "[" else "\\{(?=\\s*[\"}])"), ""))
    closed = F.concat(body, F.lit("}" + ("]" if opening == "[" else "}")))
    return raw.select(F.coalesce(F.from_json(closed, schema), F.from_json(body, schema)).alias("v"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, indent: int = 2) -> DataFrame:
    """The elements of JSON arrays of objects, as rows."""
    got = _records(spark, path, "[", T.ArrayType(schema), indent)
    return got.select(F.inline("v"))


def read_json_object(spark: SparkSession, path: str, entry: T.StructType, indent: int = 2) -> DataFrame:
    """``key, e``: the entries of JSON objects of objects."""
    got = _records(spark, path, "{", T.MapType(T.StringType(), entry), indent)
    return got.select(F.explode("v").alias("key", "e"))


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of ``{id, question}`` -> ``(qid, question)``."""
    return read_json_array(spark, path, QUERY_SCHEMA).select(F.col("id").alias("qid"), "question")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of ``{id, question, options, answer}`` -> ``(qid, question, options, answer)``."""
    return read_json_array(spark, path, REQUEST_SCHEMA).select(F.col("id").alias("qid"), "question", "options", "answer")


def read_run(spark: SparkSession, path: str, layout: str = "lines", method: str | None = None) -> DataFrame:
    """Run table ``(qid, question, full_question, method, retriever, latency_ms, num_results, top_results)``.

    ``lines``: one query per line.  ``object``: a file is one JSON object keyed by
    query id, laid out over many lines and read in splits.  ``object_lines``: such objects on a line
    each (as ``write_run`` writes them), read in splits.
    """
    if layout == "lines":
        return spark.read.schema(RUN_LINE_SCHEMA).json(path)
    if layout in ("object", "object_lines"):
        if layout == "object":
            parsed = read_json_object(spark, path, RUN_ENTRY).withColumnRenamed("key", "qid")
        else:
            parsed = spark.read.text(path).select(
                F.explode(F.from_json("value", T.MapType(T.StringType(), RUN_ENTRY))).alias("qid", "e"))
        return parsed.select(
            "qid", "e.question", "e.full_question", F.lit(method).cast("string").alias("method"), "e.retriever",
            "e.latency_ms", F.size("e.top_20_results").alias("num_results"),
            F.col("e.top_20_results").alias("top_results"))
    raise ValueError(f"unknown layout {layout}")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """``(qid, id, relevance_score, pos)``; entries without an id are dropped."""
    per_q = read_json_object(spark, path, GOLD_ENTRY).withColumnRenamed("key", "qid")
    items = per_q.select("qid", F.posexplode("e.manually_selected_top_5").alias("pos", "g"))
    return (items.where(F.col("g.id").isNotNull())
                 .select("qid", F.col("g.id").alias("id"),
                         F.coalesce(F.col("g.relevance_score"), F.lit(0)).alias("relevance_score"),
                         "pos"))


def read_report(spark: SparkSession, path: str, roles: Sequence[str] = ("baseline", "rrf2")) -> DataFrame:
    """A stored report as ``(role, name, metric, k, value, avg_latency_ms)``."""
    entry = "struct<name:string,summary:map<string,map<string,double>>,avg_latency_ms:double>"
    saved = spark.read.schema(", ".join(f"`{r}` {entry}" for r in roles)).json(path)
    each = saved.select(F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"`{r}`").alias("e")) for r in roles])).alias("x"))
    by_metric = each.select("x.role", "x.e.name", F.explode("x.e.summary").alias("metric", "by_k"), "x.e.avg_latency_ms")
    return by_metric.select("role", "name", "metric", F.explode("by_k").alias("k", "value"), "avg_latency_ms").select(
        "role", "name", "metric", F.col("k").cast("int").alias("k"), "value", "avg_latency_ms")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


RUN_LINE_SCHEMA = T.StructType([
    T.StructField("qid", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("full_question", REQUEST_SCHEMA),
    T.StructField("method", T.StringType()),
    T.StructField("retriever", T.StringType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("num_results", T.IntegerType()),
    T.StructField("top_results", T.ArrayType(RESULT_ITEM)),
])
