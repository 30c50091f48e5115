"""Mapping of the driver's tables onto the engine's table contracts.

* ``documents``      -> corpus (doc_id, source, title = first line, content = contents = text)
* ``pages``          -> second corpus source, ids prefixed ``page_``, title = url
* ``benchmark``      -> queries (qid = item_id, question = text)
* ``conversations``  -> second query set: user turns
* ``labels``         -> graded gold: 2 if quality and not toxic, 1 if quality and toxic
* ``embeddings``     -> vectors (vec_id, embedding, label)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import first_line, tokens
from quarry.operators.corpus import map_source


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_corpus(table(spark, sf_dir, "documents"))


def as_corpus(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.lit("documents").alias("source"),
                    first_line("text").alias("title"),
                    F.col("text").alias("content"), F.col("text").alias("contents"))


def documents_as_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with string ids, ready for the union with other sources."""
    return documents_corpus(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("string"))


def pages_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_source(table(spark, sf_dir, "pages"), id_col="page_id", title_col="url",
                      content_col="html", source="pages", id_prefix="page_")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"),
                                                    F.col("text").alias("question"))


def conversation_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "user").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("qid"),
        F.col("text").alias("question"))


def conversation_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests keyed like the user turns: the assistant turn that answers each one."""
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "assistant").select(
        F.concat_ws(":", F.col("conv_id").cast("string"),
                    (F.col("turn") - 1).cast("string")).alias("qid"),
        F.col("text").alias("answer"))


def label_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, relevance_score) for every labelled document; applies to every query."""
    lab = table(spark, sf_dir, "labels")
    score = (F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
              .when((F.col("quality") == 1) & (F.col("toxic") == 1), 1)
              .otherwise(0))
    return lab.select("doc_id", score.cast("int").alias("relevance_score"))


def benchmark_keyword_rules(spark: SparkSession, sf_dir: str, term_stats: DataFrame, avg_idf: Column) -> DataFrame:
    """(qid, tier, keyword): decisive = the whole text lower-cased; supportive = the distinct tokens whose idf
    is at least the mean over all terms of the corpus (``term_stats``: token, idf)."""
    b = benchmark_queries(spark, sf_dir)
    decisive = b.select("qid", F.lit("decisive").alias("tier"),
                        F.lower("question").alias("keyword"))
    telling = term_stats.where(F.col("idf") >= avg_idf).select(F.col("token").alias("keyword"))
    supportive = (b.select("qid", F.explode(F.array_distinct(tokens("question"))).alias("keyword"))
                   .join(telling, "keyword")
                   .select("qid", F.lit("supportive").alias("tier"), "keyword"))
    return decisive.unionByName(supportive)


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding", "label")
