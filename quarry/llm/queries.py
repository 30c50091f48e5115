"""The registered queries of the operators: thin, over whole tables, with digests of the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import ann, centroids, chat, digests, licenses, lm, mixing, packing, quality, resampling, simhash, substring, urls
from quarry.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The rules of the URL query.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))


@register
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select(
        "page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"),
        F.col("url_verdict").alias("verdict"), F.col("url_score").alias("score"))


@register
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"), F.col("mix_copies").alias("copies"))


@register
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs, lang="lang").select("doc_id", *quality.COUNTS, "base_failed", "kept")


@register
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@register
def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    read = chat.read_back(chat.windows(turns))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select("conv_id", F.struct("window", lines.alias("lines"), F.array_join("learned", "").alias("learned")).alias("w"),
                        F.size("turns").alias("n"), "chars")
    whole = parts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list("w")).alias("ws"),
                                         F.sum("chars").cast("long").alias("formatted_chars"))
    joined = lambda name: F.array_join(F.transform("ws", lambda w: w[name]), "")
    whole = whole.withColumns({"lines": joined("lines"), "learned": joined("learned")})
    return whole.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2("lines", 256).alias("turns_sha256"),
                        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                        "formatted_chars")


@register
def op7_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 != 0)


@register
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup(docs).select(
        "doc_id", F.col("sub_words").alias("n_words"), F.col("sub_removed").alias("n_removed"),
        F.sha2("sub_kept", 256).alias("kept_sha256"))


@register
def op10_kmeans_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, F.col("vec_id") % 20 == 0)


@register
def op11_filtered_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    text = F.array_join(F.transform("centroid", lambda c: c.cast("string")), ",")
    return found.withColumn("centroid_sha256", F.sha2(text, 256)).drop("centroid")


@register
def op12_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents arrive in two deliveries, greater ids first, so that the row with the largest id stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = digests.digested(docs, keep=("doc_id",))
    middle = rows.agg(F.expr("min(doc_id) div 2 + max(doc_id) div 2")).scalar()
    batch = F.when(F.coalesce(F.col("doc_id") > middle, F.lit(False)), 1).otherwise(2)
    index = digests.DigestIndex(spark, scratch_path(spark, "digests"), buckets=max(8, spark.sparkContext.defaultParallelism))
    for b in (1, 2):
        index.add(rows.where(batch == b), b)
    return index.mark(rows, batch).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("dedup_digest")).alias("text_sha256"))


@register
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, table(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc_id", F.col("res_features").alias("n_features"), F.col("res_weight").alias("weight"),
                        F.col("res_score").alias("score"), F.col("res_rank").alias("rank"))
