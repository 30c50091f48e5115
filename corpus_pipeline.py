"""The training-corpus pipeline: quality rules, near-duplicates, repeated spans, mix, packing.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns
of ``documents``, and the driver of the pipeline writes each stage's result
before the next one reads it.

Null and empty texts fail the quality rules and go.  Rows without an id stay if
their text is new.  Repeated rows are near-duplicates: one stays; which one of
equal rows makes no difference.  Of documents with equal scores the least id
stays.  Texts are read whole in every stage.  An empty table passes through
empty.  Extra columns pass through all stages but the last, under any name that
the operators do not reserve (those raise ``ValueError``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import mixing, packing, quality, simhash, substring
from quarry.llm.common import column
from quarry.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.judge(docs, prefix="rule_", lang="lang").where("rule_kept").select(*[column(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id (one without id if none has any)."""
    return simhash.keep_one(docs).select(*[column(c) for c in docs.columns])


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words of spans that an earlier document has; a text with none left goes.

    The words left are joined by one space and ``n_chars`` follows; texts that lose nothing stay as they are.
    """
    own = "before"
    while own in docs.columns:
        own += "_"
    got = substring.dedup(docs.withColumn(own, F.col("text"))).where("sub_kept <> ''")
    text = F.when(F.col("sub_removed") > 0, F.col("sub_kept")).otherwise(F.col(own))
    got = got.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))
    return got.select(*[column(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    mixed = mixing.mix(docs).where("mix_copies > 0 AND mix_size > 0")
    return mixed.withColumn("mix_epoch", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(
        *[column(c) for c in docs.columns])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into sequences of 2048 tokens, with their ids."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_spans),
    ("source_mixing", source_mix),
    ("best_fit_packing", sequences),
]

#: Fingerprints (XXH64) and token ids have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written in the shared folder and read again."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
