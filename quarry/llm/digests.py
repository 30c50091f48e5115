"""Exact deduplication against a persistent index of digests.

A text's digest is the SHA-256 of its UTF-8 bytes after A-Z are lower-cased;
null counts as empty.  The index is a table of digests, bucketed and sorted by
digest and partitioned by batch, in a folder of its own: any later session opens
it by its path.  A batch is grouped by digest (combined before the shuffle, so a
text that a third of all rows share is a row per task), the groups meet the
digests of earlier batches in a sort-merge anti-join, and what is left is
appended.  The index side of the join is read bucket by bucket, without a
shuffle; only the new batch is dealt.  Groups that the index knows already are
appended apart, as counts.

A batch writes its own partitions and replaces them when it is delivered again
under its number, so a repeated or resumed delivery changes nothing.  Batches
are numbered upwards; a batch is compared with those of lesser numbers.

Of the rows of a batch that share a new digest the one with the largest id
stays; a null id is below all others, and of rows that repeat an id and text one
stays.  A row whose digest an earlier batch brought goes, whatever its id.
Whole texts are read, however long, one at a time.  An empty batch appends
nothing.  Other columns pass through ``deliver``; a column named
``dedup_digest``, ``dedup_id`` or ``dedup_row`` raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, column, join_heavy, written

OWN = ("dedup_digest", "dedup_id", "dedup_row")
ENTRY = "keep_id BIGINT, keep_row BIGINT, n BIGINT, digest BINARY, batch BIGINT, kind STRING"


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(ascii_lower(text), 256))


def digested(df: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with digest, id and a key of the row, written once so that the key holds."""
    clash = [c for c in df.columns if c.lower() in OWN]
    if clash:
        raise ValueError(f"columns {clash} have names the operator needs")
    names = df.columns if keep is None else keep
    return written(df.select(*[column(c) for c in names], digest(column(text)).alias("dedup_digest"), column(doc_id).cast("long").alias("dedup_id"),
                             F.monotonically_increasing_id().alias("dedup_row")))


class DigestIndex:
    """The digests of all batches, under a path."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        """Opens the index under ``path``, or starts an empty one with so many buckets."""
        self.spark, self.path = spark, path.rstrip("/")
        self.table = "quarry_digests_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        meta = self._meta()
        self.buckets = meta["buckets"] if meta else buckets
        if not meta:
            spark.createDataFrame([(json.dumps({"buckets": buckets}),)], "value string").coalesce(1).write.text(f"{self.path}/meta")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({ENTRY}) USING parquet "
                  "OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (batch, kind) "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/entries'")
        if self._exists("entries"):
            spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def _meta(self) -> dict | None:
        if not self._exists("meta/_SUCCESS"):
            return None
        return json.loads(self.spark.read.text(f"{self.path}/meta").first()["value"])

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def known(self, batch: int | None = None) -> DataFrame:
        """One row per digest: where it came first.  ``batch``: only of earlier batches."""
        new = self.entries().where("kind = 'new'")
        return new if batch is None else new.where(F.col("batch") < batch)

    def add(self, rows: DataFrame, batch: int) -> None:
        """Appends what is new of a batch of ``digested`` rows."""
        groups = rows.groupBy(F.col("dedup_digest").alias("digest")).agg(
            F.max(F.struct("dedup_id", "dedup_row")).alias("keep"), F.count(F.lit(1)).alias("n"))
        groups = written(groups.select(F.col("keep.dedup_id").alias("keep_id"), F.col("keep.dedup_row").alias("keep_row"), "n", "digest"))
        old = self.known(batch).select("digest").hint("merge")
        for kind, how in (("new", "left_anti"), ("seen", "left_semi")):
            # Written first: Spark does not overwrite partitions of a table that the same plan reads.
            part = written(groups.join(old, "digest", how)).repartition(self.buckets, "digest")
            part = part.select("keep_id", "keep_row", "n", "digest", F.lit(batch).cast("long"), F.lit(kind))
            part.write.insertInto(self.table, overwrite=True)

    def groups(self) -> DataFrame:
        """Per digest: the batch, id and row key of the row that stays, and all rows counted.  No shuffle."""
        new = F.when(F.col("kind") == "new", F.struct("batch", "keep_id", "keep_row"))
        return self.entries().groupBy("digest").agg(F.max(new).alias("keep"), F.sum("n").alias("n"))

    def mark(self, rows: DataFrame, batch: int | Column) -> DataFrame:
        """``digested`` rows of added batches with ``keep_id``, ``group_size`` and ``kept``."""
        own = rows.groupBy(F.col("dedup_digest")).agg(F.count(F.lit(1)).alias("dedup_n"))
        found = self.groups().select(F.col("digest").alias("dedup_digest"), F.col("keep").alias("dedup_keep"), F.col("n").alias("dedup_size"))
        out = join_heavy(rows, own.join(found, "dedup_digest"), "dedup_digest", "dedup_n")
        keep, batch = F.col("dedup_keep"), batch if isinstance(batch, Column) else F.lit(batch)
        return out.withColumns({"keep_id": keep["keep_id"], "group_size": F.col("dedup_size"),
                                "kept": (keep["batch"] == batch) & (keep["keep_row"] == F.col("dedup_row"))}).drop("dedup_keep", "dedup_size")


def deliver(df: DataFrame, index: DigestIndex, batch: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of a batch whose text is new to the index, in the columns of ``df``; the index then has them."""
    rows = digested(df, doc_id, text)
    index.add(rows, batch)
    fresh = index.entries().where((F.col("batch") == batch) & (F.col("kind") == "new"))
    return rows.join(fresh.select(F.col("digest").alias("dedup_digest"), F.col("keep_row").alias("dedup_row")),
                     ["dedup_digest", "dedup_row"], "left_semi").select(*[column(c) for c in df.columns])
