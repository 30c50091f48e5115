"""Bucketed tables: the document-partitioned layout of the engine.

The corpus is staged once as a table bucketed (and sorted) by ``doc_id``; all
per-document derivations (tokens, postings, vectors) are then computed inside
the bucket's task and written bucketed the same way, without another shuffle.
A later BM25 scan of the postings keeps that partitioning, so the per
(query, doc) sum and a partial top-k run in the scan's task: only k rows per
query per bucket cross the network.  This is the classic document-sharded
search layout.

Bucketing lives in the session catalog; ``register`` re-creates the table
entry (with its bucket spec) over files written earlier or by another session.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Stored bytes of a bucket.  A bucket is one task, which aggregates and sorts the tokens of all its texts:
#: some 60 bytes of memory for every stored byte.
TARGET_BUCKET_BYTES = 8 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (the file size for a plain scan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def choose_buckets(df: DataFrame, minimum: int | None = None) -> int:
    spark = df.sparkSession
    floor = minimum or spark.sparkContext.defaultParallelism
    size = plan_bytes(df)
    if size >= 1 << 62:  # Spark's stand-in for a size it does not know
        return floor
    return max(floor, math.ceil(size / TARGET_BUCKET_BYTES))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int,
                   already_bucketed: bool = False) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``key`` under ``path``; return the table.

    ``already_bucketed``: the rows are already partitioned by the same bucket
    function (derived from a bucketed scan), so each task writes one file and
    no shuffle is added.
    """
    spark = df.sparkSession
    out = df if already_bucketed else df.repartition(buckets, key)
    name = f"quarry_{uuid.uuid4().hex[:16]}"
    (out.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
        .option("path", f"{path}/data").saveAsTable(name))
    meta = {"name": name, "key": key, "buckets": buckets, "ddl": _ddl(df)}
    spark.createDataFrame([(json.dumps(meta),)], "meta string") \
         .coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    return spark.table(name)


def register(spark: SparkSession, path: str) -> DataFrame:
    """Open a bucketed table written by ``write_bucketed`` (re-registering it if
    this session does not know it)."""
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    name = meta["name"]
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({meta['ddl']}) USING parquet "
                  f"CLUSTERED BY (`{meta['key']}`) SORTED BY (`{meta['key']}`) "
                  f"INTO {meta['buckets']} BUCKETS LOCATION '{path}/data'")
    return spark.table(name)
