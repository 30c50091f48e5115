"""Session construction and shared scratch locations.

Library code never creates its own session; it receives one.  ``build_session``
is for tests, the bench and command-line use.  Scratch output (index tables,
stream checkpoints, lineage cuts) goes under the folder named by
``spark.checkpoint.dir`` so that it lives on the cluster's shared storage.  A
local temporary folder is used only when that setting is absent (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Explicit broadcasts in the library are size-checked (plans.sizing); Spark's
    # own threshold stays at its default for small static tables, and AQE
    # re-decides on measured shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    if "spark.sql.warehouse.dir" not in conf:
        builder = builder.config("spark.sql.warehouse.dir",
                                 tempfile.mkdtemp(prefix="quarry-warehouse-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back.

    Unlike ``checkpoint`` the plan runs once, and readers take single columns.
    """
    path = f"{scratch_path(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    path = f"{base}/quarry/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path
