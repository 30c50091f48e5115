"""Incremental encoding: only documents without a vector are encoded.

``encode_missing`` is the batch form: anti-join the corpus against the vector
table on the id, encode the rest, append.  Re-running it adds nothing.

``run_encode_stream`` is the streaming form: new corpus files landing in a
folder are read with ``readStream``; each micro-batch is encoded and appended
inside ``foreachBatch``.  The sink is made idempotent by the same anti-join, so
a micro-batch replayed after a failure (the checkpoint records progress only
after the batch commits) does not duplicate vectors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from quarry.operators import encode as encode_ops
from quarry.plans import sizing


def _existing_ids(spark: SparkSession, vectors_path: str, id_col: str, retry_failed: bool) -> DataFrame | None:
    """Ids not to encode again; None if there is no table yet (any other failure is raised)."""
    try:
        stored = spark.read.parquet(vectors_path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if retry_failed and "status" in stored.columns:
        stored = stored.where("status = 'ok'")
    return stored.select(id_col)


def encode_missing(corpus: DataFrame, vectors_path: str, *, id_col: str = "doc_id",
                   text_col: str = "contents", dim: int = 128,
                   encoder: str = "hash", encoder_factory=None,
                   retry_failed: bool = False) -> DataFrame:
    """Append vectors for the documents missing from ``vectors_path``; returns
    the (lazy) frame of what was appended.

    With an encoder factory, ``status`` and ``error`` are stored as well: a
    document that failed keeps its row and is tried again only with
    ``retry_failed`` (its new row is appended)."""
    spark = corpus.sparkSession
    existing = _existing_ids(spark, vectors_path, id_col, retry_failed)
    if existing is None:
        todo = corpus
    else:
        ids = corpus.select(id_col)
        if sizing.fits(ids):
            # a micro-batch: probe the stored ids with its broadcast id set, so the
            # vector table is scanned once and never shuffled
            present = existing.join(F.broadcast(ids), id_col, "left_semi")
            todo = corpus.join(F.broadcast(present), id_col, "left_anti")
        else:
            todo = corpus.join(existing, id_col, "left_anti")
    if encoder == "hash":
        new = encode_ops.hash_encode(todo, id_col, text_col, dim)
    else:
        new = encode_ops.encode(todo, id_col=id_col, text_col=text_col, encoder_factory=encoder_factory)
    new.write.mode("append").parquet(vectors_path)
    return new


def run_encode_stream(spark: SparkSession, landing_dir: str, schema: T.StructType,
                      vectors_path: str, checkpoint: str, *, id_col: str = "doc_id",
                      text_col: str = "contents", dim: int = 128,
                      encoder: str = "hash", encoder_factory=None,
                      max_files_per_trigger: int | None = None) -> None:
    """Process every file currently in ``landing_dir`` (``availableNow``) and stop."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir)

    def sink(batch: DataFrame, batch_id: int) -> None:
        encode_missing(batch, vectors_path, id_col=id_col, text_col=text_col, dim=dim,
                       encoder=encoder, encoder_factory=encoder_factory)

    q = (stream.writeStream.foreachBatch(sink)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
