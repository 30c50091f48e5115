"""Helpers shared by the operators: words, checkpoints, heavy-key joins, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

#: Java regular expression of what separates words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: A key with more than 1/HEAVY of all rows is heavy, so fewer than HEAVY keys are.
HEAVY = 1000


#: The only letters whose case is folded.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged; null counts as empty.  Texts of ASCII alone take the fast way."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def cut(df: DataFrame) -> DataFrame:
    """Materialize in the shared checkpoint folder, so that a lost executor costs a re-read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """As ``cut``, for large tables: a compressed table by columns in the same folder, so readers take what they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_heavy(left: DataFrame, right: DataFrame, key: str, rows: str, how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right`` (one row per key, ``rows`` = the key's rows in ``left``).

    Keys with more than 1/HEAVY of all rows, of which there are fewer than
    HEAVY, are broadcast; so no task of the shuffled rest gets more than that
    share through one key.  ``how``: inner or left.
    """
    total = right.agg(F.sum(rows)).scalar()
    heavy = right.where(F.col(rows) * HEAVY > total)
    rest = right.where(~F.coalesce(F.col(rows) * HEAVY > total, F.lit(False)))
    keys = heavy.select(key)
    hot = left.join(F.broadcast(heavy.drop(rows)), key)
    cold = left.join(F.broadcast(keys), key, "left_anti").join(rest.drop(rows), key, how)
    return hot.unionByName(cold)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``: root is the component's least node.

    Alternating large-star and small-star steps; every step is a grouped
    minimum and a join, and the edges never leave the executors.  Each round is
    checkpointed.  Raises if ``rounds`` rounds (enough for 2^60 nodes in a
    chain) do not settle it.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, seen = cut(e), None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_if(F.col("u") <= F.col("v"))).first()
        if now == seen:
            roots = e.select("u", "v")
            return roots.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now
    raise RuntimeError("connected components did not settle")
