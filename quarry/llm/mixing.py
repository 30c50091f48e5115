"""Mixing sources to target weights.

Every document gets an Efraimidis-Spirakis exponential key: -ln(u) / w with u
drawn from its id and a seed, w its quality weight.  A source's target is met
by complete epochs first; the rest goes to the documents with the least keys,
up to where their running size meets the rest (the document on the border is
taken if that comes nearer).  Rows that repeat an id and text share a key; on
the border as many of them are taken as come nearest.

The running sizes of one source are never computed in one task: sizes are first
summed by ranges of the key (two levels of 4096 ranges), and only the documents
of the one range that holds the border are sorted.

Null sources are one source, after all others; null text has size 0.  Equal
keys go by size.  Texts are counted whole, however long.  Empty tables give
empty results.  Extra columns pass through ``mix`` under any name but those
starting with ``mix_``, which raise ``ValueError``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, column, cut, join_heavy, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3.0
RANGES = 4096
#: The plan has a row per source; with more sources it is joined by a shuffle, heavy sources apart.
MAX_BROADCAST_SOURCES = 10_000


def size_of(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Weight from 0.25 to 1: lower for symbols and for very short texts."""
    chars = F.greatest(F.char_length(F.coalesce(text, F.lit(""))), F.lit(1))
    symbols = F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0))
    clean = F.greatest(F.lit(0.0), 1.0 - 10.0 * symbols / chars)
    return 0.25 + 0.75 * clean * F.least(F.lit(1.0), size / 50.0)


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from one row per source (``source, source_size``).

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    the sum of all sizes by weight; a target above ``max_epochs`` times its
    source's size stops there, and what is left is shared anew.  Filling by
    water level: sources sorted by size / weight stop one after another, so the
    level comes from running sums.  The number of sources is small beside the
    number of documents; the running sums are the one place they meet.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "utf-8"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("mix_w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("mix_cap", F.col("source_size") * F.lit(max_epochs))
    everything = Window.partitionBy()
    order = Window.orderBy((F.col("mix_cap") / F.col("mix_w")), F.col("source").isNull(), F.encode(F.col("source"), "utf-8"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("mix_total", F.sum("source_size").over(everything).cast("double"))
          .withColumn("mix_left", F.col("mix_total") - F.coalesce(F.sum("mix_cap").over(before), F.lit(0.0)))
          .withColumn("mix_open", F.sum("mix_w").over(everything) - F.coalesce(F.sum("mix_w").over(before), F.lit(0.0))))
    # A source stops if the level at its turn is above its cap; those after the first that does not stop are open.
    s = s.withColumn("mix_stops", F.col("mix_left") / F.col("mix_open") * F.col("mix_w") > F.col("mix_cap"))
    level = F.max(F.when(~F.col("mix_stops"), F.struct(F.col("mix_left"), F.col("mix_left") / F.col("mix_open")))).over(everything)
    return s.select("source", "source_size", F.when(F.col("mix_stops"), F.col("mix_cap"))
                    .otherwise(F.coalesce(level["col2"] * F.col("mix_w"), F.lit(0.0))).alias("target"))


def _border(rows: DataFrame, part: str) -> DataFrame:
    """Per source, the range ``part`` where the running size passes ``mix_rest`` and the size before it."""
    run = Window.partitionBy("mix_src").orderBy(part)
    sums = rows.groupBy("mix_src", part).agg(F.sum("mix_sum").alias("mix_part"), F.first("mix_rest").alias("mix_rest"))
    sums = sums.withColumn("mix_run", F.sum("mix_part").over(run))
    last = sums.where("mix_run >= mix_rest").groupBy("mix_src").agg(
        F.min(F.struct(part, "mix_run", "mix_part")).alias("b"))
    return last.select("mix_src", F.col(f"b.{part}").alias(f"{part}_b"), (F.col("b.mix_run") - F.col("b.mix_part")).alias("mix_before"))


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17,
        weights=WEIGHTS, max_epochs: float = MAX_EPOCHS, weight: Column | None = None) -> DataFrame:
    """All rows plus ``mix_size, mix_source_size, mix_target, mix_copies, mix_taken`` (words the mix takes).

    ``weight`` replaces ``quality_weight``.  Reruns agree: keys depend on id,
    text and seed alone.
    """
    clash = [c for c in df.columns if c.lower().startswith("mix_")]
    if clash:
        raise ValueError(f"columns {clash} have names the operator needs")
    u = (F.shiftrightunsigned(F.xxhash64(column(doc_id), column(text), F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(2 ** 53))
    sized = df.withColumn("mix_size", size_of(column(text)))
    w = weight if weight is not None else quality_weight(column(text), F.col("mix_size"))
    # 1 - exp(-key) keeps the order of the keys and lies between 0 and 1.
    rank = 1.0 - F.exp(F.ln(u) / w)
    keyed = sized.withColumn("mix_key", rank).withColumn("mix_src", F.struct(column(source).isNull(), F.coalesce(column(source), F.lit(""))))
    fine = (F.col("mix_key") * (RANGES * RANGES)).cast("long")
    # What the decisions need is small; the texts are not read again.
    small = keyed.withColumn("mix_low", fine % RANGES).withColumn("mix_high", F.floor(fine / RANGES))
    small = cut(small.groupBy("mix_src", "mix_size", "mix_key", "mix_high", "mix_low").agg(
        F.sum("mix_size").alias("mix_sum"), F.count(F.lit(1)).alias("mix_rows")))
    plan = cut(plan_of(small, weights, max_epochs))
    out = _with_plan(keyed, plan, small.groupBy("mix_src").agg(F.sum("mix_rows").alias("mix_rows")))
    entry, border = F.struct("mix_key", "mix_size"), F.struct("mix_key_b", "mix_size_b")
    split = "mix_some > 0 AND mix_some < mix_rows_b"
    more = F.when(entry < border, 1).when((entry == border) & (F.col("mix_some") > 0), 1).otherwise(0)
    if plan.where(split).isEmpty():
        return _taken(out, more, df.columns)
    # Sources whose border cuts through equal rows: those rows are numbered one by one.
    on_border = F.expr(split) & (entry == border)
    on_border = F.coalesce(on_border, F.lit(False))
    equal = _numbered(written(out.where(on_border).withColumn("mix_row", F.monotonically_increasing_id())))
    one = F.when(F.col("mix_at") <= F.col("mix_some"), 1).otherwise(0)
    return _taken(out.where(~on_border), more, df.columns).unionByName(_taken(equal, one, df.columns))


def _with_plan(rows: DataFrame, plan: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` joined to the plan of their source: broadcast if small enough, else with heavy sources apart."""
    if plan.count() <= MAX_BROADCAST_SOURCES:
        return rows.join(F.broadcast(plan), "mix_src", "left")
    return join_heavy(rows, plan.join(counts.withColumnRenamed("mix_rows", "mix_n"), "mix_src"), "mix_src", "mix_n", "left")


def _taken(rows: DataFrame, more: Column, names: list[str]) -> DataFrame:
    copies = (F.col("mix_epochs") + more).cast("int")
    return rows.select(*[column(c) for c in names], "mix_size", "mix_source_size", "mix_target", copies.alias("mix_copies"),
                       (F.col("mix_size") * copies).alias("mix_taken"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``mix_at``: 1, 2, ... per source, by the rows' stored keys: places within a part of the table after the parts before."""
    part = F.shiftright("mix_row", 33)
    within = Window.partitionBy("mix_src", "mix_part").orderBy("mix_row")
    rows = rows.withColumn("mix_part", part)
    sizes = rows.groupBy("mix_src", "mix_part").agg(F.count(F.lit(1)).alias("mix_n"))
    before = Window.partitionBy("mix_src").orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("mix_src", "mix_part", F.coalesce(F.sum("mix_n").over(before), F.lit(0)).alias("mix_before"))
    rows = rows.withColumn("mix_at", F.row_number().over(within)).join(sizes, ["mix_src", "mix_part"])
    return rows.withColumn("mix_at", F.col("mix_at") + F.col("mix_before"))


def plan_of(small: DataFrame, weights, max_epochs: float) -> DataFrame:
    """One row per source: target, complete epochs, and the border entry with how many of its rows the fraction takes."""
    sizes = small.groupBy("mix_src").agg(F.sum("mix_sum").alias("source_size"))
    named = sizes.select(F.when(~F.col("mix_src.col1"), F.col("mix_src.col2")).alias("source"), "source_size", "mix_src")
    goal = targets(named.select("source", "source_size"), weights, max_epochs)
    goal = goal.select(F.struct(F.col("source").isNull(), F.coalesce("source", F.lit(""))).alias("mix_src"),
                       F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    epochs = F.when(F.col("mix_source_size") > 0, F.floor(F.col("mix_target") / F.col("mix_source_size"))).otherwise(0)
    goal = goal.withColumn("mix_epochs", epochs.cast("long"))
    goal = cut(goal.withColumn("mix_rest", F.col("mix_target") - F.col("mix_epochs") * F.col("mix_source_size")))
    few = goal.count() <= MAX_BROADCAST_SOURCES
    small_side = F.broadcast if few else (lambda d: d)
    rows = small.join(small_side(goal.where("mix_rest > 0").select("mix_src", "mix_rest")), "mix_src")
    for part in ("mix_high", "mix_low"):
        # Rows of the one range that holds the border; what lies before it is taken off the rest.
        at = _border(rows, part)
        rows = rows.join(small_side(at), "mix_src").where(F.col(part) == F.col(f"{part}_b"))
        rows = rows.withColumn("mix_rest", F.col("mix_rest") - F.col("mix_before")).drop(f"{part}_b", "mix_before")
    run = Window.partitionBy("mix_src").orderBy("mix_key", "mix_size")
    rows = rows.withColumn("mix_run", F.sum("mix_sum").over(run)).where("mix_run >= mix_rest AND mix_size > 0")
    end = rows.groupBy("mix_src").agg(F.min(F.struct("mix_key", "mix_size", "mix_rows", "mix_rest", "mix_run", "mix_sum")).alias("e"))
    left = F.col("e.mix_rest") - (F.col("e.mix_run") - F.col("e.mix_sum"))
    some = F.least(F.floor(left / F.col("e.mix_size") + 0.5), F.col("e.mix_rows"))
    end = end.select("mix_src", F.col("e.mix_key").alias("mix_key_b"), F.col("e.mix_size").alias("mix_size_b"),
                     F.col("e.mix_rows").alias("mix_rows_b"), some.cast("long").alias("mix_some"))
    return goal.drop("mix_rest").join(end, "mix_src", "left")
