"""Importance resampling toward a target distribution, with features counted once per distinct line.

Features of a text are its words and its pairs of neighbouring words (one space
between), lower-cased in A-Z only, each hashed to a bucket (CRC-32 of its UTF-8
bytes).  No word holds a newline, so a text's features are those of its lines
plus one pair across each border between lines that have words.  Lines repeat
across documents far more often than texts do: equal lines are grouped first
(combined before the shuffle, so a line that a third of all rows share is a row
per task), a distinct line is cut into features once, and its bucket counts are
multiplied by its occurrences.  Pairs across borders are added apart.

A bucket's gain compares its share in the target with its share in the corpus,
add-one smoothed.  A text's weight is the floored mean gain of its features: the
sum of its lines' gains, again computed once per distinct line, and of its
border pairs.  Adding Gumbel noise drawn from the id and sorting draws without
replacement in proportion to exp(weight / 1000).  Ranks come from a range
partitioning by score and per-partition counts, so no task holds all rows.

Null and empty texts have no features and weight 0.  Whole texts are read; a
text is cut into lines in the task that reads it.  Texts under ``min_words``
words get a score but are never drawn.  A null id counts as an empty one in the
noise and comes after other ids.  Repeated rows are drawn one by one; equal
scores go by id, then by place.  With an empty target every feature's gain is
that of a count of zero; an empty table gives an empty result.  Other columns
pass through unless their names start with ``res_`` (``ValueError``).
Gains, ``buckets`` of them, are the only thing broadcast beside heavy lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, column, cut, join_heavy, written

BUCKETS = 10_000
FRACTION = (25, 100)
MIN_WORDS = 20
SEED = 7
#: Java classes of what separates words and of what makes them.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
MAKES = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"


def bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def pairs(left: Column, right: Column, buckets: int) -> Column:
    return F.zip_with(left, right, lambda a, b: bucket(F.concat(a, F.lit(" "), b), buckets))


def neighbours(items: Column, left=lambda c: c, right=lambda c: c) -> tuple[Column, Column]:
    """All but the last item and all but the first, as two arrays."""
    n = F.greatest(F.size(items) - 1, F.lit(0))
    return F.transform(F.slice(items, 1, n), left), F.transform(F.slice(items, 2, n), right)


def lines_of(text: Column) -> Column:
    return F.split(ascii_lower(text), "\n")


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def ends(text: Column) -> Column:
    """Key, first and last word of each line that has words, in order."""
    def of(line: Column) -> Column:
        first = F.regexp_extract(line, f"^{APART}*({MAKES}+)", 1)
        last = F.reverse(F.regexp_extract(F.reverse(line), f"^{APART}*({MAKES}+)", 1))
        return F.struct(line_key(line).alias("key"), first.alias("first"), last.alias("last"))

    return F.filter(F.transform(lines_of(text), of), lambda e: e["first"] != "")


def distinct_lines(texts: DataFrame, text: Column, buckets: int) -> DataFrame:
    """``key, occurrences, words, buckets`` of each distinct line that has words."""
    lines = texts.select(F.explode(lines_of(text)).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("occurrences"))
    lines = lines.withColumn("w", F.array_remove(F.split("line", f"{APART}+"), "")).where(F.size("w") > 0)
    features = F.concat(F.transform("w", lambda w: bucket(w, buckets)), pairs(*neighbours(F.col("w")), buckets))
    return lines.select(line_key(F.col("line")).alias("key"), "occurrences", F.size("w").alias("words"),
                        features.cast("array<short>" if buckets <= 1 << 15 else "array<int>").alias("buckets"))


def border_pairs(e: Column, buckets: int) -> Column:
    left, right = neighbours(e, lambda x: x["last"], lambda x: x["first"])
    return pairs(left, right, buckets)


def counts(lines: DataFrame, borders: DataFrame) -> DataFrame:
    """``bucket, n``: features by bucket, from distinct lines and from ``borders(across)``."""
    inside = lines.select(F.explode("buckets").alias("bucket"), F.col("occurrences").alias("n"))
    across = borders.select(F.explode("across").alias("bucket"), F.lit(1).cast("long").alias("n"))
    return inside.unionByName(across).groupBy(F.col("bucket").cast("int").alias("bucket")).agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> Column:
    """A constant array with the gain of each bucket; its size is bounded by ``buckets``."""
    both = source.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full")
    all_s, all_t = source.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar(), target.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    every = both.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    s, t = F.coalesce("s", F.lit(0)).cast("double"), F.coalesce("t", F.lit(0)).cast("double")
    gain = F.floor(1000 * F.ln((t + 1) * (all_s.cast("double") + buckets) / ((s + 1) * (all_t.cast("double") + buckets))))
    rows = every.join(both, "bucket", "left").select("bucket", gain.alias("gain")).collect()
    return F.split(F.lit(",".join(str(g) for _, g in sorted(rows))), ",").cast("array<bigint>")


def gain_sum(buckets: Column, gain: Column) -> Column:
    return F.aggregate(buckets, F.lit(0).cast("long"), lambda total, b: total + F.get(gain, b.cast("int")))


def resample(df: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             fraction: tuple[int, int] = FRACTION, buckets: int = BUCKETS, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """All rows (without the text) with ``res_features, res_weight, res_score`` and the ``res_rank`` of those drawn."""
    clash = [c for c in df.columns if c.lower().startswith("res_")]
    if clash:
        raise ValueError(f"columns {clash} have names the operator needs")
    keep = [c for c in df.columns if c != text]
    body, goal = column(text), column(target_text)
    # A step of its own, so that the ends are found once and not in each expression that uses them.
    docs = df.select(*[column(c) for c in keep], column(doc_id).cast("long").alias("res_id"), F.monotonically_increasing_id().alias("res_row"),
                     ends(body).alias("res_ends"))
    docs = written(docs.withColumn("res_lines", F.col("res_ends.key")).withColumn("res_across", border_pairs(F.col("res_ends"), buckets))
                   .drop("res_ends"))
    lines = written(distinct_lines(df, body, buckets))
    source = counts(lines, docs.select(F.col("res_across").alias("across")))
    borders = target.select(ends(goal).alias("e")).select(border_pairs(F.col("e"), buckets).alias("across"))
    wanted = counts(distinct_lines(target, goal, buckets), borders)
    gain = gains(cut(source), cut(wanted), buckets)
    per_line = cut(lines.select("key", "occurrences", "words", F.size("buckets").alias("features"), gain_sum(F.col("buckets"), gain).alias("gain")))
    uses = join_heavy(docs.select("res_row", F.explode("res_lines").alias("key")), per_line, "key", "occurrences")
    per_doc = uses.groupBy("res_row").agg(F.sum("words").alias("res_words"), F.sum("features").alias("res_inside"), F.sum("gain").alias("res_gain"))
    own = docs.withColumn("res_border", gain_sum(F.col("res_across"), gain)).withColumn("res_n", F.size("res_across")).drop("res_lines", "res_across")
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long")
    own = own.join(per_doc, "res_row", "left").withColumns({
        "res_features": zero("res_inside") + F.col("res_n"), "res_gain": zero("res_gain") + F.col("res_border"), "res_words": zero("res_words")})
    weight = F.expr("CASE WHEN res_features > 0 THEN (res_gain - pmod(res_gain, res_features)) div res_features ELSE 0L END")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("res_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.ln(-F.ln((h.cast("double") + 0.5) / 4294967296.0)))
    scored = cut(own.withColumn("res_weight", weight).withColumn("res_score", F.col("res_weight") + noise)
                 .withColumn("res_open", F.col("res_words") >= min_words).drop("res_inside", "res_gain", "res_border", "res_n"))
    n = scored.agg(F.count_if("res_open")).scalar()
    ranked = numbered(scored, F.desc("res_open"), F.desc("res_score"), F.asc_nulls_last("res_id"), F.asc("res_row"))
    drawn = F.col("res_open") & (F.col("res_at") * fraction[1] <= F.lit(fraction[0]) * n)
    return ranked.select(*[column(c) for c in keep], "res_features", "res_weight", "res_score", F.when(drawn, F.col("res_at")).alias("res_rank"))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``res_at``, the place of each row in the order, from 1: sorted ranges, then the counts before each."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("res_at", F.monotonically_increasing_id()))
    part = F.shiftright("res_at", 33)
    sizes = at.groupBy(part.alias("res_part")).agg(F.count(F.lit(1)).alias("res_size"))
    # A row per partition of the sort, whatever the number of rows.
    before = Window.orderBy("res_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("res_part", F.coalesce(F.sum("res_size").over(before), F.lit(0)).alias("res_before"))
    out = at.withColumn("res_part", part).join(F.broadcast(sizes), "res_part")
    return out.withColumn("res_at", F.col("res_before") + F.col("res_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("res_part", "res_before")
