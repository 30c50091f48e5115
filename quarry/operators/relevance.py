"""Relevance judgments: graded gains for ranked results.

* keyword rules: a decisive keyword contained in ``lower(title + ' ' + content)``
  gives 2, else at least two supportive keywords give 1, else 0.  Substring
  match, no word boundary.  The rule table is gathered into two arrays per
  query and joined on the query id (one row per query), then tested per result
  row with ``exists`` / ``filter`` - no (result x keyword) rows are produced.
* gold labels: left join on (qid, id) - or on id alone when the gold table has
  no query column - default gain 0; with duplicate ids the last one wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import relevance_text
from quarry.plans import sizing


def rule_arrays(rules: DataFrame, qid_col: str = "qid") -> DataFrame:
    """(qid, decisive array, supportive array) from (qid, tier, keyword)."""
    kw = F.lower(F.col("keyword"))
    return rules.groupBy(qid_col).agg(
        F.collect_list(F.when(F.col("tier") == "decisive", kw)).alias("decisive"),
        F.collect_list(F.when(F.col("tier") == "supportive", kw)).alias("supportive"))


def keyword_gain(text, decisive, supportive):
    hits = F.size(F.filter(F.coalesce(supportive, F.array().cast("array<string>")),
                           lambda k: F.contains(text, k)))
    return (F.when(F.coalesce(F.exists(decisive, lambda k: F.contains(text, k)), F.lit(False)), 2)
             .when(hits >= 2, 1)
             .otherwise(0)).cast("int")


def keyword_gains(results: DataFrame, rules: DataFrame, qid_col: str = "qid",
                  title_col: str = "title", content_col: str = "content") -> DataFrame:
    """``results`` + ``gain``; queries without rules get 0."""
    arrays = sizing.broadcast_if_small(rule_arrays(rules, qid_col))
    text = relevance_text(title_col, content_col)
    return (results.join(arrays, qid_col, "left")
                   .withColumn("gain", keyword_gain(text, F.col("decisive"), F.col("supportive")))
                   .drop("decisive", "supportive"))


def dedup_gold(gold: DataFrame, key_cols: list[str], score_col: str = "relevance_score",
               pos_col: str | None = "pos") -> DataFrame:
    """One score per key: the last entry (highest ``pos``) wins; without a
    position column the highest score is kept."""
    if pos_col and pos_col in gold.columns:
        score = F.max_by(F.col(score_col), F.col(pos_col))
    else:
        score = F.max(score_col)
    return gold.where(F.col(key_cols[-1]).isNotNull()).groupBy(*key_cols).agg(
        F.coalesce(score, F.lit(0)).alias(score_col))


def gold_gains(results: DataFrame, gold: DataFrame | None, qid_col: str = "qid",
               id_col: str = "id", gold_id_col: str = "id",
               score_col: str = "relevance_score") -> DataFrame:
    """``results`` + ``gain`` from gold labels; unlabelled -> 0."""
    if gold is None:
        raise ValueError("gold_labels required when keyword relevance is not used")
    keys = [qid_col, gold_id_col] if qid_col in gold.columns else [gold_id_col]
    g = dedup_gold(gold, keys, score_col).withColumnRenamed(gold_id_col, "_gid")
    cond = [results[id_col] == g["_gid"]]
    if qid_col in gold.columns:
        g = g.withColumnRenamed(qid_col, "_gq")
        cond.append(results[qid_col] == g["_gq"])
    g = sizing.broadcast_if_small(g)
    out = results.join(g, cond, "left")
    return (out.withColumn("gain", F.coalesce(F.col(score_col), F.lit(0)))
               .drop("_gid", "_gq", score_col))


def known_item_gold(corpus: DataFrame, items: DataFrame, *, id_col: str = "doc_id",
                    text_col: str = "contents", qid_col: str = "qid",
                    item_text_col: str = "question", score: int = 2,
                    postings: DataFrame | None = None,
                    doc_freq: DataFrame | None = None) -> DataFrame:
    """(qid, doc_id, relevance_score) for every document containing an item's
    whole text.

    Exact and without a nested loop over all pairs: an interior token of the
    item text (one with a non-token character on both sides) must occur as a
    whole token of any document containing the text.  Each item is matched
    through its rarest interior token (equi-join on postings), then confirmed
    with ``contains``.  Items with no interior token fall back to a direct
    ``contains`` test against the corpus.

    ``postings`` (token, id) and ``doc_freq`` (token, df) of a stored BM25 index
    over the same text are reused when given (no second tokenization).
    """
    from quarry.functions.text import TOKEN_PATTERN, tokens

    if postings is None:
        toks = tokens(F.col(text_col))
        postings = corpus.select(F.col(id_col), F.explode(F.array_distinct(toks)).alias("token"))
    else:
        postings = postings.select("token", id_col)
    if doc_freq is None:
        dfreq = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    else:
        dfreq = doc_freq.select("token", "df")
    # interior tokens: drop the first and the last run of token characters
    all_t = F.regexp_extract_all(F.lower(F.col(item_text_col)), F.lit(TOKEN_PATTERN), 0)
    lead_tok = F.regexp_like(F.col(item_text_col), F.lit(r"^[\p{L}\p{N}_]"))
    trail_tok = F.regexp_like(F.col(item_text_col), F.lit(r"[\p{L}\p{N}_]$"))
    n = F.size(all_t)
    start = F.when(lead_tok, 2).otherwise(1)
    length = n - (start - 1) - F.when(trail_tok, 1).otherwise(0)
    interior = F.when(length > 0, F.slice(all_t, start, length)).otherwise(F.array().cast("array<string>"))
    it = items.select(qid_col, item_text_col, interior.alias("_int"))
    cand_tok = (it.select(qid_col, F.explode(F.array_distinct("_int")).alias("token"))
                  .join(dfreq, "token")
                  .groupBy(qid_col).agg(F.min_by("token", F.struct("df", "token")).alias("token")))
    pairs = (sizing.broadcast_if_small(cand_tok).join(postings, "token")
             .select(qid_col, id_col))
    texts = corpus.select(id_col, text_col)
    with_tok = (pairs.join(texts, id_col)
                     .join(sizing.broadcast_if_small(it.select(qid_col, item_text_col)), qid_col)
                     .where(F.contains(F.col(text_col), F.col(item_text_col))))
    no_tok = it.join(cand_tok, qid_col, "left_anti").select(qid_col, item_text_col)
    both = with_tok.select(qid_col, id_col)
    # Items without an interior token are tested directly, in size-checked blocks
    # that are each broadcast: one corpus scan per block, never a cartesian shuffle.
    size = sizing.measure(no_tok, max_rows=10 * sizing.DEFAULT_MAX_ROWS)
    if size.rows:
        n_blocks = max(1, -(-size.bytes // sizing.DEFAULT_MAX_BYTES),
                       -(-size.rows // sizing.DEFAULT_MAX_ROWS)) * (16 if size.exceeded else 1)
        for b in range(n_blocks):
            block = no_tok if n_blocks == 1 else no_tok.where(
                F.pmod(F.xxhash64(qid_col), F.lit(n_blocks)) == b)
            direct = texts.join(F.broadcast(block), F.contains(F.col(text_col), F.col(item_text_col)))
            both = both.unionByName(direct.select(qid_col, id_col))
    return both.select(qid_col, id_col, F.lit(score).cast("int").alias("relevance_score"))


def keyword_rules_frame(spark: SparkSession, rules: dict) -> DataFrame:
    """(qid, tier, keyword) from ``{qid: {'decisive': [...], 'supportive': [...]}}``."""
    rows = [(q, tier, kw) for q, tiers in rules.items()
            for tier in ("decisive", "supportive") for kw in tiers.get(tier, [])]
    return spark.createDataFrame(rows, "qid string, tier string, keyword string")
