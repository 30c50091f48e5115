"""URL filters: host and path rules first, then a ratio of character language models.

Rules ``host/path`` fit a host and all its subdomains where the path starts
with the rule's; the longest rule decides.  URLs that no rule fits are scored
by two Markov models of bytes, one of accepted and one of rejected URLs, of
variable order: Witten-Bell smoothing backs off from the longest known context
to shorter ones.  The difference of the two log-likelihoods per byte is held
against a threshold, calibrated on held-out labelled URLs for the best mean of
both classes' accuracies.

The URLs that rules judge are the labels.  The models are fitted on a bounded
sample of them: at most ``sample_rows`` URLs and ``sample_bytes`` bytes of each
class, those with the least hashes; so the models are of bounded size.  A URL
counts once, however many rows have it, and whole; those above a hundredth of
the sample's bytes come last, so no single URL can fill it or shut others out.
Every URL is scored over its whole length, however long.

Null URLs and those without ``://`` have an empty host and path; their score is
0, and like any other URL without a rule they are allowed above the threshold.
If a class has no labelled URL, the other class's verdict holds; without any
label all are allowed.  Repeated rows are judged alike.  Extra columns pass
through ``judge`` under any name but those starting with ``url_``, which raise
``ValueError``.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import LOWER, UPPER, column

ORDER = 5
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 2_000_000
#: URLs above 1/LONG_URL of the sample's bytes come last in it: whole, as far as its bytes allow.
LONG_URL = 100
HELD_OUT = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule's text (the first in alphabetical order of equally long ones), else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


class ByteModel:
    """Variable-order Markov model of bytes with Witten-Bell smoothing."""

    def __init__(self, texts: Sequence[bytes], order: int):
        self.order = order
        self.next: dict[bytes, dict[int, int]] = defaultdict(lambda: defaultdict(int))
        for t in texts:
            for i, c in enumerate(t):
                for k in range(min(order, i) + 1):
                    self.next[t[i - k:i]][c] += 1
        self.next = {k: dict(v) for k, v in self.next.items()}
        self.total = {k: sum(v.values()) for k, v in self.next.items()}

    def probability(self, context: bytes, c: int) -> float:
        p = 1 / 256
        for k in range(len(context) + 1):
            seen = self.next.get(context[len(context) - k:])
            if seen is None:
                break
            n = self.total[context[len(context) - k:]]
            p = (seen.get(c, 0) + len(seen) * p) / (n + len(seen))
        return p


class Ratio:
    """Length-normalised log-likelihood difference of two models; above 0: accepted is likelier."""

    def __init__(self, accepted: ByteModel, rejected: ByteModel):
        self.accepted, self.rejected = accepted, rejected

    def __call__(self, texts: Sequence[bytes]) -> list[float]:
        a, r, order = self.accepted, self.rejected, self.accepted.order

        @lru_cache(1 << 17)
        def step(gram: bytes) -> float:
            return math.log(a.probability(gram[:-1], gram[-1])) - math.log(r.probability(gram[:-1], gram[-1]))

        return [sum(step(t[max(0, i - order):i + 1]) for i in range(len(t))) / len(t) if t else 0.0 for t in texts]


def threshold(scores: Sequence[float], accepted: Sequence[bool]) -> float:
    """The score from which on a URL is accepted, best for the mean of both classes' accuracies."""
    n_yes, n_no = max(1, sum(accepted)), max(1, len(accepted) - sum(accepted))
    best, value, yes, no = 1.0, -math.inf, n_yes, 0
    ordered = sorted(zip(scores, accepted))
    for i, (s, y) in enumerate(ordered):
        yes, no = yes - y, no + (not y)
        after = ordered[i + 1][0] if i + 1 < len(ordered) else s + 1e-9
        if after > s and yes / n_yes + no / n_no > best:
            best, value = yes / n_yes + no / n_no, (s + after) / 2
    return value


def fit(labelled: DataFrame, order: int = ORDER, sample_rows: int = SAMPLE_ROWS,
        sample_bytes: int = SAMPLE_BYTES) -> tuple[Ratio, float] | bool:
    """Models and threshold from ``labelled(text, accepted)``; or the one verdict that labels know."""
    once = labelled.where("text <> ''").select("text", "accepted").distinct()
    ranked = once.withColumn("h", F.xxhash64("text", F.lit(5))).withColumn("long", F.octet_length("text") > sample_bytes // LONG_URL)
    order_by = Window.orderBy("long", "h", "text")
    got = []
    for side in (True, False):
        some = ranked.where(F.col("accepted") == side).orderBy("long", "h", "text").limit(sample_rows)
        size = F.sum(F.octet_length("text")).over(order_by.rowsBetween(Window.unboundedPreceding, 0))
        some = some.withColumn("size", size).withColumn("n", F.row_number().over(order_by))
        got += some.where((F.col("size") <= sample_bytes) | (F.col("n") == 1)).select("text", "accepted", "h").collect()
    sides = {r.accepted for r in got}
    if len(sides) < 2:
        return next(iter(sides), True)
    texts = [(r.text.encode(), r.accepted, r.h % HELD_OUT == 0) for r in got]
    models = [ByteModel([t for t, a, held in texts if a == side and not held] or [t for t, a, _ in texts if a == side], order)
              for side in (True, False)]
    ratio = Ratio(*models)
    held = [(t, a) for t, a, h in texts if h] or [(t, a) for t, a, _ in texts]
    return ratio, threshold(ratio([t for t, _ in held]), [a for _, a in held])


def judge(df: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", order: int = ORDER,
          sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """All rows plus ``url_host, url_path, url_rule, url_score, url_verdict`` (allow or block).

    ``rules``: pairs of ``allow`` or ``block`` and ``host/path``.  ``url_score``
    is null where a rule decides.
    """
    clash = [c for c in df.columns if c.lower().startswith("url_")]
    if clash:
        raise ValueError(f"columns {clash} have names the operator needs")
    host, path = host_and_path(column(url))
    parts = df.select(F.struct(*[column(c) for c in df.columns]).alias("own"), host.alias("url_host"), path.alias("url_path"))
    ruled = parts.withColumn("url_rule", rule_of(F.col("url_host"), F.col("url_path"), rules))
    allows = [r for v, r in rules if v == "allow"]
    labels = ruled.where("url_rule IS NOT NULL").select(
        F.concat("url_host", "url_path").alias("text"), F.col("url_rule").isin(*allows).alias("accepted"))
    model = fit(labels, order, sample_rows, sample_bytes)
    by_rule = F.when(F.col("url_rule").isin(*allows), "allow").when(F.col("url_rule").isNotNull(), "block")
    names = [F.col("own")[c].alias(c) for c in df.columns] + [F.col(c) for c in ("url_host", "url_path", "url_rule", "url_score", "url_verdict")]
    if isinstance(model, bool):
        scored = ruled.withColumn("url_score", F.lit(None).cast("double"))
        return scored.withColumn("url_verdict", F.coalesce(by_rule, F.lit("allow" if model else "block"))).select(*names)
    ratio, least = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("url_text").to_pylist()
            got = iter(ratio([t.encode() for t in text if t is not None]))
            scores = pa.array([None if t is None else next(got) for t in text], pa.float64())
            rest = [c for c in b.schema.names if c != "url_text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), scores], [*rest, "url_score"])

    text = F.when(F.col("url_rule").isNull(), F.concat("url_host", "url_path"))
    kinds = T.StructType([*ruled.schema.fields, T.StructField("url_score", T.DoubleType())])
    scored = ruled.withColumn("url_text", text).mapInArrow(score, kinds)
    by_model = F.when(F.col("url_score") > least, "allow").otherwise("block")
    return scored.withColumn("url_verdict", F.coalesce(by_rule, by_model)).select(*names)
