"""Quality rules as one projection.

``RULES`` is a table of thresholds; ``judge`` compiles it, with the measures it
names, into Spark expressions, so the whole filter is a scan and a projection:
no user functions, no shuffle.

The rule on function words holds for texts in a language that ``STOP_WORDS``
covers, as the ``lang`` column says (null, or no such column: covered), and one
word is always granted, so that very short texts without one stay.

Nulls and empty texts have no words: all measures are 0, ratios are 0, and the
base rule (too few words) rejects them.  Whole texts are judged, however long.
An empty table gives an empty result.  Repeated rows and ids are judged row
by row.  Extra columns pass through; a column named like a measure makes
``judge`` raise, so use ``prefix`` then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import column, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Frequent function words of English, French, Spanish and German.
STOP_WORDS = (
    "the of and to in is that for with this on by be it as are was at from or an have not which "
    "le la les de des du et en un une que qui dans pour par sur au ce il elle est pas plus "
    "el los las y del se por con para su al lo como es una no más "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch"
).split()

#: Languages of ``STOP_WORDS``.
COVERED = ("en", "fr", "es", "de")

#: (rule, measure, least, most): kept if least <= measure <= most; None is open.
RULES = (
    ("mean_word_chars", "mean_word_chars", 1.5, 20.0),
    ("symbol_ratio", "symbol_ratio", None, 0.05),
    ("stop_word_ratio", "stop_word_ratio", 0.02, None),
    ("dup_line_ratio", "dup_line_ratio", None, 0.35),
    ("longest_word", "longest_word_chars", None, 1000),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = (*COUNTS, "n_lines", "n_stop_words", "longest_word_chars",
            "mean_word_chars", "symbol_ratio", "stop_word_ratio", "dup_line_ratio")


def _let(value: Column, body) -> Column:
    """``body(value)`` with value computed once (bound to a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def repeat_words(w: Column, window: int = WINDOW) -> Column:
    """Words covered by a window of so many words found twice or more in ``w``.

    Windows are sorted by hash, neighbours with one hash give the repeated
    starts; each start covers ``window`` words or those up to the next start.
    """
    one = F.transform(w, lambda x: F.xxhash64(x))
    hashes = _let(one, lambda o: F.slice(F.transform(o, lambda x, i: F.xxhash64(
        x, *[F.get(o, i + k) for k in range(1, window)])), F.lit(1), F.greatest(F.size(o) - (window - 1), F.lit(0))))

    def starts(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return _let(by_hash, lambda s: F.sort_array(F.filter(F.transform(s, lambda x, i: F.when(
            F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)), x["p"])), lambda p: p.isNotNull())))

    def covered(s: Column) -> Column:
        steps = F.transform(s, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(s, i + 1) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    some = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _let(starts(h), covered)).otherwise(0))
    return F.when(F.size(w) >= window, some).otherwise(0).cast("long")


def judgement(text: Column, rules=RULES, lang: Column | None = None) -> Column:
    """A struct of all measures, ``base_failed`` and ``kept``, each computed once."""
    covered = F.lit(True) if lang is None else F.coalesce(lang.isin(*COVERED), F.lit(True))
    t = F.coalesce(text, F.lit(""))

    def counts(w: Column, lines: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            F.coalesce(F.array_max(F.transform(w, F.char_length)), F.lit(0)).cast("long").alias("longest_word_chars"))

    def ratios(c: Column) -> Column:
        ratio = lambda a, b: F.when(c[b] > 0, c[a] / c[b]).otherwise(0.0)
        return F.struct(*[c[n].alias(n) for n in (*COUNTS, "n_lines", "n_stop_words", "longest_word_chars")],
                        ratio("word_chars", "n_words").alias("mean_word_chars"),
                        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
                        F.when(covered & (c["n_words"] > 0), (c["n_stop_words"] + 1) / c["n_words"]).otherwise(1.0).alias("stop_word_ratio"),
                        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"))

    def judged(m: Column) -> Column:
        failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
        return F.struct(*[m[n].alias(n) for n in MEASURES], failed.alias("base_failed"), (~failed & verdict(m, rules)).alias("kept"))

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    both = _let(words(text), lambda w: _let(lines, lambda ls: counts(w, ls)))
    return _let(_let(both, ratios), judged)


def verdict(m: Column, rules=RULES) -> Column:
    """The conjunction of all thresholds on a struct of measures."""
    out = F.lit(True)
    for _, measure, least, most in rules:
        if least is not None:
            out = out & (m[measure] >= least)
        if most is not None:
            out = out & (m[measure] <= most)
    return out


def judge(df: DataFrame, text: str = "text", rules=RULES, prefix: str = "", lang: str | None = None) -> DataFrame:
    """All rows with measures, ``base_failed`` and ``kept`` (names after ``prefix``); ``lang``: a column of language codes."""
    names = [prefix + n for n in (*MEASURES, "base_failed", "kept", "judgement")]
    if clash := sorted({*names} & {*df.columns}):
        raise ValueError(f"columns clash with measures, give a prefix: {clash}")
    whole = F.col(names[-1])
    made = judgement(column(text), rules, None if lang is None else column(lang))
    return df.withColumn(names[-1], made).select(
        *[column(c) for c in df.columns], *[whole[n[len(prefix):]].alias(n) for n in names[:-1]])
