"""Text column expressions.  All are built-in Spark functions (JVM, codegen); ``split_tokens`` is for Arrow functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a maximal run of Unicode letters, digits and
# underscore, matched on the lower-cased text.  This equals Python's
# ``re.findall(r"\b\w+\b", text.lower())``; Java's ``\w`` is ASCII-only, so the
# classes are spelled out.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
BETWEEN_PATTERN = r"[^\p{L}\p{N}_]+"

SNIPPET_CHARS = 500


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Lower-case, extract all tokens; null text gives an empty array."""
    text = _col(text)
    extracted = F.regexp_extract_all(F.lower(text.cast("string")), F.lit(TOKEN_PATTERN), 0)
    return F.coalesce(extracted, F.array().cast("array<string>"))


def token_text(text) -> Column:
    """The tokens joined by one space, which no token holds: a row's tokens go to Arrow as one value.  Null text gives ''."""
    joined = F.regexp_replace(F.lower(_col(text).cast("string")), F.lit(BETWEEN_PATTERN), F.lit(" "))
    return F.coalesce(F.trim(joined), F.lit(""))


def split_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all rows of ``token_text``, and how many each row has."""
    parts = pc.split_pattern(texts, " ")
    length, values = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), parts.flatten()
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    if empty.any():
        length[empty], values = 0, values.filter(pc.not_equal(values, ""))
    return values, length


def snippet(content, max_chars: int = SNIPPET_CHARS) -> Column:
    """First ``max_chars`` characters plus ``...`` when longer, else unchanged."""
    content = _col(content)
    return (F.when(F.length(content) > max_chars,
                   F.concat(F.substring(content, 1, max_chars), F.lit("...")))
            .otherwise(content))


def first_line(text) -> Column:
    return F.substring_index(_col(text), "\n", 1)


def clean_text(text) -> Column:
    """Encoder input: null becomes the empty string, other types their string."""
    return F.coalesce(_col(text).cast("string"), F.lit(""))


def lexical_text(contents="contents", content="content", null_policy: str = "fallback") -> Column:
    """Text indexed by BM25.

    ``fallback``: ``contents``, else ``content``, else ``''``.
    ``empty``: ``contents`` only; a null gives no tokens.
    """
    if null_policy == "fallback":
        return F.coalesce(_col(contents), _col(content), F.lit(""))
    if null_policy == "empty":
        return F.coalesce(_col(contents), F.lit(""))
    raise ValueError(f"unknown null_policy: {null_policy}")


def relevance_text(title="title", content="content") -> Column:
    """Lower-cased ``title + ' ' + content`` used by keyword relevance (null -> '')."""
    return F.lower(F.concat(F.coalesce(_col(title), F.lit("")), F.lit(" "),
                            F.coalesce(_col(content), F.lit(""))))
