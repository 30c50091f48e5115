"""Corpus preparation: source mapping, union, counts, snippets, chunking."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORPUS_COLUMNS = ["doc_id", "source", "title", "content", "contents"]


def map_source(df: DataFrame, *, id_col: str, title_col: str, content_col: str,
               source: str, id_prefix: str = "") -> DataFrame:
    """Map a (id, title, body) table to the corpus contract.

    ``doc_id`` = prefix + id as string; ``contents`` = title + ' ' + content and
    is null when either part is null (``concat`` propagates nulls).
    """
    title, content = F.col(title_col).cast("string"), F.col(content_col).cast("string")
    return df.select(
        F.concat(F.lit(id_prefix), F.col(id_col).cast("string")).alias("doc_id"),
        F.lit(source).alias("source"),
        title.alias("title"),
        content.alias("content"),
        F.concat(title, F.lit(" "), content).alias("contents"),
    )


def unify(sources: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns missing from a source become null."""
    if not sources:
        raise ValueError("no sources")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def source_counts(corpus: DataFrame, source_col: str = "source") -> DataFrame:
    """Rows per source plus a total row (``source`` null), via ``rollup``."""
    return (corpus.rollup(source_col)
                  .agg(F.count(F.lit(1)).alias("n_docs")))


def fixed_chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "contents",
                 size: int = 1000) -> DataFrame:
    """Cut every ``size`` characters: (id, chunk_no, chunk).  Empty text: no chunk."""
    n = F.ceil(F.length(text_col) / F.lit(size)).cast("int")
    starts = F.when(F.length(text_col) > 0, F.sequence(F.lit(0), n - 1))
    return (df.select(id_col, text_col, F.explode(starts).alias("chunk_no"))
              .select(id_col, "chunk_no",
                      F.expr(f"substring({text_col}, chunk_no * {size} + 1, {size})").alias("chunk")))


# Separators tried in order by the recursive splitter
# (paragraph, line, sentence, word; then a hard cut).
CHUNK_SEPARATORS = ("\n\n", "\n", ". ", " ")
#: Pieces merged in one go; what a run made is set aside, so long texts are not copied at every step.
MERGE_RUN = 1024


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once (bound to a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def _pieces(text: Column, separator: str) -> Column:
    """Text cut after every separator; empty pieces are left out."""
    def attach(parts: Column) -> Column:
        kept = F.transform(parts, lambda p, i: F.when(i < F.size(parts) - 1, F.concat(p, F.lit(separator))).otherwise(p))
        return F.filter(kept, lambda p: p != "")

    return _let(F.split(text, separator.replace(".", r"\."), -1), attach)


def _state(out: Column, current: Column) -> Column:
    return F.struct(out.alias("out"), current.alias("current"))


def _merged(pieces: Column, size: int) -> Column:
    """Neighbouring pieces joined up to ``size`` characters; a longer piece stands alone."""
    none = F.array().cast("array<string>")

    def add(state: Column, piece: Column) -> Column:
        done = F.when(state["current"] != "", F.concat(state["out"], F.array(state["current"]))).otherwise(state["out"])
        fits = F.char_length(state["current"]) + F.char_length(piece) <= size
        return F.when(fits, _state(state["out"], F.concat(state["current"], piece))).when(
            F.char_length(piece) > size, _state(F.concat(done, F.array(piece)), F.lit(""))).otherwise(_state(done, piece))

    def run(state: Column, start: Column) -> Column:
        made = F.aggregate(F.slice(pieces, start, MERGE_RUN), _state(none, state["current"]), add)
        return _let(made, lambda m: F.struct(F.concat(state["runs"], F.array(m["out"])).alias("runs"), m["current"].alias("current")))

    def last(state: Column) -> Column:
        end = F.when(state["current"] != "", F.array(state["current"])).otherwise(none)
        return F.concat(F.flatten(state["runs"]), end)

    first = F.struct(F.array().cast("array<array<string>>").alias("runs"), F.lit("").alias("current"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(MERGE_RUN)), first, run, last)


def split_column(text: Column, size: int = 1000, separators: Sequence[str] = CHUNK_SEPARATORS) -> Column:
    """Chunks of at most ``size`` characters, as an array.

    A text that fits is one chunk; else it is cut at the first separator that it
    holds and its pieces are merged greedily; pieces still too long go on with
    the separators after it and in the end are cut every ``size`` characters.
    Separators stay with the piece before them, so the chunks joined are the
    text.  Null and empty texts have none.
    """
    def level(items: Column, separator: str) -> Column:
        return F.flatten(F.transform(items, lambda x: F.when(F.char_length(x) > size, _let(
            _pieces(x, separator), lambda ps: _merged(ps, size))).otherwise(F.array(x))))

    items = F.when(F.coalesce(text, F.lit("")) != "", F.array(text)).otherwise(F.array().cast("array<string>"))
    for separator in separators:
        items = level(items, separator)
    cut = F.lit(f"(?s).{{1,{size}}}")
    return F.flatten(F.transform(items, lambda x: F.when(
        F.char_length(x) > size, F.regexp_extract_all(x, cut, 0)).otherwise(F.array(x))))


def recursive_chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "contents",
                     size: int = 1000) -> DataFrame:
    """(id, chunk_no, chunk) with the recursive splitter; Spark functions only."""
    return (df.select(id_col, F.posexplode(split_column(F.col(text_col), size)).alias("chunk_no", "chunk"))
              .withColumn("chunk_no", F.col("chunk_no").cast("int")))


def preview(results: DataFrame, n: int = 3, qid_col: str = "qid") -> DataFrame:
    """First ``n`` results per query: id, shortened title and score."""
    return (results.where(F.col("rank") <= n)
                   .select(qid_col, "rank", "id", F.substring("title", 1, 50).alias("title"),
                           "score"))
