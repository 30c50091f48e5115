from pyspark.sql import functions as F

from quarry.functions.text import lexical_text, relevance_text, snippet, tokens
from quarry.operators.corpus import map_source, recursive_chunks, source_counts, unify


def test_tokenizer_edge_cases(spark):
    df = spark.createDataFrame([(1, "Été_2 X-Ray"), (2, None), (3, ""), (4, "!!! ..."),
                                (5, "ÄÖÜ straße 42x")], "id int, t string")
    got = {r.id: r.tok for r in df.select("id", tokens("t").alias("tok")).collect()}
    assert got[1] == ["été_2", "x", "ray"]
    assert got[2] == [] and got[3] == [] and got[4] == []
    assert got[5] == ["äöü", "straße", "42x"]


def test_snippet_boundaries(spark):
    df = spark.createDataFrame([("a" * 500,), ("b" * 501,), (None,)], "c string")
    out = [r.s for r in df.select(snippet("c").alias("s")).collect()]
    assert out[0] == "a" * 500
    assert out[1] == "b" * 500 + "..."
    assert out[2] is None


def test_contents_null_propagates_and_fallback(spark):
    src = spark.createDataFrame([(1, "T", "A"), (2, None, "A"), (3, "T", None)],
                                "pid int, title string, abstract string")
    c = map_source(src, id_col="pid", title_col="title", content_col="abstract",
                   source="abstracts", id_prefix="pubmed_")
    rows = {r.doc_id: r for r in c.collect()}
    assert rows["pubmed_1"].contents == "T A"
    assert rows["pubmed_2"].contents is None and rows["pubmed_3"].contents is None
    fb = {r.doc_id: r.x for r in c.select("doc_id", lexical_text().alias("x")).collect()}
    assert fb["pubmed_2"] == "A" and fb["pubmed_3"] == ""


def test_union_and_counts(spark):
    a = spark.createDataFrame([("1", "s1", "t", "c", "t c")], "doc_id string, source string, title string, content string, contents string")
    b = spark.createDataFrame([("2", "s2", "t")], "doc_id string, source string, title string")
    u = unify([a, b])
    assert u.count() == 2
    counts = {r.source: r.n_docs for r in source_counts(u).collect()}
    assert counts == {"s1": 1, "s2": 1, None: 2}


def test_relevance_text_null_is_empty(spark):
    df = spark.createDataFrame([(None, "Body")], "title string, content string")
    assert df.select(relevance_text().alias("x")).first().x == " body"


def split_recursive(text: str | None, size: int = 1000,
                    separators=("\n\n", "\n", ". ", " ", "")) -> list[str]:
    """The recursive splitter, written as a recursion."""
    if not text:
        return []
    if len(text) <= size:
        return [text]
    for i, sep in enumerate(separators):
        if sep == "":
            return [text[j:j + size] for j in range(0, len(text), size)]
        if sep not in text:
            continue
        parts = text.split(sep)
        pieces = [p + sep for p in parts[:-1]] + [parts[-1]]
        pieces = [p for p in pieces if p]
        out: list[str] = []
        current = ""
        for piece in pieces:
            if len(piece) > size:
                if current:
                    out.append(current)
                    current = ""
                out.extend(split_recursive(piece, size, separators[i + 1:]))
            elif len(current) + len(piece) <= size:
                current += piece
            else:
                out.append(current)
                current = piece
        if current:
            out.append(current)
        return out
    return [text]


def test_recursive_chunks_equal_the_recursion(spark):
    import random
    rng = random.Random(5)
    rows = [("Para one. " * 80 + "\n\n" + "line two " * 150 + "\n" + "x" * 2500,), ("",), (None,), ("short",), ("x" * 1000,), ("\u00e9\U0001f600" * 900,),
            ("word " * 20_000,), ("\n" * 3000,), (". " * 1500,), ("a\n\n\n" * 700 + "b" * 1001,), (" " + "y" * 999 + " ",)]
    for _ in range(40):
        bits = ["\n\n", "\n", ". ", " ", ".", "w" * rng.randrange(1, 60), "z" * rng.randrange(1, 300)]
        rows.append(("".join(rng.choice(bits) for _ in range(rng.randrange(1, 400))),))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, contents string")
    for size in (1000, 37):
        got = {}
        for r in recursive_chunks(df, size=size).orderBy("doc_id", "chunk_no").collect():
            got.setdefault(r.doc_id, []).append(r.chunk)
        for i, (text,) in enumerate(rows):
            assert got.get(i, []) == split_recursive(text, size)
            assert "".join(got.get(i, [])) == (text or "") and all(0 < len(c) <= size for c in got.get(i, []))
