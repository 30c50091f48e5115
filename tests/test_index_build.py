"""The index is built from each text once, and holds what the posting rows hold."""

import glob

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quarry.functions.text import split_tokens, token_text, tokens
from quarry.operators import bm25, encode, lexical_index
from quarry.operators.lexical_index import LexicalIndex
from quarry.plans.workspace import Workspace

ODD = ["Été_2 X-Ray", None, "", " ", "...\n\t", "İI ß ﬁ 𝒜𝟘x-𐐀 a b", "a b a", "_", "áe ²½ ٣", "end.", "\n x \n\n y"]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, f"w{i % 7} w{i % 3} w1 w1 common{i}") for i in range(600)]
    rows += [(5, "w1 w2 w1"), (5, "w1 w2 w1"), (5, "w1"), (None, "w2 w9"), (None, "w2 w8"), (None, None)]
    rows += [(1000 + i, text) for i, text in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, contents string").repartition(3)


def test_tokens_of_a_row_go_as_one_value(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "i int, text string")
    rows = df.select("i", tokens("text").alias("t"), token_text("text").alias("joined")).orderBy("i").collect()
    values, length = split_tokens(pa.array([r.joined for r in rows], pa.string()))
    ends = np.r_[0, np.cumsum(length)]
    assert [values[a:b].to_pylist() for a, b in zip(ends, ends[1:])] == [r.t for r in rows]
    assert split_tokens(pa.array(["", ""], pa.string()))[0].to_pylist() == [] and not len(split_tokens(pa.array([], pa.string()))[1])


def test_lists_from_texts_equal_those_from_posting_rows():
    texts, ids = ["b a b", "a", "", "b", "b a b", "c b a"], [9, 2, 1, None, 9, 9]
    seen = {}
    for i, text in zip(ids, texts):
        for token in text.split():
            key = (token, i, len(text.split()))
            seen[key] = seen.get(key, 0) + 1
    flat = [(*key, tf) for key, tf in sorted(seen.items(), key=lambda x: (x[0][0], x[0][1] or -1, x[0][2]))]
    rows = pa.table({"block": pa.array([4] * len(flat), pa.int64()), "token": [t for t, *_ in flat], "ids": pa.array([i for _, i, *_ in flat], pa.int64()),
                     "tf": pa.array([x[3] for x in flat], pa.int32()), "len": pa.array([x[2] for x in flat], pa.int32())})
    given = pa.table({"block": pa.array([4] * 6, pa.int64()), "ids": pa.array(ids, pa.int64()), "tokens": texts})
    made = lexical_index.token_lists(given)
    assert made.to_pydict() == lexical_index.block_lists(rows).to_pydict() and made.schema == lexical_index.block_lists(rows).schema
    counted = lexical_index._counted(lexical_index.token_lists)(given).to_pydict()
    assert counted["df"] == [len(x) for x in counted["ids"]] and counted["n"] == [sum(x) for x in counted["tf"]]
    none = lexical_index._counted(lexical_index.token_lists)(given.set_column(2, "tokens", pa.array([""] * 6)))
    assert none.num_rows == 0


def contents(index):
    cells = index.lists().select("token", F.explode(F.arrays_zip("ids", "tf", "len")).alias("p")).select("token", "p.ids", "p.tf", "p.len")
    return sorted(((r.token, r.ids is None, r.ids or 0, r.len, r.tf) for r in cells.collect()))


def test_an_index_of_texts_holds_the_postings(corpus, tmp_path):
    plain = bm25.build_index(corpus)
    made = LexicalIndex.build(corpus, str(tmp_path / "t"), buckets=5)
    given = LexicalIndex.build(corpus, str(tmp_path / "p"), postings=plain.postings)
    want = sorted((r.token, r.doc_id is None, r.doc_id or 0, r.doc_len, r.tf) for r in plain.postings.collect())
    assert contents(made) == contents(given) == want and made.manifest["buckets"] == 5
    stats, wanted = made.corpus_stats(), plain.corpus_stats.first()
    assert stats.dtypes == plain.corpus_stats.select("n_docs", "n_tokens", "avgdl", "n_terms", "avg_idf").dtypes
    got = stats.first()
    assert all(got[c] == wanted[c] for c in ("n_docs", "n_tokens", "n_terms", "avgdl")) and abs(got["avg_idf"] - wanted["avg_idf"]) < 1e-9
    rounded = [F.round("idf", 9).alias("idf")]
    assert sorted(made.term_stats().select("token", "df", *rounded).collect()) == sorted(plain.term_stats.select("token", "df", *rounded).collect())


def test_hashes_of_a_batch():
    words = ["a", "été", "𝒜", "x" * 300]
    hashed = encode._hashes(pa.array(["skipped", *words])[1:])
    for dim in (32, 128, 100):
        assert [(h % dim, 1.0 - 2.0 * (h // dim % 2)) for h in hashed.tolist()] == [encode._bucket_sign(w, dim) for w in words]
    assert not len(encode._hashes(pa.array([], pa.string())))


def test_a_workspace_stores_each_text_once(spark, tmp_path):
    spark.createDataFrame([(i, f"title {i}\nbody {i}", "en", "s", 9) for i in range(50)] + [(7, None, None, None, None)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    ws = Workspace(spark, str(tmp_path))
    corpus, index = ws.corpus(), ws.index()
    stored = {name for f in corpus.inputFiles() for name in pq.read_schema(f.replace("file:", "", 1)).names}
    assert stored == {"doc_id", "text"} and corpus.columns == ["doc_id", "source", "title", "content", "contents"]
    made = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir').replace('file:', '', 1)}/quarry/*"))
    n = index.postings.count()  # written when it is first read, and once
    later = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir').replace('file:', '', 1)}/quarry/*"))
    assert len(later - made) == 1 and index.postings.count() == n == index.postings.select("token", "doc_id").distinct().count()
    assert index.corpus_stats.first()["n_docs"] == 51


def test_vectors_of_several_widths_tokenize_each_text_once(spark, corpus, tmp_path):
    made = encode.hash_encode_dims(corpus, {128: "wide", 32: "narrow"})
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("regexp_replace") == 1
    rows = sorted(made.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    for dim, name in ((128, "wide"), (32, "narrow")):
        alone = sorted(encode.hash_encode(corpus, dim=dim).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
        assert [(r.doc_id, r[name]) for r in rows] == [(r.doc_id, r.embedding) for r in alone]
        plain = encode.HashingEncoder(dim)([ODD[0]])[0]
        assert np.allclose(next(r[name] for r in rows if r.doc_id == 1000), plain / np.linalg.norm(plain))
    spark.createDataFrame([(i % 40, f"title {i}\nbody {i}") for i in range(50)] + [(7, None), (None, "x")],
                          "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    ws = Workspace(spark, str(tmp_path))
    ws.encode_documents(128, 32)
    assert ws.doc_vectors(128).inputFiles() == ws.doc_vectors(32).inputFiles()
    assert ws.doc_vectors(32).columns == ["doc_id", "embedding"] and ws.doc_vectors(32).count() == 41
    assert {len(r.embedding) for r in ws.doc_vectors(32).collect()} == {32}
    assert ws.doc_vectors(64).inputFiles() != ws.doc_vectors(32).inputFiles()
