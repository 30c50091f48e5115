"""Work of one task stays bounded as tables grow; what bounds it leaves the results alone."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.functions.vectors import l2_normalize
from quarry.operators import bm25, encode, lexical_index
from quarry.operators.lexical_index import LexicalIndex
from quarry.plans import catalog
from quarry.sources import tables


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def lists_of(n_docs, words, seed=3):
    """Posting lists of ``words`` tokens, from frequent to rare, over ``n_docs`` documents."""
    rng = np.random.default_rng(seed)
    ids = [np.sort(rng.choice(n_docs, max(1, n_docs // (w + 1)), replace=False)) for w in range(words)]
    return pa.table({"block": pa.array([0] * words, pa.int64()), "token": [f"w{w}" for w in range(words)],
                     "ids": pa.array([i.tolist() for i in ids], pa.list_(pa.int64())),
                     "tf": pa.array([rng.integers(1, 5, len(i)).tolist() for i in ids], pa.list_(pa.int32())),
                     "len": pa.array([[50] * len(i) for i in ids], pa.list_(pa.int32()))})


def test_buckets_follow_the_size(spark):
    df = spark.range(40_000_000)
    assert tables.choose_buckets(df) * 16 * 1024 * 1024 >= tables.plan_bytes(df)


def test_blocks_follow_the_characters(spark, tmp_path, monkeypatch):
    corpus = spark.createDataFrame([(i, f"w{i} " * 100) for i in range(40)], "doc_id long, contents string")
    monkeypatch.setattr(lexical_index, "BLOCK_CHARS", 2000)
    index = LexicalIndex.build(corpus, str(tmp_path / "i"))
    assert index.segments[0]["n_blocks"] >= 7
    asked = spark.createDataFrame([(1, "w3 w7")], "qid long, question string")
    assert sorted(r.doc_id for r in index.top_k(asked, k=5).collect()) == [3, 7]


def test_posting_lists_are_in_order_with_repeated_and_null_ids():
    rows = pa.table({"block": pa.array([4] * 5, pa.int64()), "token": ["b", "a", "b", "b", "a"],
                     "ids": pa.array([9, 2, 1, None, 2], pa.int64()), "tf": pa.array([1, 2, 3, 4, 5], pa.int32()),
                     "len": pa.array([6, 7, 8, 9, 10], pa.int32())})
    made = lexical_index.block_lists(rows).to_pydict()
    assert made == {"block": [4, 4], "token": ["a", "b"], "ids": [[2, 2], [None, 1, 9]], "tf": [[2, 5], [4, 3, 1]],
                    "len": [[7, 10], [9, 8, 6]]}


def test_batches_of_queries_equal_single_ones():
    block = lexical_index._Block(lists_of(3000, 120), bm25.Bm25Params(), 50.0)
    rng = np.random.default_rng(5)
    asked = [(np.sort(rng.choice(120, rng.integers(0, 30), replace=False)), rng.random(30)) for _ in range(700)]
    asked = [(at, w[:len(at)] - (0.5 if q % 50 == 0 else 0)) for q, (at, w) in enumerate(asked)]
    which = np.repeat(np.arange(len(asked)), [len(at) for at, _ in asked])
    at, weight = (np.concatenate(x) for x in zip(*asked))
    for k in (1, 20, 5000):
        for floor in (-np.inf, 2.0):
            got = block.search(which, at, weight, np.full(len(asked), floor), k, 6)
            for q, (own, w) in enumerate(asked):
                docs, scores = block.best(own, w, k, -np.inf, 6)
                mine = got[0] == q
                found = dict(zip(got[1][mine].tolist(), np.round(got[2][mine], 6).tolist()))
                want = dict(zip(docs.tolist(), np.round(scores, 6).tolist()))
                if floor > 0 and (w > 0).all():  # below the threshold nothing is promised
                    found, want = ({d: s for d, s in x.items() if s >= floor} for x in (found, want))
                assert found == want


def test_postings_of_documents_that_share_an_id_add_up():
    lists = pa.table({"block": pa.array([0], pa.int64()), "token": ["a"], "ids": pa.array([[1, 1, 2]], pa.list_(pa.int64())),
                      "tf": pa.array([[1, 1, 1]], pa.list_(pa.int32())), "len": pa.array([[50, 50, 50]], pa.list_(pa.int32()))})
    for direct in (0, 100):
        block = lexical_index._Block(lists, bm25.Bm25Params(), 50.0, direct)
        docs, scores = block.best(np.array([0]), np.array([1.0]), 5, -np.inf, 6)
        assert dict(zip(docs.tolist(), scores.round(6).tolist())) == {0: 2.0, 1: 1.0}


def test_hash_encode_makes_no_row_per_token(spark):
    rows = [(1, "a b a"), (1, "c a"), (2, None), (3, ""), (4, "b " * 500), (None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, contents string")
    made = encode.hash_encode(df)
    assert "Generate" not in plan(made)
    got = {r.doc_id: r.embedding for r in made.collect()}
    want = encode._unit(encode.HashingEncoder(128)(["a b a c a", "", "", "b " * 500, "d"]))
    assert [np.round(got[i], 12).tolist() for i in (1, 2, 3, 4, None)] == want.round(12).tolist()


def test_a_vector_is_measured_once(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,), ([],)], "v array<double>").select(l2_normalize("v").alias("v"))
    assert [r.v for r in df.collect()] == [[0.6, 0.8], [0.0, 0.0], None, []]
    assert plan(df).count("aggregate(") <= 1


def test_landed_files_follow_the_size(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)] + [(None, "x")], "doc_id long, contents string")
    monkeypatch.setattr(tables, "choose_buckets", lambda df, minimum=None: 12)
    catalog._land(docs, str(tmp_path / "landing"))
    assert len(list((tmp_path / "landing").rglob("*.parquet"))) > 5
    back = spark.read.parquet(str(tmp_path / "landing"))
    assert back.count() == 401 and back.select("part").distinct().count() == 5
    assert back.where(F.col("part") != F.col("doc_id") % 4).isEmpty()
