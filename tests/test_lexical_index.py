"""The stored index: equal to adding up every posting, reopened by path, extended by appends."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import bm25, lexical_index
from quarry.operators.lexical_index import LexicalIndex


def texts(n, seed=1):
    """Few frequent and many rare words; copies, a null, an empty and a long text."""
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(40 * n)]
    rows = [(i, " ".join(words[40 * i:40 * i + rng.randrange(1, 40)])) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "w1 " * 3000), (n + 3, rows[0][1]), (n + 4, rows[0][1])]


QUERIES = [(1, "w1 w2 w3"), (2, "w1 w1 w7 w19 w101"), (3, "nosuchword"), (4, ""), (5, None), (6, "w1"),
           (7, " ".join(f"w{i}" for i in range(1, 400)))]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(texts(900), "doc_id long, contents string").repartition(3)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "qid long, question string")


def ranked(df):
    return sorted((r.qid, r["rank"], r.doc_id, round(r.score, 6)) for r in df.collect())


@pytest.fixture(scope="module")
def expected(corpus, queries):
    plain = bm25.build_index(corpus)
    return {k: ranked(bm25.top_k_lexical(plain, queries, k=k)) for k in (3, 40)}


@pytest.mark.parametrize("first_pass,direct", [(2, 0), (3, 200), (10_000, 0), (10_000, 1 << 20)])
def test_bounded_search_equals_full_scores(corpus, queries, expected, tmp_path, first_pass, direct):
    index = LexicalIndex.build(corpus, str(tmp_path / "i"))
    assert sum(s["n_blocks"] for s in index.segments) >= 4
    for k, want in expected.items():
        assert ranked(index.top_k(queries, k=k, first_pass=first_pass, direct=direct)) == want


def test_append_equals_one_build_and_old_versions_stay(spark, corpus, queries, expected, tmp_path):
    path = str(tmp_path / "i")
    early = corpus.where("doc_id % 3 > 0")
    first = LexicalIndex.build(early, path)
    before = ranked(first.top_k(queries, k=3))
    LexicalIndex.open(spark, path).append(corpus.where("doc_id % 3 = 0").unionByName(early.limit(5)))
    spark.sql(f"DROP TABLE {first.lists_table}")  # as a new application: only the files are known
    again = LexicalIndex.open(spark, path)
    assert again.manifest["version"] == 2 and ranked(again.top_k(queries, k=40)) == expected[40]
    assert again.fingerprint() == lexical_index._print(corpus, "doc_id")
    assert ranked(LexicalIndex.open(spark, path, version=1).top_k(queries, k=3)) == before
    third = again.append(corpus.where("false"))
    assert third.manifest["version"] == 3 and ranked(third.top_k(queries, k=3)) == expected[3]


def test_reopening_checks_the_corpus(spark, corpus, tmp_path):
    path = str(tmp_path / "i")
    built = LexicalIndex.open_or_build(corpus, path)
    assert LexicalIndex.open_or_build(corpus.repartition(7), path).segments == built.segments
    with pytest.raises(ValueError):
        LexicalIndex.open_or_build(corpus.withColumn("contents", F.lit("x")), path)
    with pytest.raises(FileNotFoundError):
        LexicalIndex.open(spark, str(tmp_path / "none"))


def test_an_unfinished_or_second_append_changes_nothing(spark, corpus, queries, expected, tmp_path, monkeypatch):
    path = str(tmp_path / "i")
    index = LexicalIndex.build(corpus, path)
    more = spark.createDataFrame([(10_000, "w1 w2")], "doc_id long, contents string")

    def crash(*_):
        raise OSError("lost before the manifest")

    with monkeypatch.context() as m:
        m.setattr(lexical_index, "_commit", crash)
        with pytest.raises(OSError):
            index.append(more)
    assert ranked(LexicalIndex.open(spark, path).top_k(queries, k=3)) == expected[3]
    index.append(more)
    with pytest.raises(RuntimeError):
        index.append(more)
    assert LexicalIndex.open(spark, path).documents().count() == corpus.count() + 1


def test_empty_corpus_and_string_ids(spark, queries, tmp_path):
    none = LexicalIndex.build(spark.createDataFrame([], "doc_id string, contents string"), str(tmp_path / "n"))
    assert none.top_k(queries, k=3).collect() == []
    rows = [("b", "w1 w2"), ("é", "w1 w2"), ("a", "w1 w2"), ("c", "other")]
    index = LexicalIndex.build(spark.createDataFrame(rows, "doc_id string, contents string"), str(tmp_path / "s"))
    assert [r.doc_id for r in index.top_k(queries.where("qid = 1"), k=2).orderBy("rank").collect()] == ["a", "b"]


def test_bounds_skip_frequent_postings():
    rng, n = np.random.default_rng(3), 50_000
    lists = {"common": np.arange(n), "half": np.arange(0, n, 2), "rare": rng.choice(n, 60, replace=False)}
    table = pa.table({"ids": [np.sort(v).tolist() for v in lists.values()],
                      "tf": [[1] * len(v) for v in lists.values()], "len": [[50] * len(v) for v in lists.values()]})
    block = lexical_index._Block(table, bm25.Bm25Params(), 50.0)
    weight = np.array([0.1, 0.7, 8.0])
    docs, scores = block.best(np.arange(3), weight, 20, -np.inf, 6)
    full = np.zeros(n)
    for v, w in zip(lists.values(), weight):
        full[v] += w
    order = np.lexsort((np.arange(n), -full))[:20]
    assert sorted(docs) == sorted(order) and np.allclose(scores, full[docs])
    assert block.read < 0.6 * sum(map(len, lists.values()))
    assert len(block.best(np.arange(3), weight, 20, 9.0, 6)[0]) == 0  # a block below the threshold is not read at all


def test_packed_queries_come_back(monkeypatch):
    """Queries are split at a bound, and what is copied to every block is small (495 bytes a query and block before, in a shuffle)."""
    rng = random.Random(5)
    asked = [(f"q{i}" if i % 7 else None, sorted({f"w{int(rng.paretovariate(0.8)) % 5000}" for _ in range(rng.randrange(0, 40))})) for i in range(3000)]
    weight = {t: rng.random() for _, ts in asked for t in ts}
    table = pa.table({"qid": pa.array([q for q, _ in asked]), "tokens": pa.array([ts for _, ts in asked], pa.list_(pa.string())),
                      "weights": pa.array([[weight[t] * (1 + i % 2) for t in ts] for i, (_, ts) in enumerate(asked)], pa.list_(pa.float64())),
                      "floor": pa.array([None if i % 3 else i / 7 for i in range(3000)], pa.float64())})
    monkeypatch.setattr(lexical_index, "PACK_TERMS", 20_000)
    rows = list(lexical_index.pack_queries("qid")(iter(table.to_batches(max_chunksize=700))))
    assert len(rows) >= 5
    back, n_bytes = [], 0
    for row in rows:
        packed = row.column("packed")[0].as_buffer()
        n_bytes += packed.size
        qids, floors, which, code, tokens, weights = lexical_index._unpacked(packed)
        assert len(qids) * 32 + len(code) <= 20_000
        for i, q in enumerate(qids.to_pylist()):
            own = code[which == i]
            back.append((q, floors[i], dict(zip([tokens[int(c)].as_py() for c in own], weights[own].tolist()))))
    assert back == [(q, i / 7 if i % 3 == 0 else -np.inf, {t: weight[t] * (1 + i % 2) for t in ts}) for i, (q, ts) in enumerate(asked)]
    assert n_bytes < 150 * 3000


def test_many_queries_are_searched_in_rounds(corpus, queries, expected, tmp_path, monkeypatch):
    monkeypatch.setattr(lexical_index, "ROUND_QUERIES", 2)
    index = LexicalIndex.build(corpus, str(tmp_path / "i"))
    found = index.top_k(queries, k=3, first_pass=2)
    assert ranked(found) == expected[3] and found._jdf.queryExecution().toString().count("FlatMapCoGroupsInArrow") >= 2


def test_thresholds_come_in_two_passes(corpus, queries, expected, tmp_path, monkeypatch):
    """One block in 16, then one in 4, then the rest; each pass is stored."""
    monkeypatch.setattr(lexical_index, "BLOCK_DOCS", 40)
    index, stored, kept = LexicalIndex.build(corpus, str(tmp_path / "i")), [], lexical_index.materialize
    monkeypatch.setattr(lexical_index, "materialize", lambda df, name: stored.append(name) or kept(df, name))
    assert ranked(index.top_k(queries, k=3, first_pass=16)) == expected[3]
    assert stored.count("first_pass") == 2
