import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import dense


def brute(docs, queries, k, exclude_self=False):
    out = {}
    for qid, qv in queries:
        scored = []
        for did, dv in docs:
            if exclude_self and did == qid:
                continue
            scored.append((round(float(np.dot(qv, dv)), 6), did))
        scored.sort(key=lambda t: (-t[0], t[1]))
        out[qid] = [d for _, d in scored[:k]]
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    raw = rng.normal(size=(300, 8))
    raw[:40] = np.round(raw[:40])  # many exact ties
    raw[5] = 0.0                   # a zero vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(raw)]
    df = dense.normalize(spark.createDataFrame(rows, "doc_id long, embedding array<double>")
                         .repartition(5))
    local = [(r.doc_id, np.array(r.embedding)) for r in df.collect()]
    return df, local


def ranks(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append(r.doc_id)
    return out


def test_exact_topk_equals_brute_force(spark, vectors):
    df, local = vectors
    q = df.withColumnRenamed("doc_id", "qid")
    got = ranks(dense.topk(df, q, k=10, exclude_self=True))
    assert got == brute(local, local, 10, exclude_self=True)


def test_query_blocks_equal_a_single_block(spark, vectors):
    df, _ = vectors
    q = df.withColumnRenamed("doc_id", "qid")
    one = ranks(dense.topk(df, q, k=7))
    many = ranks(dense.topk(df, q, k=7, block_bytes=3000))
    assert one == many


def test_stored_blocks_are_read_without_a_shuffle(spark, vectors, tmp_path):
    df, local = vectors
    q = df.withColumnRenamed("doc_id", "qid")
    stored = dense.store_blocks(df, str(tmp_path / "blocks"))
    found = dense.topk(stored, q, k=10, exclude_self=True)
    assert ranks(found) == brute(local, local, 10, exclude_self=True)
    assert ranks(dense.topk(stored, q, k=7, block_bytes=3000)) == ranks(dense.topk(df, q, k=7))
    plan = found._jdf.queryExecution().executedPlan().toString()
    documents, queries = plan.split("FlatMapCoGroupsInArrow")[1].split("Generate")[0], plan.split("Generate")[0]
    assert "Bucketed: true" in documents and "BroadcastExchange" not in plan
    assert "WindowGroupLimit" in queries


def test_string_ids_nulls_and_unequal_lengths(spark):
    docs = spark.createDataFrame([("é", [1.0, 0.0]), ("z", [1.0, 0.0]), ("a", None), ("b", [0.0, 2.0])], "doc_id string, embedding array<float>")
    q = spark.createDataFrame([("z", [1.0, 0.0]), ("n", None)], "qid string, embedding array<double>")
    got = [(r.qid, r.doc_id, r["rank"]) for r in dense.topk(docs, q, k=2).orderBy("rank").collect()]
    assert got == [("z", "z", 1), ("z", "é", 2)]
    assert [r.doc_id for r in dense.topk(docs, q, k=5, exclude_self=True).orderBy("rank").collect()] == ["é", "b"]
    assert dense.topk(docs.where("false"), q, k=2).collect() == [] and dense.topk(docs, q.where("false"), k=2).collect() == []
    with pytest.raises(Exception, match="unequal length"):
        dense.topk(docs, q.withColumn("embedding", F.array(F.lit(1.0))), k=2).collect()


def test_zero_vector_and_small_corpus(spark):
    docs = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "doc_id long, embedding array<double>")
    q = spark.createDataFrame([("a", [0.0, 1.0])], "qid string, embedding array<double>")
    out = dense.topk(docs, q, k=5).collect()
    assert len(out) == 2 and all(r.score == 0.0 for r in out)
    assert [r.doc_id for r in sorted(out, key=lambda r: r.rank)] == [1, 2]
    norm = dense.normalize(docs).orderBy("doc_id").collect()
    assert norm[0].embedding == [0.0, 0.0] and norm[1].embedding == [1.0, 0.0]


def test_coverage(spark):
    corpus = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    vecs = spark.createDataFrame([(1, [0.0], "ok"), (2, None, "error"), (9, [1.0], "ok")],
                                 "doc_id long, embedding array<double>, status string")
    r = dense.coverage(corpus, vecs).first()
    assert (r.n_docs, r.n_vectors, r.missing, r.orphan, r.errors, r.zero_vectors) == (3, 3, 1, 1, 1, 1)


def reference(D, Q, k, precision, own=None):
    out = []
    for q in range(len(Q)):
        S = D @ Q[q] if precision is None else np.round(D @ Q[q], precision)
        rows = [r for r in range(len(D)) if own is None or not own[0][q] <= r < own[1][q]]
        out += [(q, r) for r in sorted(rows, key=lambda r: (-S[r], r))[:k]]
    return out


@pytest.mark.parametrize("n, d, k, scale", [(3000, 16, 20, 1.0), (17, 3, 20, 1.0), (9000, 8, 300, 1e-4), (2000, 5, 7, 1e200), (2000, 5, 7, 1e-160)])
def test_single_precision_rules_out_no_neighbour(n, d, k, scale):
    rng = np.random.default_rng(n)
    D = rng.normal(size=(n, d)) * scale ** 0.5
    D[rng.integers(0, n, n // 4)] = D[0]           # a large group of equal vectors
    D[n // 2] = 0.0
    D[n // 3] = D[1] * (1 + 1e-9)                    # told apart by double precision at most
    Q = np.r_[D[:150], np.zeros((1, d))]
    own = np.arange(len(Q)), np.arange(len(Q)) + 1
    for precision in (6, None):
        q, row, score = dense._nearest(D, Q[:len(D)], k, precision, tuple(x[:len(D)] for x in own))
        if precision is not None:
            assert list(zip(q.tolist(), row.tolist())) == reference(D, Q[:len(D)], k, precision, tuple(x[:len(D)] for x in own))
        exact = np.einsum("ij,ij->i", Q[q], D[row])
        assert np.allclose(score, exact if precision is None else np.round(exact, precision), rtol=1e-12, atol=1e-12 * scale)


def test_few_pairs_are_multiplied_in_double_precision(monkeypatch):
    """Every pair was scored in double precision, rounded and partitioned (96 ns a pair at 64 dimensions)."""
    rng, pairs = np.random.default_rng(3), []
    D = rng.normal(size=(8000, 64))
    D /= np.linalg.norm(D, axis=1, keepdims=True)
    scored = dense._scores
    monkeypatch.setattr(dense, "_scores", lambda D, Q, q, *rest: pairs.append(len(q)) or scored(D, Q, q, *rest))
    q, row, _ = dense._nearest(D, D[:500], 20, 6, None)
    assert list(zip(q.tolist(), row.tolist())) == reference(D, D[:500], 20, 6)
    assert sum(pairs) < 0.01 * 8000 * 500


def test_values_that_are_not_finite_take_the_plain_way(spark):
    rows = [(1, [1.0, 0.0]), (2, [float("nan"), 0.0]), (3, [0.5, 0.0]), (4, [0.25, 0.0])]
    docs = spark.createDataFrame(rows, "doc_id long, embedding array<double>")
    q = docs.where("doc_id <> 2").withColumnRenamed("doc_id", "qid")
    assert ranks(dense.topk(docs, q, k=2, exclude_self=True)) == {1: [3, 4], 3: [1, 4], 4: [1, 3]}


def test_label_metrics_use_the_same_search(spark, tmp_path):
    """Every vector asks all others, a group of equal vectors among them; the metrics follow from the plain order."""
    from quarry.plans import catalog
    rng = np.random.default_rng(11)
    raw = rng.normal(size=(90, 6)).astype(np.float32)
    raw[60:] = raw[3]
    rows = [(i, [float(x) for x in v], int(i % 4)) for i, v in enumerate(raw)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    V = raw.astype(float) / np.linalg.norm(raw.astype(float), axis=1, keepdims=True)
    found = reference(V, V, 20, 6, (np.arange(90), np.arange(90) + 1))
    at = {k: np.mean([any(r % 4 == q % 4 for qq, r in found[20 * q:20 * q + k]) for q in range(90)]) for k in (5, 10, 20)}
    got = {(r.metric, r.k): (r.value, r.n_queries) for r in catalog.QUERIES["label_dense_metrics"](spark, str(tmp_path)).collect()}
    assert {k: got["hit", k] for k in at} == {k: (round(v, 6), 90) for k, v in at.items()}
