import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import metrics, relevance, report


def judged(spark, qid, gains, ranks=None):
    ranks = ranks or list(range(1, len(gains) + 1))
    rows = [(qid, "m", r, g) for r, g in zip(ranks, gains)]
    return spark.createDataFrame(rows, "qid string, method string, rank int, gain int")


def metric_map(df):
    return {(r.metric, r.k): r.value for r in df.collect()}


def run(spark, gains, k=(5,), ranks=None, with_dcg=True):
    g = metrics.ordered_gains(judged(spark, "q", gains, ranks))
    return metric_map(metrics.per_query(g, k, with_dcg=with_dcg))


def test_hand_case_graded(spark):
    m = run(spark, [0, 2, 0, 1])
    assert m[("hit", 5)] == 1.0 and m[("mrr", 5)] == 0.5 and m[("recall", 5)] == 1.0
    dcg = 2 / math.log2(3) + 1 / math.log2(5)
    idcg = 2 + 1 / math.log2(3)
    assert m[("dcg", 5)] == pytest.approx(dcg) and m[("idcg", 5)] == pytest.approx(idcg)
    assert m[("ndcg", 5)] == pytest.approx(dcg / idcg)


def test_no_relevant(spark):
    m = run(spark, [0, 0, 0])
    assert m[("hit", 5)] == 0.0 and m[("mrr", 5)] == 0.0
    assert m[("recall", 5)] is None and m[("ndcg", 5)] is None


def test_first_relevant_after_k(spark):
    m = run(spark, [0] * 6 + [1])
    assert m[("hit", 5)] == 0.0 and m[("mrr", 5)] == 0.0
    assert m[("recall", 5)] == 0.0 and m[("ndcg", 5)] == 0.0


def test_list_shorter_than_k(spark):
    a = run(spark, [0, 1, 2], k=(3, 20))
    for name in ("hit", "mrr", "recall", "ndcg"):
        assert a[(name, 3)] == pytest.approx(a[(name, 20)])


def test_missing_rank_sorts_last(spark):
    m = run(spark, [1, 0, 0], ranks=[None, 1, 2])
    assert m[("mrr", 5)] == pytest.approx(1 / 3)


def test_monotone_in_k_and_ndcg_bounded(spark):
    gains = [0, 1, 0, 2, 0, 0, 1, 0, 0, 0, 2, 0]
    m = run(spark, gains, k=(1, 3, 5, 10, 20))
    ks = (1, 3, 5, 10, 20)
    for name in ("hit", "recall"):
        vals = [m[(name, k)] for k in ks]
        assert vals == sorted(vals)
    assert all(0.0 <= m[("ndcg", k)] <= 1.0 + 1e-12 for k in ks if m[("ndcg", k)] is not None)


def test_summary_skips_nulls(spark):
    g = metrics.ordered_gains(judged(spark, "q1", [0, 1]).unionByName(judged(spark, "q2", [0, 0])))
    s = metrics.summarize(metrics.per_query(g, (5,)))
    got = {(r.metric, r.k): (r.value, r.n_values, r.n_queries) for r in s.collect()}
    assert got[("recall", 5)] == (1.0, 1, 2)
    assert got[("hit", 5)] == (0.5, 2, 2)


def test_gold_relevance_last_wins_and_default(spark):
    res = spark.createDataFrame([("q1", "a", 1), ("q1", "b", 2), ("q2", "a", 1)],
                                "qid string, id string, rank int")
    gold = spark.createDataFrame([("q1", "a", 1, 0), ("q1", "a", 2, 1), ("q1", None, 2, 2)],
                                 "qid string, id string, relevance_score int, pos int")
    out = {(r.qid, r.id): r.gain for r in relevance.gold_gains(res, gold).collect()}
    assert out == {("q1", "a"): 2, ("q1", "b"): 0, ("q2", "a"): 0}
    with pytest.raises(ValueError):
        relevance.gold_gains(res, None)


def test_keyword_rules(spark):
    rules = relevance.keyword_rules_frame(spark, {
        "q": {"decisive": ["Trastuzumab"], "supportive": ["breast", "receptor", "cancer"]}})
    res = spark.createDataFrame([
        ("q", 1, "About breast care", ""),          # one supportive -> 0
        ("q", 2, "Breast", "receptor status"),      # two supportive -> 1
        ("q", 3, None, "uses trastuzumab"),         # decisive -> 2
        ("q", 4, "", "breastfeeding and receptors"),  # inside longer words -> 1
        ("other", 1, "breast receptor", "trastuzumab"),  # no rules -> 0
    ], "qid string, rank int, title string, content string")
    got = {(r.qid, r.rank): r.gain for r in relevance.keyword_gains(res, rules).collect()}
    assert got == {("q", 1): 0, ("q", 2): 1, ("q", 3): 2, ("q", 4): 1, ("other", 1): 0}


# Summary metrics from the reference's saved comparison report
# (dense baseline vs fused), used as golden inputs for the improvement operator.
REPORT_BASELINE = {"recall": {5: 0.29831878905408316, 10: 0.5081289054083171, 20: 1.0},
                   "ndcg": {5: 0.6117969148001009, 10: 0.6089162644594733, 20: 0.7952601763504482},
                   "mrr": {5: 0.8333333333333334, 10: 0.8333333333333334, 20: 0.8333333333333334},
                   "hit": {5: 1.0, 10: 1.0, 20: 1.0}}
REPORT_FUSED = {"recall": {5: 0.33965729274165807, 10: 0.5955237358101135, 20: 1.0},
                "ndcg": {5: 0.6931579876389198, 10: 0.7207284123867093, 20: 0.821292455233548},
                "mrr": {5: 0.8033333333333333, 10: 0.8033333333333333, 20: 0.8033333333333333},
                "hit": {5: 1.0, 10: 1.0, 20: 1.0}}


def test_improvement_reproduces_published_gains(spark):
    rows = [(meth, m, k, v) for meth, rep in (("dense", REPORT_BASELINE), ("rrf", REPORT_FUSED))
            for m, per_k in rep.items() for k, v in per_k.items()]
    summary = spark.createDataFrame(rows, "method string, metric string, k int, value double")
    imp = {(r.metric, r.k): r.pct for r in report.improvement(summary, "dense", "rrf").collect()}
    assert round(imp[("recall", 5)], 1) == 13.9
    assert round(imp[("recall", 10)], 1) == 17.2
    assert round(imp[("ndcg", 5)], 1) == 13.3
    assert round(imp[("ndcg", 10)], 1) == 18.4
    table = {(r.metric, r.method): r for r in report.metric_table(summary).collect()}
    assert table[("mrr", "rrf")].at_5 == pytest.approx(0.8033333333333333)


def test_improvement_zero_base(spark):
    s = spark.createDataFrame([("a", "hit", 5, 0.0), ("b", "hit", 5, 0.5),
                               ("a", "recall", 5, None), ("b", "recall", 5, 0.5)],
                              "method string, metric string, k int, value double")
    rows = report.improvement(s, "a", "b").collect()
    assert len(rows) == 1 and rows[0].pct == 0.0 and rows[0].delta == 0.5


def test_report_frame_shape(spark):
    s = spark.createDataFrame([("dense", "hit", 5, 1.0), ("rrf", "hit", 5, 1.0)],
                              "method string, metric string, k int, value double")
    lat = spark.createDataFrame([("rrf", 12.5)], "method string, avg_latency_ms double")
    r = report.report_frame(s, lat, {"baseline": ("dense", "Dense"), "rrf2": ("rrf", "Fused")}, k_values=(5,)).first()
    assert r.baseline.summary["hit"]["5"] == 1.0 and r.baseline.avg_latency_ms is None
    assert r.rrf2.name == "Fused" and r.rrf2.avg_latency_ms == 12.5


def test_reference_rule_table_counts_and_evaluate(spark):
    from quarry.operators.evaluate import evaluate
    from quarry.sources.keyword_rules import REFERENCE_KEYWORDS, reference_rules
    assert sum(len(v["decisive"]) for v in REFERENCE_KEYWORDS.values()) == 72
    assert sum(len(v["supportive"]) for v in REFERENCE_KEYWORDS.values()) == 56
    res = spark.createDataFrame([
        ("q2", "rrf", 1, "d1", "HER2 status", "amplified"),
        ("q2", "rrf", 2, "d2", "Unrelated", "nothing here"),
        ("q2", "rrf", 3, "d3", "Breast cancer", "receptor response"),
    ], "qid string, method string, rank int, id string, title string, content string")
    ev = evaluate(res, rules=reference_rules(spark), k_values=(5,))
    gl = ev.gains_list.first()
    assert gl.gains == [2, 0, 1]
    s = {(r.metric, r.k): r.value for r in ev.summary.collect()}
    assert s[("mrr", 5)] == 1.0 and s[("recall", 5)] == 1.0
    with pytest.raises(ValueError):
        evaluate(res, k_values=(5,))


def test_known_item_gold_exact(spark):
    from quarry.operators.bm25 import build_index
    docs = spark.createDataFrame([
        (1, "alpha beta gamma delta"), (2, "xalpha beta gamma deltax"), (3, "beta gamma"),
        (4, "Alpha beta gamma"), (5, "zzz ab"), (6, None)], "doc_id long, contents string")
    items = spark.createDataFrame([(10, "alpha beta gamma"), (11, "a beta gam"), (12, "ab"),
                                   (13, "beta")], "qid long, question string")
    expect = {(q, d) for d, t in docs.collect() for q, text in items.collect() if t and text in t}
    assert (11, 4) in expect and (12, 5) in expect  # partial tokens at both ends
    plain = {(r.qid, r.doc_id) for r in relevance.known_item_gold(docs, items).collect()}
    idx = build_index(docs)
    reuse = {(r.qid, r.doc_id) for r in relevance.known_item_gold(
        docs, items, postings=idx.postings, doc_freq=idx.term_stats).collect()}
    assert plain == reuse == expect


def test_queries_without_results_count_in_every_average(spark):
    from quarry.operators import evaluate, retrieve
    results = spark.createDataFrame([("q1", "bm25", 1, 1.0, "7", "t", "kw")],
                                    "qid string, method string, rank int, score double, id string, title string, content string")
    queries = spark.createDataFrame([("q1", "a"), ("q2", "b")], "qid string, question string")
    run = retrieve.build_run(results, queries)
    assert run.count() == 2 and {r.qid: r.num_results for r in run.collect()} == {"q1": 1, "q2": 0}
    rules = spark.createDataFrame([("q1", "decisive", "kw")], "qid string, tier string, keyword string")
    ev = evaluate.evaluate(retrieve.flatten_run(run), rules=rules, k_values=(5,))
    s = {r.metric: (r.value, r.n_queries) for r in ev.summary.collect()}
    assert s["hit"] == (0.5, 2) and s["mrr"] == (0.5, 2) and s["recall"] == (1.0, 2)


def test_run_keeps_every_method_and_query(spark):
    from quarry.operators import retrieve
    columns = "qid string, method string, rank int, score double, id string, title string, content string"
    results = spark.createDataFrame([("q1", "bm25", 1, 1.0, "7", "t", "c"), ("q1", "rrf", 1, 2.0, "8", "t", "c"),
                                     ("q2", "rrf", 1, 2.0, "9", "t", "c")], columns)
    queries = spark.createDataFrame([("q1", "a"), ("q2", "b"), ("q3", "c")], "qid string, question string")
    run = {(r.qid, r.method): [x.id for x in r.top_results] for r in retrieve.build_run(results, queries).collect()}
    assert run == {("q1", "bm25"): ["7"], ("q1", "rrf"): ["8"], ("q2", "bm25"): [], ("q2", "rrf"): ["9"],
                   ("q3", "bm25"): [], ("q3", "rrf"): []}
    none = retrieve.build_run(results.where("false"), queries).collect()
    assert sorted((r.qid, r.method, r.num_results) for r in none) == [("q1", None, 0), ("q2", None, 0), ("q3", None, 0)]


def test_registered_averages_count_queries_without_results(spark, tmp_path):
    from pyspark.sql import functions as F
    from sf_paths import SF_SMALL
    from quarry.plans import catalog
    v = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").limit(30)
    first = v.agg(F.min("vec_id")).first()[0]
    v.withColumn("embedding", F.when(F.col("vec_id") != first, F.col("embedding"))).unionByName(v.where(F.col("vec_id") == first)
        .withColumn("vec_id", F.lit(-5).cast("long"))).write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = catalog.QUERIES["label_dense_metrics"](spark, str(tmp_path)).collect()
    assert {r.n_queries for r in rows} == {31}
    empty = catalog.QUERIES["summary_with_empty"](spark, SF_SMALL).collect()
    n = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").count()
    assert {r.n_queries for r in empty} == {n + 1} and {r.n_values for r in empty if r.metric in ("hit", "mrr")} == {n + 1}


def test_fractional_gold_is_kept(spark):
    from quarry.operators import relevance
    results = spark.createDataFrame([("q", "a", 1), ("q", "b", 2)], "qid string, id string, rank int")
    gold = spark.createDataFrame([("q", "a", 0.5)], "qid string, id string, relevance_score double")
    got = {r.id: r.gain for r in relevance.gold_gains(results, gold).collect()}
    assert got == {"a": 0.5, "b": 0.0}
