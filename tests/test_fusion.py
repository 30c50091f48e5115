import pytest

from quarry.operators.fusion import rrf
from quarry.operators.retrieve import canonical_method


def ranking(spark, rows):
    return spark.createDataFrame(rows, "qid string, doc_id string, rank int")


def test_rrf_tie_keeps_first_list_order(spark):
    a = ranking(spark, [("q", "a", 1), ("q", "b", 2)])
    b = ranking(spark, [("q", "b", 1), ("q", "a", 2)])
    out = rrf([a, b], k=20).orderBy("rank").collect()
    assert [r.doc_id for r in out] == ["a", "b"]
    assert out[0].score == out[1].score == pytest.approx(1 / 61 + 1 / 62)


def test_rrf_single_list_member_and_three_lists(spark):
    a = ranking(spark, [("q", "x", 1), ("q", "y", 2)])
    b = ranking(spark, [("q", "y", 1)])
    c = ranking(spark, [("q", "z", 1), ("q", "x", 3)])
    out = {r.doc_id: r for r in rrf([a, b, c], k=20).collect()}
    assert out["z"].score == pytest.approx(1 / 61)
    assert out["y"].score == pytest.approx(1 / 62 + 1 / 61)
    assert out["x"].score == pytest.approx(1 / 61 + 1 / 63)
    assert [d for d, _ in sorted(out.items(), key=lambda kv: kv[1].rank)] == ["y", "x", "z"]


def test_rrf_ignores_scores_and_truncates(spark):
    a = spark.createDataFrame([("q", str(i), i, 1000.0 / i) for i in range(1, 30)],
                              "qid string, doc_id string, rank int, score double")
    out = rrf([a], k=5).collect()
    assert len(out) == 5 and sorted(r.rank for r in out) == [1, 2, 3, 4, 5]


def test_unknown_method():
    with pytest.raises(ValueError):
        canonical_method("nope")
    assert canonical_method("rrf2") == "rrf" and canonical_method("medcpt") == "dense"
