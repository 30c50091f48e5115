"""Physical-plan properties the design relies on (checked with explain output)."""

import pytest

from sf_paths import SF_SMALL
from quarry.operators import bm25, dense
from quarry.plans import catalog
from quarry.plans.workspace import Workspace


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace(spark, SF_SMALL)


def test_bm25_scoring_is_document_partitioned(ws):
    ranking = bm25.top_k_lexical(ws.index(), ws.queries(), k=20)
    p = plan(ranking)
    assert "Bucketed: true" in p
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "WindowGroupLimit" in p and "Partial" in p
    # the only exchanges: query-term grouping (broadcast side) and the top-k shuffle
    postings_side = p.split("BroadcastExchange")[0]
    assert postings_side.count("Exchange hashpartitioning") == 1


def test_postings_need_no_shuffle(ws):
    p = plan(ws.index().postings.groupBy("doc_id").count())
    assert "Exchange" not in p


def test_result_join_streams_corpus(ws):
    p = plan(ws.results("bm25"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "contents" not in p.split("ReadSchema:")[-1]  # column pruning at the scan


def test_dense_topk_two_level(ws):
    r = dense.topk(ws.doc_vectors(), ws.query_vectors(), k=5)
    p = plan(r)
    assert "FlatMapCoGroupsInArrow" in p and "WindowGroupLimit" in p
    assert "Broadcast" not in p  # neither side passes through the driver


def test_label_metrics_are_made_once(spark):
    """The search's candidates were ranked, joined and judged once for the averages and once for the number of queries."""
    p = plan(catalog.QUERIES["label_dense_metrics"](spark, SF_SMALL))
    assert "FlatMapCoGroupsInArrow" not in p and "WindowGroupLimit" not in p
