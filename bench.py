"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  ``value`` is the summed wall time of the headline
queries (index build excluded and reported separately as ``index_build``,
as the reference also builds its index offline).  ``fused_ms_per_query`` is
the fused retrieval time divided by the number of queries, comparable to the
reference's per-query latency.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["bm25_topk", "dense_text_topk", "rrf2", "retrieve_rrf", "dense_topk",
            "known_item_gold", "metrics_summary", "conversation_bm25", "hash_encode"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from quarry.plans import catalog
    from quarry.plans.workspace import Workspace
    from quarry.session import build_session
    from quarry.sources import fixtures as fx

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": "16g"})
    ws = Workspace.of(spark, sf_dir)
    timings: dict[str, float] = {}

    t0 = time.time()
    ws.index()
    ws.doc_blocks(catalog.HASH_DIM)
    timings["index_build"] = round(time.time() - t0, 3)

    for name in HEADLINE:
        ws.forget_rankings()
        t0 = time.time()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t0, 3)

    n_queries = fx.benchmark_queries(spark, sf_dir).count()
    total = round(sum(v for k, v in timings.items() if k != "index_build"), 3)
    out = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "n_queries": n_queries,
        "fused_ms_per_query": round(1000 * timings["retrieve_rrf"] / max(n_queries, 1), 1),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
