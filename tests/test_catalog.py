"""Every registered query against its DuckDB SQL at sf0.001 (values rounded)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from sf_paths import SF_SMALL

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in r))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_sql_or_is_rows_only():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    own = {q for q in qs if q != "pipeline" and not q.startswith("op")}
    assert own <= set(sql)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and {"qid", "rank", "score", "id"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    assert _norm(got) == _norm(exp)
