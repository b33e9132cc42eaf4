"""Driver contract: entry() runs, every query has a name-matched SQL oracle, and every query
equals its oracle on the smallest tables, in the same order where the report is ordered."""

import os
import re
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tallyspark.plans.registry import QUERIES
from tools.oracle_check import TABLES, norm, rows_of

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["customer_id", "customer_name", "segment", "region"]


def test_registry_covers_oracles():
    from tallyspark.plans.registry import QUERIES
    q, o = QUERIES, {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
    assert set(q) <= set(E.queries())
    assert set(o) <= set(q)
    assert set(q) == set(o)
    assert len(q) >= 127


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)
    if key in QUERIES and re.search(r"ORDER BY [^()]*$", E.oracle_sql()[key].strip()):
        at = [dcols.index(c) for c in sdf.columns]   # the report ends in ORDER BY: same sequence
        assert [tuple(map(norm, r)) for r in srows] == [tuple(norm(r[i]) for i in at) for r in drows]


def test_planted_cases_occur(spark):
    """Rows that the checks and outer joins are for: without them a match would prove nothing."""
    q = {k: f(spark, "/root/testdata/sf0.01") for k, f in E.queries().items()
         if k in ("orphan_items", "orders_without_items", "dq_domain", "join_left", "join_full_audit", "dense_top3")}
    assert q["orphan_items"].count() and q["orders_without_items"].count() and q["dq_domain"].count()
    assert q["join_left"].filter("o_orderkey IS NULL").count()
    assert {r["audit"] for r in q["join_full_audit"].select("audit").distinct().collect()} == {
        "matched", "order_without_lines", "lines_without_order"}
    assert q["dense_top3"].groupBy("sales_rank").count().filter("count > 1").count()


def test_queries_can_be_listed_without_a_session():
    run = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", run], capture_output=True, text=True,
                         cwd=os.path.dirname(os.path.abspath(E.__file__)))
    assert out.returncode == 0, out.stderr
