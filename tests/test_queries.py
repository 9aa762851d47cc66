"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from edgeloom.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def values(frame):
    out = []
    for r in frame[sorted(frame.columns)].itertuples(index=False):
        out.append(tuple("NULL" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{v:.5f}" if isinstance(v, float) else str(v) for v in r))
    return sorted(out)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    return con


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert values(got) == values(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_prune_keeps_the_budget(spark):
    out = QUERIES["bfs_prune"](spark, DATA)
    assert len({n for r in out.collect() for n in r}) <= 40


def test_whole_graph_holds_the_parts(spark, duck):
    n = duck.sql("SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)").fetchall()[0][0]
    for name in ("edges_union_sources_dag", "whatif_edges_dag"):
        assert QUERIES[name](spark, DATA).where("dst LIKE 'P:%'").count() == n
    reach = {r["node"]: r["n_reach"] for r in QUERIES["reachability_counts_dag"](spark, DATA).collect()}
    assert any(k.startswith("S:") for k in reach)
    assert {r["source"]: r["n_edges"] for r in QUERIES["source_counts_dag"](spark, DATA).collect()}["dag"] > n
    cut = {r["node"]: r["n_reach"] for r in QUERIES["reachability_counts"](spark, DATA).collect()}
    assert all(reach[k] > v for k, v in cut.items())


def test_acyclic_edges_of_every_month(spark, duck):
    got = {(r["src"], r["dst"]) for r in QUERIES["acyclic_edges"](spark, DATA).collect()}
    every = "SELECT DISTINCT s.s_nationkey, c.c_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey JOIN supplier s ON l_suppkey = s_suppkey"
    whole = {frozenset(r) for r in duck.sql(every).fetchall() if r[0] != r[1]}
    month = {frozenset(r) for r in duck.sql(every + " WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-02-01'").fetchall() if r[0] != r[1]}
    left = set(got)
    while any(s not in {b for _, b in left} for s, _ in left):
        left = {(a, b) for a, b in left if a in {y for _, y in left}}
    assert not left and len(month) < len(got) <= len(whole)


def test_insights_of_measures(spark):
    got = {r["node"]: r["messages"] for r in QUERIES["insight_rules_dag"](spark, DATA).collect()}
    assert all("on many paths" in m for n, m in got.items() if n.startswith("R:")) and any(n.startswith("R:") for n in got)
    assert any(n.startswith("P:") for n, m in got.items() if "a deep end point" in m)
