"""Hand-computed graphs."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from edgeloom.operators import drift, edges as ed, graph, risks
from edgeloom.schema import EdgeError, NodeLimitError

from .conftest import rows


def values(df, key, value):
    return {r[key]: round(r[value], 6) for r in df.collect()}


def test_chain(edges):
    e = edges("a>b b>c c>d d>e")
    assert values(graph.depth(e), "node", "depth") == {"a": 0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1}
    assert set(values(graph.independence(graph.layers(e)[0]), "node", "independence").values()) == {0}
    assert set(values(graph.path_share(e), "node", "share").values()) == {1}
    assert values(graph.fanout(e), "node", "fanout") == {"a": 1, "b": 0.5, "c": 0.5, "d": 0.5, "e": 0}


def test_diamond(edges):
    e = edges("A>B A>C B>D C>D")
    assert values(graph.layers(e)[0], "node", "layer") == {"A": 0, "B": 1, "C": 1, "D": 2}
    assert values(graph.independence(graph.layers(e)[0]), "node", "independence") == {"A": 0, "B": 0.5, "C": 0.5, "D": 0}
    assert values(graph.path_share(e), "node", "share") == {"A": 1, "B": 0.5, "C": 0.5, "D": 1}
    assert set(values(graph.throughput(e), "node", "throughput").values()) == {0.5}


def test_star_and_islands(edges):
    e = edges("h>1 h>2 h>3 h>4")
    assert values(graph.throughput(e), "node", "throughput") == {"h": 1, "1": 0.25, "2": 0.25, "3": 0.25, "4": 0.25}
    assert values(graph.path_share(e), "node", "share")["1"] == 0.25
    two = edges("a>b c>d")
    assert values(graph.path_share(two), "node", "share") == dict.fromkeys("abcd", 0.5)
    assert len({r["component"] for r in graph.weak_components(two).collect()}) == 2


def test_cycles(edges):
    left, gone = graph.break_cycles(edges("a>b b>c c>a"))
    assert rows(left.select("src", "dst")) == [("a", "b"), ("b", "c")] and rows(gone) == [("c", "a")]
    free, stuck = graph.layers(edges("a>b b>c c>b"))
    assert rows(free.select("node")) == [("a",)] and rows(stuck) == [("b",), ("c",)]
    with pytest.raises(ValueError):
        graph.path_share(edges("a>b b>a"))
    left, gone = graph.break_cycles(edges("a>a a>b a>b b>c"))
    assert rows(left.select("src", "dst")) == [("a", "b"), ("b", "c")] and rows(gone) == []


def test_reach_of_a_cycle(edges):
    assert rows(graph.reach(edges("a>b b>a b>c"))) == [(x, y) for x in "ab" for y in "abc"]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=2, max_size=14))
def test_any_graph_becomes_acyclic(spark, pairs):
    e = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in pairs], "src string, dst string")
    left, gone = graph.break_cycles(e)
    assert graph.layers(left)[1].isEmpty()
    assert rows(graph.break_cycles(e, small=0)[1]) == rows(gone)
    assert set(rows(left.select("src", "dst"))) | set(rows(gone)) == {(f"n{a}", f"n{b}") for a, b in pairs if a != b}


def test_prune(edges):
    kept = graph.prune(edges("a>b b>c c>d d>e e>f"), 3)
    assert len({n for r in kept.collect() for n in r}) <= 3
    assert graph.prune(edges("a>b"), 5).count() == 1 and graph.prune(edges("a>b b>c"), 0).count() == 2


def test_shapes(spark):
    e = spark.createDataFrame([(["a", "b"],), (["b", "c", "9"],)], "edge array<string>")
    assert rows(ed.normalize(e).select("src", "dst")) == [("a", "b"), ("b", "c")]
    m = spark.createDataFrame([({"source": "a", "target": "b"},), ({"from": "x", "to": "y"},)], "edge map<string,string>")
    assert rows(ed.normalize(m).select("src", "dst")) == [("a", "b"), ("x", "y")]
    wide = spark.createDataFrame([(1, "b"), (2, "")], "source long, target string")
    assert rows(ed.normalize(wide, strict=False).select("src", "dst")) == [("1", "b")]
    with pytest.raises(Exception, match="missing or blank"):
        ed.normalize(wide).collect()
    with pytest.raises(EdgeError):
        ed.normalize(spark.createDataFrame([(1,)], "x long"))


def test_validate(edges):
    with pytest.raises(EdgeError):
        ed.validate(edges("a>b"))
    with pytest.raises(NodeLimitError):
        ed.validate(edges("a>b b>c"), max_nodes=2)
    assert ed.validate(edges("a>b a>b")).count() == 2


def test_dedupe(spark):
    e = spark.createDataFrame([("AuthService", "UserDB", 0), ("auth-service", "user_db", 1), ("Auth Service", "auth_service", 2), (None, "x", 3)], "src string, dst string, ord long")
    assert rows(ed.dedupe(e)) == [("auth_service", "user_d_b", 0), ("auth_service", "user_db", 1)] or rows(ed.dedupe(e)) == [("auth_service", "user_db", 0)]
    assert rows(ed.dedupe(e, "kebab", {"user-db": "db"}).select("src", "dst")) == [("auth-service", "db")]
    assert ed.dedupe(e, "none", self_loops=True).count() == 3
    with pytest.raises(ValueError):
        ed.dedupe(e, "upper")
    aliases = spark.createDataFrame([("user_db", "store")], "name string, alias string")
    assert ("auth_service", "store") in rows(ed.dedupe(e, "snake", aliases).select("src", "dst"))


def test_fingerprint_ignores_order(edges):
    assert ed.fingerprint(edges("a>b b>c")) == ed.fingerprint(edges("b>c a>b a>b")) != ed.fingerprint(edges("a>b"))


def test_drift(spark):
    v = lambda *r: spark.createDataFrame(list(r), "node string, criticality double, throughput double, fanout double")
    b, a = v(("x", 0.5, 0.1, 0.2), ("gone", 0.3, 0.1, 0.0)), v(("x", 0.7, 0.1, 0.2), ("new", 0.1, 0.0, 0.0))
    dims = ("criticality", "throughput", "fanout")
    assert drift.drift(b, b, dims).isEmpty()
    there = {(r["node"], r["dim"]): r["delta"] for r in drift.drift(b, a, dims).collect()}
    back = {(r["node"], r["dim"]): -r["delta"] for r in drift.drift(a, b, dims).collect()}
    assert there == back and there["x", "criticality"] == 0.2 and ("x", "fanout") not in there
    assert rows(drift.summary(b, a, dims)) == [(1, 1, 1)]
    assert drift.drift_maps(drift.drift(b, a, dims)).where("node = 'x'").first()["changes"] == {"criticality": 0.2}
    assert drift.drift_maps(drift.drift(b, a, dims), detail=True).where("node = 'x'").first()["changes"]["criticality"]["after"] == 0.7


def test_reports(spark):
    r = spark.createDataFrame([("a", "SINGLE_POINT_OF_FAILURE", "critical", "only one", 0.9), ("b", "CONVERGENCE_SINK", "odd", "sink", 0.1)], "node string, category string, severity string, description string, value double")
    text = risks.report(r)
    assert "SINGLE POINT OF FAILURE (1)" in text and "1 critical, 0 warning, 1 info" in text
    assert risks.report(r.limit(0)) == "No structural risks found."
    assert risks.has_critical(r) and "### Info (1)" in risks.markdown(r)
    assert rows(risks.by_category(r, "single-point of")) == rows(r.where("node = 'a'"))
    assert risks.actions(r).count() == 2 and risks.of_node(r, "b").count() == 1
    v = spark.createDataFrame([("a" * 40, 0.9, 0.5, 0.25), ("b", 0.1, 0.2, 0.7)], "node string, criticality double, throughput double, fanout double")
    assert risks.ranked(v).first()["node"] == "a" * 32 + "..."
    assert "█████" in risks.cards(v).where("node = 'b'").first()["card"]
    info = spark.range(1).select(F.lit(2).alias("nodes"))
    assert '"graph_info":{"nodes":2}' in risks.result_document(v, r, info).first()["json"]
    assert "Nodes by criticality" in risks.context(v, r) and risks.headline(2, 1, 1, r).startswith("2 nodes")
    assert graph.prunability(v.withColumn("independence", F.lit(0.5))).first()["node"] == "b"


def test_stream(spark, tmp_path):
    from edgeloom.streaming import windowed_edges

    spans = spark.sql("SELECT * FROM VALUES ('t','1',null,'web',timestamp'2024-01-01 00:00:00'),('t','2','1','auth',timestamp'2024-01-01 00:00:05'),('t','2','1','auth',timestamp'2024-01-01 00:00:05'),('t','3','2','auth',timestamp'2024-01-01 00:00:06'),('u','9',null,'web',timestamp'2024-01-02 00:00:00') AS s(trace_id, span_id, parent_id, service, ts)")
    spans.write.parquet(str(tmp_path / "in"))
    s = windowed_edges(spark.readStream.schema(spans.schema).parquet(str(tmp_path / "in")))
    q = s.writeStream.outputMode("append").format("memory").queryName("edges_out").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r["src"], r["dst"], r["n"]) for r in spark.table("edges_out").collect()] in ([("web", "auth", 1)], [])
    assert rows(windowed_edges(spans.distinct()).select("src", "dst", "n")) == [("web", "auth", 1)]
