"""Measures, rules, simulation, and loops that run out of rounds."""

import pytest
from pyspark.sql import functions as F

from edgeloom.operators import graph, measures


def pairs(spark, text):
    return spark.createDataFrame([tuple(x.split(">")) for x in text.split()], "src string, dst string")


def by_node(df):
    return {r["node"]: r for r in df.collect()}


def test_diamond(spark):
    m = measures.measures(pairs(spark, "A>B A>C B>D C>D A>A A>B"))
    v = by_node(m.vectors)
    assert [v[n]["layer"] for n in "ABCD"] == [0, 1, 1, 2] and [v[n]["independence"] for n in "ABCD"] == [0, 0.5, 0.5, 0]
    assert [v[n]["criticality"] for n in "ABCD"] == [1, 0.5, 0.5, 1] and m.info.first().asDict() == {"n_nodes": 4, "n_edges": 4, "max_depth": 2}
    assert m.node("A").first()["fanout"] == 1 and m.dimension("depth").columns == ["node", "depth"]


def test_rules_and_simulation(spark):
    rules = [measures.Rule("SINGLE_POINT_OF_FAILURE", "critical", "independence = 0 AND criticality > 0.9", "criticality")]
    c = measures.simulate(pairs(spark, "a>b a>c b>d c>d"), add=pairs(spark, "d>e"), remove=pairs(spark, "a>c"), rules=rules)
    assert {r["node"] for r in c.new_risks.collect()} == {"e"} and {r["node"] for r in c.gone_risks.collect()} == {"a"}  # c is at a's stage then
    assert {r["status"] for r in c.drift.where("node = 'e'").collect()} == {"added"}
    assert measures.apply_rules(c.after.vectors, []).count() == 0


def test_mean_reach_and_vectors(spark):
    r = by_node(measures.mean_reach(pairs(spark, "a>b b>c c>a c>d")))
    assert r["d"]["n_reached_by"] == 3 and r["d"]["mean_reach"] == 1 and r["a"]["n_reached_by"] == 2
    v = spark.range(1).select(measures.vector_of(F.create_map(F.lit("fanout"), F.lit(0.5), F.lit("other"), F.lit(2.0))).alias("v")).first()["v"]
    assert v == [0, 0, 0, 0, 0.5]


def test_change_card(spark):
    schema = "node string, depth double"
    card = measures.change_card(spark.createDataFrame([("a", 0.5)], schema), spark.createDataFrame([("a", 0.5004), ("b", 1.0)], schema), ("depth",))
    assert {r["node"]: r["card"] for r in card.collect()} == {"a": "depth: 0.500 to 0.500 (+0.000)", "b": "depth: 0.000 to 1.000 (+1.000)"}


def test_long_chain(spark):
    n = 12_000
    chain = spark.range(n).select(F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst"))
    own, stuck = graph.layers(chain)
    assert own.agg(F.max("layer")).first()[0] == n and stuck.isEmpty()


def test_rounds_agree_and_raise(spark):
    e = pairs(spark, "a>b b>c c>d a>d x>y y>x y>z q>q")
    small, large = graph.layers(e), graph.layers(e, small=0)
    for a, b in zip(small, large):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    with pytest.raises(graph.RoundsError):
        graph.layers(e, max_rounds=2, small=0)
    with pytest.raises(graph.RoundsError):
        graph.reach(e, max_rounds=1)
    with pytest.raises(graph.RoundsError):
        graph.break_cycles(e, max_rounds=1, small=0)
    by = by_node(graph.path_share(pairs(spark, "a>b b>c a>c")))
    assert [by[n]["share"] for n in "abc"] == [1, 0.5, 1]


def test_document_and_gate(spark, tmp_path, capsys):
    import json

    from edgeloom import cli

    rules = tmp_path / "rules.json"
    rules.write_text(json.dumps([{"category": "SINGLE_POINT_OF_FAILURE", "severity": "critical", "condition": "independence = 0", "value": "criticality"}]))
    assert cli.main(["--edges", "a -> b\nb -> c", "--rules", str(rules), "--gate"], spark) == 3
    found = json.loads(capsys.readouterr().out)
    assert found["metadata"] == {"n_nodes": 3, "n_edges": 2, "max_depth": 2} and len(found["risks"]) == 3 and found["vectors"]["c"]["depth"] == 1
    assert cli.main(["--edges", "a -> b", "--document"], spark) == 0 and json.loads(capsys.readouterr().out)["risks"] == []
    rules.write_text('[{"nothing": 1}]')
    assert cli.main(["--edges", "a -> b", "--rules", str(rules)], spark) == 1


def test_context_says_what_is_left_out(spark):
    from edgeloom.operators import risks

    v = spark.createDataFrame([(f"n{i:02}", float(i)) for i in range(60)], "node string, criticality double")
    r = spark.createDataFrame([(f"n{i:02}", "CONVERGENCE_SINK", "info", "", 0.5) for i in range(60)], "node string, category string, severity string, description string, value double")
    whole, some = risks.context(v, r), risks.context(v, r, 5)
    assert all(whole.count(f"n{i:02}") == 2 for i in range(60)) and "more)" not in whole
    assert some.count("(55 more)") == 2


def test_tools(spark, tmp_path):
    from edgeloom import tools

    (tmp_path / "compose.yml").write_text("services:\n  a:\n    depends_on: [b, c]\n  b: {}\n  c: {}\n")
    assert tools.TOOLS["scan_compose"](spark, str(tmp_path / "compose.yml"))["edges"] == [["a", "b"], ["a", "c"]]
    found = tools.scan_directory(spark, str(tmp_path), most=1)
    assert len(found["edges"]) == 1 and found["n_edges"] == 2 and found["sources"] == {"docker-compose": 2}
    rule = {"category": "AMPLIFICATION_RISK", "severity": "warning", "condition": "fanout = 1", "value": "fanout"}
    got = tools.measure(spark, [("a", "b"), ("b", "c")], [rule])
    assert got["metadata"]["max_depth"] == 2 and [x["node"] for x in got["risks"]] == ["a"]
    out = tools.simulate(spark, [("a", "b"), ("b", "c")], add=[("c", "d")])
    assert {x["node"] for x in out["drift"]} >= {"c", "d"} and tools.diff(spark, [("a", "b"), ("b", "c")], [("b", "c"), ("a", "b")])["n_changes"] == 0
    assert tools.pasted(spark, "a -> b").collect()[0]["dst"] == "b"
    assert {tuple(x) for x in tools.pasted(spark, 'g.add_edge("x", "y")', "langgraph").collect()} == {("x", "y")}
    with pytest.raises(ValueError, match="unknown format"):
        tools.pasted(spark, "", "nothing")
