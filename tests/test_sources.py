"""Each format on small files of its shape."""

import json

import pytest

from edgeloom import explain
from edgeloom.sources import (
    files, from_autogen, from_aws_cdk, from_cloudformation, from_crewai, from_directory, from_docker_compose, from_github_actions, from_kubernetes,
    from_langgraph, from_otel_traces, from_package_json, from_package_json_workspaces, from_pulumi, from_python_imports, from_terraform, graph_documents,
)
from edgeloom.sources.text import arrow_edges, parse

from .conftest import rows


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text if isinstance(text, str) else json.dumps(text))
        return str(p)

    return write


COMPOSE = "services:\n  web:\n    depends_on: [api, auth]\n  api:\n    depends_on:\n      db: {condition: up}\n    links: ['cache:c', 'api:me']\n  auth:\n    depends_on: db\n"


def test_compose(spark, put):
    want = [("api", "cache"), ("api", "db"), ("auth", "db"), ("web", "api"), ("web", "auth")]
    assert rows(from_docker_compose(spark, put("docker-compose.yml", COMPOSE))) == want
    with pytest.raises(Exception, match="no services"):
        from_docker_compose(spark, put("other.yml", "a: 1")).collect()


K8S = """kind: Service
metadata: {name: web}
spec: {selector: {app: web, tier: front}}
---
kind: Service
metadata: {name: db}
spec: {}
---
kind: Deployment
metadata: {name: web-dep}
spec: {template: {metadata: {labels: {app: web, tier: front, x: y}}, spec: {containers: [{env: [{name: H, value: 'http://db:5432'}, {name: N, value: 5}]}]}}}
---
kind: StatefulSet
metadata: {name: part}
spec: {template: {metadata: {labels: {app: web}}}}
---
kind: Ingress
metadata: {name: edge}
spec: {rules: [{http: {paths: [{backend: {service: {name: web}}}, {backend: {serviceName: old}}]}}]}
"""


def test_kubernetes(spark, put, tmp_path):
    put("k8s/all.yaml", K8S), put("k8s/bad.yaml", "a: [")
    want = [("edge", "old"), ("edge", "web"), ("web", "web-dep"), ("web-dep", "db")]
    assert rows(from_kubernetes(spark, str(tmp_path / "k8s"))) == want


def test_github_actions(spark, put):
    p = put("ci.yml", "jobs:\n  build: {}\n  test: {needs: build}\n  ship: {needs: [build, test]}\n")
    assert rows(from_github_actions(spark, p)) == [("ci", "ci/build"), ("ci/build", "ci/ship"), ("ci/build", "ci/test"), ("ci/test", "ci/ship")]


def test_terraform(spark, put, tmp_path):
    put("tf/a.tf", 'resource "aws_vpc" "main" {}\nresource "aws_subnet" "s" {\n vpc = aws_vpc.main.id\n x = aws_none.y.id\n self = aws_subnet.s.id\n}\n')
    put("tf/sub/b.tf", 'resource "aws_instance" "i" {\n subnet = aws_subnet.s.id }')
    assert rows(from_terraform(spark, str(tmp_path / "tf"))) == [("i", "s"), ("s", "main")]


def test_python_imports(spark, put, tmp_path):
    put("py/services/__init__.py", ""), put("py/services/payments/gateway.py", "x = 1\n")
    put("py/services/auth/user.py", "import os\nfrom services.payments.gateway import pay\n")
    put("py/services/auth/near.py", "from .user import a\nfrom app.services.payments import gateway\n")
    root = str(tmp_path / "py")
    assert ("user", "gateway") in rows(from_python_imports(spark, root))
    assert rows(from_python_imports(spark, root, 1)) == []
    assert rows(from_python_imports(spark, root, 2)) == [("services.auth", "services.payments")]
    assert ("near", "user") in rows(from_python_imports(spark, root))


def test_packages(spark, put, tmp_path):
    root = put("ws/package.json", {"name": "root", "dependencies": {"a": "1", "left-pad": "1"}, "devDependencies": {"b": "1"}})
    put("ws/a/package.json", {"name": "a", "peerDependencies": {"b": "*", "a": "*"}}), put("ws/b/package.json", {"name": "b"})
    put("ws/node_modules/left-pad/package.json", {"name": "left-pad"})
    assert rows(from_package_json(spark, root)) == [("root", "a"), ("root", "b"), ("root", "left-pad")]
    assert rows(from_package_json_workspaces(spark, str(tmp_path / "ws"))) == [("a", "b"), ("root", "a"), ("root", "b")]


CFN = """AWSTemplateFormatVersion: '2010-09-09'
Resources:
  Vpc: {Type: V}
  Bucket: {Type: B}
  Role: {Type: R}
  Subnet:
    Type: S
    Properties: {VpcId: !Ref Vpc}
  Fn:
    Type: F
    DependsOn: Bucket
    Properties:
      Role: !GetAtt Role.Arn
      Env: {X: !Sub '${Subnet.Id}-${AWS::Region}', Y: !GetAtt [Vpc, Id], Z: !Ref Nowhere}
"""


def test_cloudformation(spark, put, tmp_path):
    want = [("Fn", "Bucket"), ("Fn", "Role"), ("Fn", "Subnet"), ("Fn", "Vpc"), ("Subnet", "Vpc")]
    assert rows(from_cloudformation(spark, put("stack.yaml", CFN))) == want
    put("cfn/x.json", {"Resources": {"T": {"DependsOn": ["B"], "Properties": {}}, "B": {}}}), put("cfn/no.json", {"a": 1})
    assert rows(from_cloudformation(spark, str(tmp_path / "cfn"))) == [("T", "B")]


def test_constructs(spark, put):
    cdk = "role = iam.Role(self, 'R')\nvpc = ec2.Vpc(self, 'V')\nfn = lam.Function(self, 'F', role=role, vpc=vpc.ref, x=[role, other])\nn = helper(self)\n"
    assert rows(from_aws_cdk(spark, put("cdk.py", cdk))) == [("fn", "role"), ("fn", "vpc")]
    pul = "b = aws.Bucket('b')\nq = aws.Queue('q')\nn = aws.Note('n', bucket=b.id, queues=[q])\n"
    assert rows(from_pulumi(spark, put("p.py", pul))) == [("n", "b"), ("n", "q")]


def test_agents(spark, put):
    lang = "g.add_edge(START, 'plan')\ng.add_edge('plan', 'do')\ng.add_conditional_edges('do', route, {'a': 'check', 'b': END})\ng.add_conditional_edges('check', route)\ng.set_finish_point('check')\ng.set_entry_point('plan')\n"
    assert rows(from_langgraph(spark, put("l.py", lang))) == [("START", "plan"), ("check", "END"), ("do", "END"), ("do", "check"), ("plan", "do")]
    crew = "t1 = Task(agent=a)\nt2 = Task(agent=b, context=[t1])\nc = Crew(agents=[a, b], manager_agent=m)\n"
    assert rows(from_crewai(spark, put("c.py", crew))) == [("a", "t1"), ("b", "t2"), ("m", "a"), ("m", "b"), ("t1", "t2")]
    star = "gc = GroupChat(agents=[p, c, r])\nboss = GroupChatManager(groupchat=gc)\nuser.initiate_chat(boss)\n"
    assert rows(from_autogen(spark, put("s.py", star))) == [("boss", "c"), ("boss", "p"), ("boss", "r"), ("user", "boss")]
    assert rows(from_autogen(spark, put("r.py", "t = RoundRobinGroupChat([a, b, c])"))) == [("a", "b"), ("b", "c"), ("c", "a")]
    for kind in ("Swarm", "SelectorGroupChat", "GroupChat"):
        assert from_autogen(spark, put("x.py", f"t = {kind}([a, b, c])")).count() == 6
    with pytest.raises(Exception):
        from_langgraph(spark, put("bad.py", "def (:")).collect()


def otlp(key="scopeSpans"):
    one = lambda s, spans: {"resource": {"attributes": [{"key": "service.name", "value": {"stringValue": s}}]}, key: [{"spans": spans}]}
    return {"resourceSpans": [one("front", [{"spanId": "1", "parentSpanId": "0000"}]), one("auth", [{"spanId": "2", "parentSpanId": "1"}, {"spanId": "4", "parentSpanId": "2"}]), one("db", [{"spanId": "3", "parentSpanId": "2"}])]}


def test_traces(spark, put):
    want = [("auth", "db"), ("front", "auth")]
    assert rows(from_otel_traces(spark, put("o.json", otlp()))) == want
    assert rows(from_otel_traces(spark, put("o2.json", otlp("instrumentationLibrarySpans")))) == want
    ref = lambda s: [{"refType": "CHILD_OF", "spanID": s}]
    jaeger = {"data": [{"traceID": "t", "processes": {"p": {"serviceName": "front"}, "q": {"serviceName": "auth"}, "r": {"serviceName": "db"}}, "spans": [{"spanID": "1", "processID": "p"}, {"spanID": "2", "processID": "q", "references": ref("1")}, {"spanID": "3", "processID": "r", "references": ref("2")}]}]}
    assert rows(from_otel_traces(spark, put("j.json", jaeger))) == want
    zip_ = [{"traceId": "t", "id": "1", "localEndpoint": {"serviceName": "front"}}, {"traceId": "t", "id": "2", "parentId": "1", "localEndpoint": {"serviceName": "auth"}}, {"traceId": "t", "id": "3", "parentId": "2", "localEndpoint": {"serviceName": "db"}}]
    assert rows(from_otel_traces(spark, put("z.json", zip_))) == want
    with pytest.raises(Exception, match="no known trace format"):
        from_otel_traces(spark, put("n.json", {"a": 1})).collect()


def test_directory(spark, put, tmp_path):
    put("d/compose.yml", COMPOSE), put("d/manifests/k.yaml", K8S), put("d/traces/t.json", otlp()), put("d/stack.yaml", CFN)
    put("d/flow.py", "from langgraph.graph import StateGraph\ng.add_edge('a', 'b')\n"), put("d/bad.py", "import crewai\ndef (:")
    put("d/venv/x.py", "import langgraph\ng.add_edge('no', 'no2')\n")
    edges, counts = from_directory(spark, str(tmp_path / "d"))
    got = {r["source"]: r["n_edges"] for r in counts.collect()}
    assert got == {"docker-compose": 5, "kubernetes": 4, "otel-traces": 2, "cloudformation": 5, "langgraph": 1}
    assert ("a", "b") in rows(edges) and edges.count() == edges.distinct().count()


def test_text():
    assert parse("a -> b\nnoise\nc → d;\n") == ([("a", "b"), ("c", "d")], 1)
    assert parse("﻿{“edges”: [[“a”, “b”], {“from”: “x”, “to”: “y”}]}")[0] == [("a", "b"), ("x", "y")]
    assert parse("source,target\na,b\n# no\nc,d")[0] == [("a", "b"), ("c", "d")]
    assert parse("a|b")[0] == [("a", "b")] and parse("a\tb")[0] == [("a", "b")]
    for bad in ("", "a", '{"edges": 5}', '[["a"]]'):
        with pytest.raises(ValueError):
            parse(bad)


def test_documents(spark, put, tmp_path):
    put("g/a.json", {"name": "n", "edges": [["a", "b"]]}), put("g/b.json", [["c", "d"]])
    assert rows(graph_documents(spark, str(tmp_path / "g")).select("src", "dst")) == [("a", "b"), ("c", "d")]
    lines = spark.createDataFrame([("a -> b,",), ("none",)], "value string")
    assert rows(arrow_edges(lines)) == [("a", "b")]


def test_narration(spark, put, tmp_path):
    assert explain.provider_of("ollama/x") == ("local", "x") and explain.provider_of("gpt")[0] == "openai"
    assert explain.parse_edges('```json\n{"edges": [["a", "b"], ["c"]]}\n```') == [("a", "b")] and explain.parse_edges("no") == []
    put("q/README.md", "x" * 70_000), put("q/notes.md", "hello")
    shown = rows(explain.gather(spark, str(tmp_path / "q")).selectExpr("path", "length(content) n", "running"))
    assert shown == [("README.md", 60_000, 60_000), ("notes.md", 5, 60_005)]
    edges, _, log = explain.find_edges(spark, str(tmp_path / "q"), "m", lambda *a: '{"edges": [["a", "b"], ["b", "c"], ["c", "d"]]}', max_nodes=3)
    assert log[0] == "model: 3 edges" and "pruned" in log[1] and edges.count() >= 1
    v = spark.createDataFrame([("a", 0.5)], "node string, criticality double")
    r = spark.createDataFrame([], "node string, category string, severity string, description string, value double")
    answer, history = explain.ask(v, r, "why?", "m", lambda p, m, msgs: msgs[-1]["content"].upper())
    assert answer == "WHY?" and len(history) == 2 and explain.explain(v, r, "m", lambda p, m, x: x[0]["content"]).startswith("Explain")


def test_files_are_relative(spark, put, tmp_path):
    put("f/x/y.txt", "hi")
    assert rows(files(spark, str(tmp_path / "f"))) == [("x/y.txt", "hi")]
