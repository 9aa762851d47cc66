"""Queries that write files of each format from the tables, parse them with the library and
hold the edges against the tables: a parser that loses or invents an edge shows.

The graph is each nation's suppliers: svc_1 to svc_9 where both supply from one nation and
the second key is larger by less than `SPAN`; a nation is a file or a folder."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import folder
from ..sources import from_autogen, from_aws_cdk, from_cloudformation, from_crewai, from_directory, from_docker_compose, from_github_actions, from_kubernetes
from ..sources import from_langgraph, from_otel_traces, from_package_json_workspaces, from_pulumi, from_python_imports, from_terraform, graph_documents
from ..sources.files import chat_edges, dependency_edges, facts, import_edges, is_template, known_refs, kubernetes_edges, plain_edges, trace_edges, workspace_edges
from ..sources.text import text_edges
from .graphs import SPAN as EVENTS
from .graphs import spans, table

SPAN = 100
PAIRS = f"""p AS (SELECT a.s_nationkey AS f, 'svc_' || a.s_suppkey AS src, 'svc_' || b.s_suppkey AS dst, b.s_suppkey AS k
  FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey AND b.s_suppkey < a.s_suppkey + {SPAN}),
n AS (SELECT s_nationkey AS f, 'svc_' || s_suppkey AS node, s_suppkey AS k FROM supplier)"""
EDGES = f"WITH {PAIRS} SELECT DISTINCT src, dst FROM p"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    """(f, node, k, deps): each supplier with those that it points to, (node, k) in order."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("f"), F.col("s_suppkey").alias("k"))
    near = s.select("f", F.col("k").alias("a")).join(s.select("f", F.col("k").alias("b")), "f").where(f"a < b and b < a + {SPAN}")
    deps = near.groupBy("f", "a").agg(F.sort_array(F.collect_list("b")).alias("deps")).withColumnRenamed("a", "k")
    return s.join(deps, ["f", "k"], "left").select("f", "k", _svc(F.col("k")).alias("node"), F.coalesce("deps", F.array().cast("array<bigint>")).alias("deps"))


def _svc(k: Column) -> Column:
    return F.concat(F.lit("svc_"), k.cast("string"))


def _each(deps: Column, f, sep: str = "") -> Column:
    return F.array_join(F.transform(deps, f), sep)


def _files(nodes: DataFrame, body: Column, path: str, head: str | Column = "", tail: str | Column = "", sep: str = "\n") -> DataFrame:
    """(path, content): a file for each nation, its bodies in the order of keys; %s in path is the nation."""
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    own = nodes.select("f", "k", body.alias("body")).groupBy("f").agg(F.sort_array(F.collect_list(F.struct("k", "body"))).alias("all"))
    text = F.array_join(F.transform("all", lambda x: x["body"]), sep)
    return own.select(F.format_string(path, F.col("f")).alias("path"), F.concat(as_col(head), text, as_col(tail)).alias("content"))


@query(EDGES)
def parse_docker_compose(spark: SparkSession, d: str) -> DataFrame:
    """Dependencies as lists or maps (by nation), and every third one as a link with an alias."""
    name = lambda k: _svc(k)
    own = _nodes(spark, d)
    linked, needed = F.filter("deps", lambda k: k % 3 == 0), F.filter("deps", lambda k: k % 3 != 0)
    listed = _each(needed, lambda k: F.concat(F.lit("      - "), name(k), F.lit("\n")))
    mapped = _each(needed, lambda k: F.concat(F.lit("      "), name(k), F.lit(":\n        condition: service_started\n")))
    needs = F.when(F.size(needed) > 0, F.concat(F.lit("    depends_on:\n"), F.when(F.col("f") % 2 == 0, listed).otherwise(mapped))).otherwise("")
    links = F.when(F.size(linked) > 0, F.concat(F.lit("    links:\n"), _each(linked, lambda k: F.concat(F.lit("      - "), name(k), F.lit(":db\n"))))).otherwise("")
    body = F.concat(F.lit("  "), "node", F.lit(":\n    image: x\n"), needs, links)
    return plain_edges(facts(_files(own, body, "n%d/compose.yml", "services:\n", sep=""), "docker-compose"))


@query(f"""WITH {PAIRS} SELECT node AS src, 'dep_' || k AS dst FROM n
  UNION SELECT DISTINCT 'ing_' || f, node FROM n WHERE k % 2 = 0
  UNION SELECT DISTINCT 'dep_' || replace(p.src, 'svc_', ''), s.node FROM p JOIN n s ON contains('http://' || p.dst || ':80', s.node)""")
def parse_kubernetes(spark: SparkSession, d: str) -> DataFrame:
    """A service, a workload and addresses of others for each supplier; an ingress for each nation."""
    k = F.col("k").cast("string")
    env = _each(F.col("deps"), lambda x: F.concat(F.lit("        - name: U"), x.cast("string"), F.lit("\n          value: http://"), _svc(x), F.lit(":80\n")))
    service = F.concat(F.lit("kind: Service\nmetadata:\n  name: "), "node", F.lit("\nspec:\n  selector:\n    app: "), "node", F.lit("\n    tier: back\n---\n"))
    work = F.concat(
        F.lit("kind: Deployment\nmetadata:\n  name: dep_"), k, F.lit("\nspec:\n  template:\n    metadata:\n      labels:\n        app: "), "node", F.lit("\n        tier: back\n        extra: x\n    spec:\n      containers:\n      - name: c\n"),
        F.when(F.size("deps") > 0, F.concat(F.lit("        env:\n"), env)).otherwise(""), F.lit("---\n"),
    )
    old, new = F.concat(F.lit("          serviceName: "), "node", F.lit("\n")), F.concat(F.lit("          service:\n            name: "), "node", F.lit("\n"))
    way = F.concat(F.lit("kind: Ingress\nmetadata:\n  name: ing_"), F.col("f").cast("string"), F.lit("\nspec:\n  rules:\n  - http:\n      paths:\n      - path: /\n        backend:\n"), F.when(F.col("k") % 4 == 0, old).otherwise(new), F.lit("---\n"))
    body = F.concat(service, work, F.when(F.col("k") % 2 == 0, way).otherwise(""))
    return kubernetes_edges(facts(_files(_nodes(spark, d), body, "k8s/n%d.yaml", sep=""), "kubernetes"))


@query(f"""WITH {PAIRS} SELECT 'flow_' || f || '/' || src AS src, 'flow_' || f || '/' || dst AS dst FROM p
  UNION SELECT 'flow_' || f, 'flow_' || f || '/' || node FROM n WHERE node NOT IN (SELECT src FROM p)""")
def parse_github_actions(spark: SparkSession, d: str) -> DataFrame:
    """A job needs what its supplier is the first end of, turned round; every other flow is named by its file."""
    needs = F.when(F.size("deps") == 0, "").when(F.size("deps") == 1, F.concat(F.lit("    needs: "), _each(F.col("deps"), _svc), F.lit("\n"))).otherwise(F.concat(F.lit("    needs: ["), _each(F.col("deps"), _svc, ", "), F.lit("]\n")))
    body = F.concat(F.lit("  "), "node", F.lit(":\n    runs-on: x\n"), needs)
    head = F.concat(F.when(F.col("f") % 2 == 0, F.concat(F.lit("name: flow_"), F.col("f").cast("string"), F.lit("\n"))).otherwise(""), F.lit("jobs:\n"))
    found = plain_edges(facts(_files(_nodes(spark, d), body, "w/flow_%d.yml", head, sep=""), "github-actions"))
    # needs point from what is needed to the job
    turned = F.contains("src", F.lit("/"))
    return found.select(F.when(turned, F.col("dst")).otherwise(F.col("src")).alias("src"), F.when(turned, F.col("src")).otherwise(F.col("dst")).alias("dst"))


@query(EDGES)
def parse_terraform(spark: SparkSession, d: str) -> DataFrame:
    """Refs to resources of two types and to one that nobody declares."""
    kind = lambda k: F.when(k % 2 == 0, "aws_a").otherwise("aws_b")
    refs = _each(F.col("deps"), lambda k: F.concat(F.lit("  x = "), kind(k), F.lit("."), _svc(k), F.lit(".id\n")))
    body = F.concat(F.lit('resource "'), kind(F.col("k")), F.lit('" "'), "node", F.lit('" {\n  y = aws_c.nobody.id\n'), refs, F.lit("}\n"))
    return known_refs(facts(_files(_nodes(spark, d), body, "n%d.tf"), "terraform"), by_path=False, label=True)


def _modules(spark: SparkSession, d: str) -> DataFrame:
    of = lambda k: F.concat(F.lit("pkg"), F.col("f").cast("string"), F.lit("."), _svc(k))
    lines = _each(F.col("deps"), lambda k: F.when(k % 3 == 0, F.concat(F.lit("import "), of(k), F.lit(".part\n"))).when(k % 3 == 1, F.concat(F.lit("from ."), _svc(k), F.lit(" import x\n"))).otherwise(F.concat(F.lit("from "), of(k), F.lit(" import x\n"))))
    rows = _nodes(spark, d).select(F.format_string("pkg%d/%s.py", "f", "node").alias("path"), F.concat(F.lit("import os\n"), lines).alias("content"))
    return facts(rows, "python-imports")


@query(EDGES)
def parse_python_imports(spark: SparkSession, d: str) -> DataFrame:
    """Absolute, relative and too long imports of local modules beside foreign ones."""
    return import_edges(_modules(spark, d))


@query(f"WITH {PAIRS} SELECT DISTINCT 'pkg' || f || '.' || src AS src, 'pkg' || f || '.' || dst AS dst FROM p")
def parse_python_imports_depth(spark: SparkSession, d: str) -> DataFrame:
    """Module names rolled up to their first two parts."""
    return import_edges(_modules(spark, d), 2)


def _packages(spark: SparkSession, d: str) -> DataFrame:
    part = lambda r: F.map_from_entries(F.transform(F.filter("deps", lambda k: k % 3 == r), lambda k: F.struct(_svc(k), F.lit("1"))))
    doc = F.struct(F.col("node").alias("name"), F.map_concat(part(0), F.create_map(F.lit("left"), F.lit("1"))).alias("dependencies"), part(1).alias("devDependencies"), part(2).alias("peerDependencies"))
    rows = _nodes(spark, d).select(F.format_string("p%d/%s/package.json", "f", "node").alias("path"), F.to_json(doc).alias("content"))
    return facts(rows, "package-json")


@query(EDGES)
def parse_package_json_workspaces(spark: SparkSession, d: str) -> DataFrame:
    return workspace_edges(_packages(spark, d))


@query(f"WITH {PAIRS} SELECT DISTINCT src, dst FROM p UNION SELECT node, 'left' FROM n")
def parse_package_json(spark: SparkSession, d: str) -> DataFrame:
    return dependency_edges(_packages(spark, d))


def _template(spark: SparkSession, d: str, as_json: bool) -> DataFrame:
    own = _nodes(spark, d)
    if as_json:
        ref = lambda k: F.when(k % 4 == 0, F.concat(F.lit('{"Ref": "'), _svc(k), F.lit('"}'))).when(k % 4 == 1, F.concat(F.lit('{"Fn::GetAtt": ["'), _svc(k), F.lit('", "Arn"]}'))).otherwise(F.concat(F.lit('{"Fn::Sub": "a-${'), _svc(k), F.lit('.Arn}-b"}')))
        needs = F.concat(F.lit('["'), _each(F.filter("deps", lambda k: k % 4 == 3), _svc, '", "'), F.lit('"]'))
        needs = F.when(F.exists("deps", lambda k: k % 4 == 3), F.concat(F.lit(', "DependsOn": '), needs)).otherwise("")
        props = _each(F.filter("deps", lambda k: k % 4 != 3), ref, ", ")
        body = F.concat(F.lit('"'), "node", F.lit('": {"Type": "T"'), needs, F.lit(', "Properties": {"a": ['), props, F.lit("]}}"))
        return _files(own, body, "n%d.json", '{"Resources": {', "}}", sep=", ")
    ref = lambda k: F.when(k % 3 == 0, F.concat(F.lit("        - !Ref "), _svc(k), F.lit("\n"))).when(k % 3 == 1, F.concat(F.lit("        - !GetAtt "), _svc(k), F.lit(".Arn\n"))).otherwise(F.concat(F.lit("        - !Sub 'a-${"), _svc(k), F.lit("}-${Nobody}'\n")))
    body = F.concat(F.lit("  "), "node", F.lit(":\n    Type: T\n    Properties:\n      a:\n        - x\n"), _each(F.col("deps"), ref))
    return _files(own, body, "n%d.yaml", "Resources:\n", sep="")


@query(EDGES)
def parse_cloudformation_json(spark: SparkSession, d: str) -> DataFrame:
    rows = _template(spark, d, True).where(is_template(F.col("content")))
    return known_refs(facts(rows, "cloudformation"), by_path=True, label=False)


@query(EDGES)
def parse_cloudformation_yaml(spark: SparkSession, d: str) -> DataFrame:
    rows = _template(spark, d, False).where(is_template(F.col("content")))
    return known_refs(facts(rows, "cloudformation"), by_path=True, label=False)


def _constructs(spark: SparkSession, d: str, first: str, fmt: str) -> DataFrame:
    """Calls that take other variables as keyword values, attributes of them, or lists of both."""
    one = lambda k: F.when(k % 2 == 0, _svc(k)).otherwise(F.concat(_svc(k), F.lit(".arn")))
    body = F.concat("node", F.lit(" = lib.Thing("), F.lit(first), F.lit('"'), "node", F.lit('", other=nobody, some=['), _each(F.col("deps"), one, ", "), F.lit("])"))
    return plain_edges(facts(_files(_nodes(spark, d), body, "n%d.py", "import lib\n"), fmt))


@query(EDGES)
def parse_aws_cdk(spark: SparkSession, d: str) -> DataFrame:
    return _constructs(spark, d, "self, ", "aws-cdk")


@query(EDGES)
def parse_pulumi(spark: SparkSession, d: str) -> DataFrame:
    return _constructs(spark, d, "", "pulumi")


@query(f"""WITH {PAIRS} SELECT DISTINCT src, dst FROM p UNION SELECT 'START', node FROM n WHERE k % 5 = 0 UNION SELECT node, 'END' FROM n WHERE k % 7 = 0""")
def parse_langgraph(spark: SparkSession, d: str) -> DataFrame:
    """Plain edges for odd targets, a route map for even ones, entry and finish points."""
    quoted = lambda k: F.concat(F.lit('"'), _svc(k), F.lit('"'))
    plain = _each(F.filter("deps", lambda k: k % 2 == 1), lambda k: F.concat(F.lit('g.add_edge("'), F.col("node"), F.lit('", '), quoted(k), F.lit(")\n")))
    even = F.filter("deps", lambda k: k % 2 == 0)
    routes = F.when(F.size(even) > 0, F.concat(F.lit('g.add_conditional_edges("'), "node", F.lit('", pick, {'), _each(even, lambda k: F.concat(quoted(k), F.lit(": "), quoted(k)), ", "), F.lit("})\n"))).otherwise("")
    ends = F.concat(F.when(F.col("k") % 5 == 0, F.concat(F.lit('g.set_entry_point("'), "node", F.lit('")\n'))).otherwise(""), F.when(F.col("k") % 7 == 0, F.concat(F.lit('g.set_finish_point("'), "node", F.lit('")\n'))).otherwise(""))
    return plain_edges(facts(_files(_nodes(spark, d), F.concat(plain, routes, ends), "n%d.py", sep=""), "langgraph"))


@query(f"""WITH {PAIRS} SELECT DISTINCT dst AS src, src AS dst FROM p UNION SELECT 'agent_' || k, node FROM n
  UNION SELECT 'boss_' || f, 'agent_' || k FROM n""")
def parse_crewai(spark: SparkSession, d: str) -> DataFrame:
    """A task and an agent for each supplier, tasks with others as their context, a managed crew for each nation."""
    k = F.col("k").cast("string")
    body = F.concat("node", F.lit(" = Task(agent=agent_"), k, F.lit(", context=["), _each(F.col("deps"), _svc, ", "), F.lit("])\nc"), k, F.lit(" = Crew(agents=[agent_"), k, F.lit("], manager_agent=boss_"), F.col("f").cast("string"), F.lit(")\n"))
    return plain_edges(facts(_files(_nodes(spark, d), body, "n%d.py", sep=""), "crewai"))


@query(f"""WITH {PAIRS}, m AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY k) AS i, count(*) OVER (PARTITION BY f) AS c FROM n)
  SELECT 'boss' AS src, node AS dst FROM m WHERE f % 4 = 0
  UNION SELECT a.node, b.node FROM m a JOIN m b ON a.f = b.f AND b.i = a.i % a.c + 1 AND a.node <> b.node WHERE a.f % 4 = 1
  UNION SELECT a.node, b.node FROM m a JOIN m b ON a.f = b.f AND a.node <> b.node WHERE a.f % 4 >= 2
  UNION SELECT 'user', node FROM m WHERE i = 1""")
def parse_autogen(spark: SparkSession, d: str) -> DataFrame:
    """Chats by nation: managed (star), round robin (ring), swarm and unmanaged (everyone to everyone)."""
    f = F.col("f") % 4
    head = F.when(f == 1, "chat = RoundRobinGroupChat([").when(f == 2, "chat = Swarm(participants=[").otherwise("chat = GroupChat(agents=[")
    first = F.concat(F.lit("user.initiate_chat("), F.transform("all", lambda x: x["body"])[0], F.lit(")\n"))
    tail = F.concat(F.lit("])\n"), F.when(f == 0, "boss = GroupChatManager(groupchat=chat)\n").otherwise(""), first)
    return chat_edges(facts(_files(_nodes(spark, d), F.col("node"), "n%d.py", head, tail, sep=", "), "autogen"))


@query(f"WITH {EVENTS} SELECT DISTINCT src, dst FROM call")
def parse_traces(spark: SparkSession, d: str) -> DataFrame:
    """Spans of a user in one of three trace formats."""
    rows = spans(spark, d).withColumn("kind", F.pmod(F.xxhash64("trace_id"), F.lit(3)))
    otlp = F.struct(
        F.struct(F.array(F.struct(F.lit("service.name").alias("key"), F.struct(F.col("service").alias("stringValue")).alias("value"))).alias("attributes")).alias("resource"),
        F.array(F.struct(F.array(F.struct(F.col("span_id").alias("spanId"), F.coalesce("parent_id", F.lit("00000000")).alias("parentSpanId"))).alias("spans"))).alias("scopeSpans"),
    )
    jaeger = F.struct(F.col("span_id").alias("spanID"), F.col("service").alias("processID"), F.when(F.col("parent_id").isNotNull(), F.array(F.struct(F.lit("CHILD_OF").alias("refType"), F.col("parent_id").alias("spanID")))).alias("references"))
    zipkin = F.struct(F.col("trace_id").alias("traceId"), F.col("span_id").alias("id"), F.col("parent_id").alias("parentId"), F.struct(F.col("service").alias("serviceName")).alias("localEndpoint"))
    by = rows.groupBy("trace_id", "kind").agg(F.collect_list(otlp).alias("o"), F.collect_list(jaeger).alias("j"), F.collect_list(zipkin).alias("z"), F.collect_set("service").alias("names"))
    processes = F.map_from_entries(F.transform("names", lambda x: F.struct(x, F.struct(x.alias("serviceName")))))
    one = F.struct(F.col("trace_id").alias("traceID"), F.col("j").alias("spans"), processes.alias("processes"))
    text = F.when(F.col("kind") == 0, F.to_json(F.struct(F.col("o").alias("resourceSpans")))).when(F.col("kind") == 1, F.to_json(F.struct(F.array(one).alias("data")))).otherwise(F.to_json("z"))
    return trace_edges(facts(by.select(F.concat("trace_id", F.lit(".json")).alias("path"), text.alias("content")), "otel-traces"))


@query(f"WITH {PAIRS} SELECT 'n' || f AS path, src, dst, (row_number() OVER (PARTITION BY f ORDER BY replace(src, 'svc_', '')::BIGINT, k) - 1) AS ord, (CASE WHEN f % 5 = 2 THEN 1 ELSE 0 END)::BIGINT AS rejected FROM p")
def parse_text_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edge lists as a JSON object, a JSON array, arrow lines with one that is none, and columns with two delimiters."""
    pairs = _nodes(spark, d).select("f", "k", "node", F.explode("deps").alias("b")).groupBy("f").agg(F.sort_array(F.collect_list(F.struct("k", "b", F.col("node").alias("s"), _svc(F.col("b")).alias("t")))).alias("all"))
    lines = lambda sep: F.array_join(F.transform("all", lambda x: F.concat(x["s"], F.lit(sep), x["t"])), "\n")
    listed = F.transform("all", lambda x: F.struct(x["s"].alias("from"), x["t"].alias("to")))
    kind = F.col("f") % 5
    text = (
        F.when(kind == 0, F.to_json(F.struct(listed.alias("edges")))).when(kind == 1, F.to_json(F.transform("all", lambda x: F.array(x["s"], x["t"]))))
        .when(kind == 2, F.concat(F.lit("a remark\n"), lines(" -> "))).when(kind == 3, F.concat(F.lit("source,target\n# all of them\n"), lines(","))).otherwise(lines("|"))
    )
    return text_edges(pairs.select(F.concat(F.lit("n"), F.col("f").cast("string")).alias("path"), text.alias("content")))


# --- files and directories ------------------------------------------------------------
# A source tree of some few files, one of each format, that all hold the chain of nations by key.


def _chain(spark: SparkSession, d: str) -> list[tuple[str, str]]:
    keys = [r[0] for r in table(spark, d, "nation").select("n_nationkey").orderBy("n_nationkey").limit(100).collect()]  # what the tree's few files name
    names = [f"n{k:02}x" for k in keys]
    return list(zip(names, names[1:]))


_CHAIN = "n AS (SELECT 'n' || lpad(n_nationkey::VARCHAR, 2, '0') || 'x' AS x, lead('n' || lpad(n_nationkey::VARCHAR, 2, '0') || 'x') OVER (ORDER BY n_nationkey) AS y FROM nation), c AS (SELECT x AS src, y AS dst FROM n WHERE y IS NOT NULL)"


def _tree(pairs: list[tuple[str, str]]) -> dict[str, str]:
    names = [pairs[0][0], *[b for _, b in pairs]]
    after = dict(pairs)
    of = lambda f, sep="": sep.join(f(x, after.get(x)) for x in names)
    k8s = lambda x, y: f"kind: Service\nmetadata: {{name: {x}}}\nspec: {{selector: {{app: {x}-app}}}}\n---\n" + (f"kind: Ingress\nmetadata: {{name: {x}}}\nspec: {{rules: [{{http: {{paths: [{{backend: {{service: {{name: {y}}}}}}}]}}}}]}}\n---\n" if y else "")
    zipkin = [{"traceId": "t", "id": x, "parentId": names[i - 1] if i else None, "localEndpoint": {"serviceName": x}} for i, x in enumerate(names)]
    tree = {
        "docker-compose.yml": "services:\n" + of(lambda x, y: f"  {x}:\n    depends_on: [{y or ''}]\n"),
        "k8s/all.yaml": of(k8s),
        ".github/workflows/flow.yml": "name: f\njobs:\n" + of(lambda x, y: f"  {x}:\n" + (f"    needs: {names[names.index(x) - 1]}\n" if x != names[0] else "    runs-on: y\n")),
        "main.tf": of(lambda x, y: f'resource "r" "{x}" {{\n  a = {"r." + y + ".id" if y else 1}\n}}\n'),
        "package.json": json.dumps({"name": "root-of-all"}),
        "stack.json": json.dumps({"Resources": {x: {"Type": "T", "Properties": {"a": {"Ref": after[x]} if x in after else 1}} for x in names}}),
        "zipkin.json": json.dumps(zipkin),
        "cdk.py": "import aws_cdk\n" + of(lambda x, y: f'{x} = aws_cdk.T(self, "{x}", a={y})\n'),
        "infra.py": "import pulumi\n" + of(lambda x, y: f'{x} = pulumi.T("{x}", a={y})\n'),
        "agents.py": "from langgraph import x\n" + "".join(f'g.add_edge("{a}", "{b}")\n' for a, b in pairs),
        "crew.py": "from crewai import x\n" + of(lambda x, y: f"{x} = Task(context=[{names[names.index(x) - 1] if x != names[0] else ''}])\n"),
        "chats.py": "from autogen import x\n" + "".join(f"{a}.initiate_chat({b})\n" for a, b in pairs),
    }
    tree |= {f"pkg/{x}.py": f"from pkg.{after[x]} import a\n" if x in after else "a = 1\n" for x in names}
    return tree | {f"parts/{x}/package.json": json.dumps({"name": x, "dependencies": {after.get(x, "left"): "1"}}) for x in names}


def _put(spark: SparkSession, tree: dict[str, str]) -> str:
    """The tree as files in the shared folder, by Hadoop's file systems."""
    root = f"{folder(spark)}/tree-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for name, text in tree.items():
        out = fs.create(path(f"{root}/{name}"))
        out.write(bytearray(text.encode()))
        out.close()
    return root


_FORMATS = {
    "docker-compose": ("docker-compose.yml", from_docker_compose), "kubernetes": ("k8s", from_kubernetes), "github-actions": (".github/workflows", from_github_actions), "terraform": ("main.tf", from_terraform),
    "python-imports": ("", from_python_imports), "package-json": ("", from_package_json_workspaces), "cloudformation": ("stack.json", from_cloudformation), "aws-cdk": ("cdk.py", from_aws_cdk),
    "pulumi": ("infra.py", from_pulumi), "langgraph": ("agents.py", from_langgraph), "crewai": ("crew.py", from_crewai), "autogen": ("chats.py", from_autogen), "otel-traces": ("zipkin.json", from_otel_traces),
}
_LABELS = "l AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in _FORMATS) + "]) AS source)"
_FLOW = "SELECT 'github-actions' AS source, 'f/' || src AS src, 'f/' || dst AS dst FROM c UNION ALL SELECT 'github-actions', 'f', 'f/' || min(src) FROM c"


@query(f"WITH {_CHAIN}, {_LABELS} SELECT source, src, dst FROM c, l WHERE source <> 'github-actions' UNION ALL {_FLOW}")
def files_of_each_format(spark: SparkSession, d: str) -> DataFrame:
    """Each format's reader on its own file or folder."""
    root, out = _put(spark, _tree(_chain(spark, d))), None
    for name, (path, read) in _FORMATS.items():
        own = read(spark, f"{root}/{path}".rstrip("/")).select(F.lit(name).alias("source"), "src", "dst")
        out = own if out is None else out.unionByName(own)
    return out


@query(f"WITH {_CHAIN} SELECT src, dst FROM c UNION SELECT src, dst FROM ({_FLOW})")
def directory_edges(spark: SparkSession, d: str) -> DataFrame:
    return from_directory(spark, _put(spark, _tree(_chain(spark, d))))[0]


@query(f"WITH {_CHAIN}, {_LABELS} SELECT source, count(*) + CASE source WHEN 'github-actions' THEN 1 ELSE 0 END AS n_edges FROM c, l GROUP BY source")
def directory_sources(spark: SparkSession, d: str) -> DataFrame:
    """Counts by format, before edges that several formats hold become one."""
    return from_directory(spark, _put(spark, _tree(_chain(spark, d))))[1]


@query(f"WITH {_CHAIN} SELECT src, dst, row_number() OVER (PARTITION BY f ORDER BY src) - 1 AS ord, f AS file FROM c, (SELECT unnest(['array', 'object']) AS f)")
def graph_document_edges(spark: SparkSession, d: str) -> DataFrame:
    """A graph as a JSON object and as a bare array."""
    pairs = _chain(spark, d)
    root = _put(spark, {"object.json": json.dumps({"name": "g", "edges": [{"source": a, "target": b} for a, b in pairs]}), "array.json": json.dumps(pairs)})
    return graph_documents(spark, root).select("src", "dst", "ord", F.regexp_extract("path", r"(\w+)\.json$", 1).alias("file"))
