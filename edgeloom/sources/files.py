"""Edges of each file format: facts per file, then joins."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import dotted_rollup
from ..operators.graph import complete, ring, star
from ..operators.spans import service_edges
from .facts import PARSERS

FACTS = "fmt string, path string, pos long, kind string, name string, ref string, props map<string,string>"


def files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, content) of text files, path relative to the root where that is a directory."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    root = path.removeprefix("file://").rstrip("/")
    own = F.regexp_replace("path", r"^file:/*", "/")
    rel = F.when(F.startswith(own, F.lit(root + "/")), F.substring(own, len(root) + 2, 1 << 20)).otherwise(F.element_at(F.split(own, "/"), -1))
    return reader.load(path).select(rel.alias("path"), F.col("content").cast("string").alias("content"))


def facts(table: DataFrame, fmt: str | Column, strict: bool = True) -> DataFrame:
    """Facts of a file table. fmt: a format, or a column that names each file's.
    strict: a file that can't be parsed raises; else it has no facts."""

    def run(batches):
        for pdf in batches:
            rows = []
            for path, content, kind in zip(pdf["path"], pdf["content"], pdf["fmt"]):
                try:
                    found = list(PARSERS[kind](path, content))
                except Exception:
                    if strict:
                        raise
                    continue
                text = lambda x: None if x is None else str(x)
                rows += [(kind, path, i, k, text(n), text(r), p) for i, (k, n, r, p) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["fmt", "path", "pos", "kind", "name", "ref", "props"])

    return table.select("path", "content", (F.lit(fmt) if isinstance(fmt, str) else fmt).alias("fmt")).mapInPandas(run, FACTS)


def _of(f: DataFrame, kind: str) -> DataFrame:
    return f.where(F.col("kind") == kind)


def _done(*parts: DataFrame) -> DataFrame:
    """Distinct edges without self-loops."""
    out = parts[0].select("src", "dst")
    for p in parts[1:]:
        out = out.unionByName(p.select("src", "dst"))
    return out.where("src is not null and dst is not null and src <> dst").distinct()


def _ends(f: DataFrame, kind: str = "edge") -> DataFrame:
    return _of(f, kind).select(F.col("name").alias("src"), F.col("ref").alias("dst"))


def plain_edges(f: DataFrame) -> DataFrame:
    return _done(_ends(f))


def _last(f: DataFrame, kind: str) -> DataFrame:
    """Facts of a kind, for a name the last one's."""
    return _of(f, kind).groupBy("name").agg(F.max_by("props", F.struct("path", "pos")).alias("props"))


def kubernetes_edges(f: DataFrame) -> DataFrame:
    services, workloads = _last(f, "service"), _last(f, "workload")
    # selector containment as relational division: as many equal pairs as the selector has
    pairs = services.select(F.col("name").alias("src"), F.size("props").alias("need"), F.explode("props").alias("k", "v"))
    labels = workloads.select(F.col("name").alias("dst"), F.explode("props").alias("k", "v"))
    selected = pairs.join(labels, ["k", "v"]).groupBy("src", "dst", "need").agg(F.count("*").alias("n")).where("n = need")
    env = _of(f, "env").select(F.col("name").alias("src"), "ref").distinct()
    # a substring join has no key: distinct values against service names, a nested loop by nature
    named = env.join(services.select(F.col("name").alias("dst")), F.contains("ref", "dst") & (F.col("src") != F.col("dst")))
    return _done(selected, _ends(f), named)


def known_refs(f: DataFrame, by_path: bool, label: bool) -> DataFrame:
    """Refs between known resources; label: the resource's short name is the node."""
    key = ["path"] if by_path else []
    known = _of(f, "resource").select(*key, "name", F.coalesce("ref", "name").alias("label")).distinct()
    refs = _of(f, "ref").select(*key, "name", "ref")
    a, b = known.withColumnRenamed("label", "src"), known.select(*key, F.col("name").alias("ref"), F.col("label").alias("dst"))
    out = refs.join(a, [*key, "name"]).join(b, [*key, "ref"])
    return _done(out if label else out.select(F.col("name").alias("src"), F.col("ref").alias("dst")))


def import_edges(f: DataFrame, depth: int | None = None) -> DataFrame:
    """Importer to the longest local prefix of what it imports, or of that without its first part."""
    modules = _of(f, "module").select(F.col("name").alias("cand")).distinct()
    parts = F.split("ref", r"\.")
    prefix = lambda from_: F.transform(F.sequence(F.size(parts), F.lit(from_), F.lit(-1)), lambda n: F.struct(F.lit(from_ - 1).alias("cut"), (-n).alias("short"), F.array_join(F.slice(parts, from_, n - from_ + 1), ".").alias("cand")))
    tries = F.when(F.size(parts) > 1, F.concat(prefix(1), prefix(2))).otherwise(prefix(1))
    rows = _of(f, "import").select("name", "ref").distinct().select("name", "ref", F.explode(tries).alias("t")).select("name", "ref", "t.*")
    found = rows.where("cand <> name").join(modules, "cand").groupBy("name", "ref").agg(F.min_by("cand", F.struct("cut", "short")).alias("to"))
    if depth is not None:
        return _done(found.select(dotted_rollup(F.col("name"), depth).alias("src"), dotted_rollup(F.col("to"), depth).alias("dst")))
    a, b = dotted_rollup(F.col("name"), None), dotted_rollup(F.col("to"), None)
    return _done(found.select(F.when(a == b, F.col("name")).otherwise(a).alias("src"), F.when(a == b, F.col("to")).otherwise(b).alias("dst")))


def dependency_edges(f: DataFrame) -> DataFrame:
    return _done(_ends(f, "dep"))


def workspace_edges(f: DataFrame) -> DataFrame:
    local = _of(f, "package").select(F.col("name").alias("dst")).distinct()
    return _done(_ends(f, "dep").join(local, "dst", "left_semi"))


def chat_edges(f: DataFrame) -> DataFrame:
    """Topologies of group chats: star from a manager, ring, or everyone to everyone."""
    m = _of(f, "member").select(F.concat_ws("#", "path", "name").alias("team"), F.col("ref").alias("member"), F.col("props")["kind"].alias("shape"), F.col("props")["pos"].cast("int").alias("pos"))
    managers = _of(f, "manager").select(F.concat_ws("#", "path", "name").alias("team"), F.col("ref").alias("hub")).distinct()
    managed = m.where("shape = 'legacy'").join(managers, "team", "left_semi")
    open_ = m.where("shape = 'legacy'").join(managers, "team", "left_anti").unionByName(m.where("shape = 'complete'"))
    return _done(star(managed, managers), ring(m.where("shape = 'ring'")), complete(open_), _ends(f))


def trace_spans(f: DataFrame) -> DataFrame:
    return _of(f, "span").select(F.col("props")["scope"].alias("trace_id"), F.col("name").alias("span_id"), F.col("ref").alias("parent_id"), F.col("props")["service"].alias("service"))


def trace_edges(f: DataFrame) -> DataFrame:
    return _done(service_edges(trace_spans(f), ("trace_id",)))


#: How facts of each format become edges.
EDGES_OF = {
    "docker-compose": plain_edges, "kubernetes": kubernetes_edges, "github-actions": plain_edges,
    "terraform": lambda f: known_refs(f, by_path=False, label=True), "python-imports": import_edges,
    "package-json": workspace_edges, "cloudformation": lambda f: known_refs(f, by_path=True, label=False),
    "aws-cdk": plain_edges, "pulumi": plain_edges, "langgraph": plain_edges, "crewai": plain_edges, "autogen": chat_edges, "otel-traces": trace_edges,
}

_outside = r"(^|/)(node_modules|\.venv|venv|__pycache__|\.git)(/|$)"
_hidden = r"(^|/)\.[^/]"


def inside(table: DataFrame) -> DataFrame:
    return table.where(~F.regexp_like("path", F.lit(_outside)))


def from_docker_compose(spark: SparkSession, path: str) -> DataFrame:
    return plain_edges(facts(files(spark, path), "docker-compose"))


def from_kubernetes(spark: SparkSession, path: str) -> DataFrame:
    return kubernetes_edges(facts(files(spark, path, "*.{yml,yaml}"), "kubernetes", strict=False))


def from_github_actions(spark: SparkSession, path: str) -> DataFrame:
    return plain_edges(facts(files(spark, path, "*.{yml,yaml}", recursive=False), "github-actions", strict=False))


def from_terraform(spark: SparkSession, path: str) -> DataFrame:
    return known_refs(facts(files(spark, path, "*.tf"), "terraform"), by_path=False, label=True)


def from_python_imports(spark: SparkSession, path: str, depth: int | None = None) -> DataFrame:
    table = inside(files(spark, path, "*.py")).where(~F.regexp_like("path", F.lit(_hidden)))
    return import_edges(facts(table, "python-imports", strict=False), depth)


def from_package_json(spark: SparkSession, path: str) -> DataFrame:
    return dependency_edges(facts(files(spark, path), "package-json"))


def from_package_json_workspaces(spark: SparkSession, path: str) -> DataFrame:
    return workspace_edges(facts(inside(files(spark, path, "package.json")), "package-json", strict=False))


def is_template(content: Column) -> Column:
    """A cheap look at a file's head, before any parsing."""
    head = F.substring(content, 1, 2048)
    return F.contains(head, F.lit("AWSTemplateFormatVersion")) | F.contains(head, F.lit('"Resources"')) | F.regexp_like(head, F.lit(r"(?m)^Resources:"))


def from_cloudformation(spark: SparkSession, path: str) -> DataFrame:
    table = files(spark, path, "*.{yml,yaml,json,template}")
    return known_refs(facts(table.where(is_template(F.col("content"))), "cloudformation"), by_path=True, label=False)


def from_aws_cdk(spark: SparkSession, path: str) -> DataFrame:
    return plain_edges(facts(files(spark, path), "aws-cdk"))


def from_pulumi(spark: SparkSession, path: str) -> DataFrame:
    return plain_edges(facts(files(spark, path), "pulumi"))


def from_langgraph(spark: SparkSession, path: str) -> DataFrame:
    return plain_edges(facts(files(spark, path), "langgraph"))


def from_crewai(spark: SparkSession, path: str) -> DataFrame:
    return plain_edges(facts(files(spark, path), "crewai"))


def from_autogen(spark: SparkSession, path: str) -> DataFrame:
    return chat_edges(facts(files(spark, path), "autogen"))


def from_otel_traces(spark: SparkSession, path: str) -> DataFrame:
    return trace_edges(facts(files(spark, path), "otel-traces"))
