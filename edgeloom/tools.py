"""Functions for an assistant or a notebook: small arguments in, JSON documents out.

Each is a thin call of the library; what they return is for reading, so lists are cut at
`most` entries and say how many there are in all."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import measures as m
from .operators import risks as r
from .sources import from_directory, from_docker_compose, from_kubernetes, from_python_imports
from .sources.files import EDGES_OF, facts
from .sources.text import text_edges


def pasted(spark: SparkSession, content: str, fmt: str | None = None) -> DataFrame:
    """(src, dst) of pasted text: an edge list, or a file of a named format."""
    table = spark.createDataFrame([("pasted", content)], "path string, content string")
    if fmt is None:
        return text_edges(table).select("src", "dst")
    if fmt not in EDGES_OF:
        raise ValueError(f"unknown format {fmt!r}; one of {', '.join(sorted(EDGES_OF))}")
    return EDGES_OF[fmt](facts(table, fmt))


def _frame(spark: SparkSession, edges: list) -> DataFrame:
    return spark.createDataFrame([(str(a), str(b)) for a, b in edges], "src string, dst string")


def _edges(df: DataFrame, most: int) -> dict[str, Any]:
    rows = df.select("src", "dst").distinct().orderBy("src", "dst")
    return {"edges": [[x["src"], x["dst"]] for x in rows.limit(most).collect()], "n_edges": rows.count()}


def scan_directory(spark: SparkSession, path: str, most: int = 1000) -> dict[str, Any]:
    found, counts = from_directory(spark, path)
    return _edges(found, most) | {"sources": {x["source"]: x["n_edges"] for x in counts.collect()}}


def scan_compose(spark: SparkSession, path: str, most: int = 1000) -> dict[str, Any]:
    return _edges(from_docker_compose(spark, path), most)


def scan_kubernetes(spark: SparkSession, path: str, most: int = 1000) -> dict[str, Any]:
    return _edges(from_kubernetes(spark, path), most)


def scan_imports(spark: SparkSession, path: str, depth: int | None = None, most: int = 1000) -> dict[str, Any]:
    return _edges(from_python_imports(spark, path, depth), most)


def measure(spark: SparkSession, edges: list, rules: list[dict] = (), most: int = 1000) -> dict[str, Any]:
    """Measures by node, the most critical first, and the risks that the rules find."""
    found = m.measures(_frame(spark, edges))
    rows = found.vectors.orderBy(F.desc("criticality"), "node").limit(most).collect()
    risks = r.sort(m.apply_rules(found.vectors, [m.Rule(**x) for x in rules]))
    return {"metadata": found.info.first().asDict(), "vectors": {x["node"]: {d: x[d] for d in m.MEASURES} for x in rows}, "risks": [x.asDict() for x in risks.limit(most).collect()], "n_risks": risks.count()}


def _changes(c: m.Compared, most: int) -> dict[str, Any]:
    rows = c.drift.orderBy(F.desc(F.abs("delta")), "node", "dim")
    risks = lambda df: [x.asDict() for x in r.sort(df).limit(most).collect()]
    return {"drift": [x.asDict() for x in rows.limit(most).collect()], "n_changes": rows.count(), "new_risks": risks(c.new_risks), "gone_risks": risks(c.gone_risks)}


def diff(spark: SparkSession, before: list, after: list, rules: list[dict] = (), most: int = 1000) -> dict[str, Any]:
    return _changes(m.compare(_frame(spark, before), _frame(spark, after), [m.Rule(**x) for x in rules]), most)


def simulate(spark: SparkSession, edges: list, add: list = (), remove: list = (), rules: list[dict] = (), most: int = 1000) -> dict[str, Any]:
    return _changes(m.simulate(_frame(spark, edges), _frame(spark, add), _frame(spark, remove), [m.Rule(**x) for x in rules]), most)


#: The functions by name, as an assistant would be given them.
TOOLS: dict[str, Callable[..., dict[str, Any]]] = {f.__name__: f for f in (scan_directory, scan_compose, scan_kubernetes, scan_imports, measure, diff, simulate)}
