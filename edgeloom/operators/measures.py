"""Measures of every node at once, risks by rules that the caller gives, and what changes between graphs.

The measures are textbook ones (longest-path layer, peers of a layer, share of weight,
share of source-to-sink paths, share of out-edges). A rule is a condition on them with the
caller's own limits; none is built in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import drift as drift_
from . import edges as edges_
from . import graph

MEASURES = ("depth", "independence", "throughput", "criticality", "fanout")


@dataclass(frozen=True)
class Measured:
    """vectors (node, layer and MEASURES), info (one row) and the edges that breaking cycles deleted."""

    vectors: DataFrame
    info: DataFrame
    deleted: DataFrame

    def node(self, name: str) -> DataFrame:
        return self.vectors.where(F.col("node") == name)

    def dimension(self, name: str) -> DataFrame:
        return self.vectors.select("node", name)


def measures(edges: DataFrame, max_nodes: int | None = None) -> Measured:
    """All measures of a graph in any order of its edges: loops and duplicates go, cycles are
    broken by the stall rule. Layers are found once and serve depth, peers and paths."""
    own, deleted = graph.break_cycles(edges_.validate(edges, 1, max_nodes))
    own = graph.kept(own)
    layered = graph.kept(graph.layers(own)[0])
    deep = graph.depth_of(layered).join(graph.independence(layered).select("node", "independence"), "node")
    paths = graph.path_share(own, layered).select("node", F.col("share").alias("criticality"))
    vectors = deep.join(graph.throughput(own), "node").join(paths, "node").join(graph.fanout(own), "node").select("node", "layer", *MEASURES)
    vectors = graph.kept(vectors)
    counts = vectors.agg(F.count("*").alias("n_nodes"), F.max("layer").alias("max_depth"))
    info = counts.crossJoin(own.agg(F.count("*").alias("n_edges"))).select("n_nodes", "n_edges", "max_depth")
    return Measured(vectors, info, deleted)


@dataclass(frozen=True)
class Rule:
    """A risk where `condition` (SQL over a vector's columns) holds; value: the column to report."""

    category: str
    severity: str
    condition: str
    value: str
    description: str = ""


def apply_rules(vectors: DataFrame, rules: list[Rule]) -> DataFrame:
    """(node, category, severity, description, value): a row for each rule that a vector meets.
    One projection, no shuffle."""

    def one(r: Rule) -> Column:
        entry = F.struct(F.lit(r.category).alias("category"), F.lit(r.severity).alias("severity"), F.lit(r.description).alias("description"), F.col(r.value).cast("double").alias("value"))
        return F.when(F.expr(r.condition), entry)

    if not rules:
        return vectors.limit(0).selectExpr("node", "'' AS category", "'' AS severity", "'' AS description", "0D AS value")
    found = F.filter(F.array(*[one(r) for r in rules]), lambda x: x.isNotNull())
    return vectors.select("node", F.explode(found).alias("r")).select("node", "r.*")


@dataclass(frozen=True)
class Compared:
    """Two measured graphs, the long drift between them, and the risks of either that the other lacks."""

    before: Measured
    after: Measured
    drift: DataFrame
    new_risks: DataFrame
    gone_risks: DataFrame


def compare(before: DataFrame, after: DataFrame, rules: list[Rule] = ()) -> Compared:
    """Measures of two versions of a graph and what changed."""
    from ..results import in_background

    first = in_background(measures, before)  # Spark runs both graphs' jobs side by side
    a = measures(after)
    b = first.result()
    rb, ra = apply_rules(b.vectors, list(rules)), apply_rules(a.vectors, list(rules))
    only = lambda x, y: x.join(y.select("node", "category"), ["node", "category"], "left_anti").select(*x.columns)
    return Compared(b, a, drift_.drift(b.vectors, a.vectors, MEASURES), only(ra, rb), only(rb, ra))


def simulate(edges: DataFrame, add: DataFrame | None = None, remove: DataFrame | None = None, rules: list[Rule] = ()) -> Compared:
    """What an edit of the graph would change; each graph is measured once."""
    none = edges.select("src", "dst").limit(0)
    return compare(edges, edges_.what_if(edges, none if add is None else add, none if remove is None else remove), rules)


def mean_reach(edges: DataFrame) -> DataFrame:
    """(node, n_reached_by, mean_reach): from how many other nodes one is reached, and the share of
    all other nodes that is."""
    pairs = graph.reach(edges.where("src <> dst")).where("src <> dst")
    n = edges_.nodes(edges).agg(F.count("*").alias("n"))
    into = pairs.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("n_reached_by"))
    every = edges_.nodes(edges).join(into, "node", "left").crossJoin(F.broadcast(n))
    by = F.coalesce("n_reached_by", F.lit(0)).cast("long")
    return every.select("node", by.alias("n_reached_by"), F.coalesce(F.try_divide(by, F.col("n") - 1), F.lit(0.0)).alias("mean_reach"))


def vector_of(values: Column, names: tuple[str, ...] = MEASURES) -> Column:
    """A map of named values as an array in the order of names: missing ones are 0, others go."""
    return F.array(*[F.coalesce(F.try_element_at(values, F.lit(n)).cast("double"), F.lit(0.0)) for n in names])


def change_card(before: DataFrame, after: DataFrame, dims: tuple[str, ...] = MEASURES, digits: int = 3) -> DataFrame:
    """(node, card): a line for each measure with its value before and after; a change that rounds to nothing is 0."""
    w = drift_.wide(before, after, dims)
    small = 0.5 * 10**-digits
    delta = lambda d: F.when(F.abs(f"delta_{d}") < small, F.lit(0.0)).otherwise(F.col(f"delta_{d}"))
    lines = [F.format_string(f"{d}: %.{digits}f to %.{digits}f (%+.{digits}f)", F.col(f"before_{d}"), F.col(f"after_{d}"), delta(d)) for d in dims]
    return w.select("node", F.concat_ws("\n", *lines).alias("card"))
