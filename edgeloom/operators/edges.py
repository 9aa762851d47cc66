"""Edge algebra: shape, names, aliases, duplicates, set operations, what-if edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import canonical, edge_set_key
from ..schema import EdgeError, NodeLimitError

#: Names under which records hold the two ends.
SRC_NAMES, DST_NAMES = ("src", "source", "from"), ("dst", "target", "to")


def _either(df: DataFrame, names: tuple[str, ...]) -> Column:
    have = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in df.columns]
    if not have:
        raise EdgeError(f"none of the columns {', '.join(names)}")
    return F.coalesce(*have)


def normalize(df: DataFrame, strict: bool = True) -> DataFrame:
    """Any shape of edge records as (src, dst, weight, ord): columns under the known names,
    or one array or map column `edge`. A missing or blank end raises when rows are read
    (strict) or drops the row."""
    if "edge" in df.columns:
        kind = df.schema["edge"].dataType
        if isinstance(kind, T.ArrayType):
            src, dst = F.nullif(F.get("edge", F.lit(0)).cast("string"), F.lit("")), F.nullif(F.get("edge", F.lit(1)).cast("string"), F.lit(""))
        elif isinstance(kind, T.MapType):
            src = F.coalesce(*[F.nullif(F.try_element_at("edge", F.lit(n)).cast("string"), F.lit("")) for n in SRC_NAMES])
            dst = F.coalesce(*[F.nullif(F.try_element_at("edge", F.lit(n)).cast("string"), F.lit("")) for n in DST_NAMES])
        else:
            raise EdgeError("edge must be an array or a map")
    else:
        src, dst = _either(df, SRC_NAMES), _either(df, DST_NAMES)
    weight = F.coalesce(F.col("weight").cast("double"), F.lit(1.0)) if "weight" in df.columns else F.lit(1.0)
    order = F.col("ord").cast("long") if "ord" in df.columns else F.monotonically_increasing_id()
    rest = [c for c in ("graph_id", "source_format") if c in df.columns]
    out = df.select(*rest, src.alias("src"), dst.alias("dst"), weight.alias("weight"), order.alias("ord"))
    whole = F.col("src").isNotNull() & F.col("dst").isNotNull()
    if not strict:
        return out.where(whole)
    ok = F.when(whole, F.col("src")).otherwise(F.raise_error(F.lit("edge with a missing or blank end")).cast("string"))
    return out.withColumn("src", ok)


def validate(edges: DataFrame, min_edges: int = 2, max_nodes: int | None = None) -> DataFrame:
    """edges, or an error: too few edges (counted before duplicates go) or too many nodes."""
    if edges.limit(min_edges).count() < min_edges:
        raise EdgeError(f"at least {min_edges} edges are needed")
    if max_nodes is not None and (n := node_count(edges)) > max_nodes:
        raise NodeLimitError(f"{n} nodes; at most {max_nodes} are allowed")
    return edges


def drop_self_loops(edges: DataFrame) -> DataFrame:
    return edges.where("src <> dst")


def distinct(edges: DataFrame) -> DataFrame:
    """Distinct (src, dst) with the place each was first seen at; combines before the shuffle."""
    return edges.groupBy("src", "dst").agg(F.min("ord").alias("ord"))


def alias(edges: DataFrame, aliases: dict[str, str] | DataFrame) -> DataFrame:
    """Ends replaced by their alias. A dict is a literal map; a DataFrame (name, alias) is joined."""
    if isinstance(aliases, dict):
        if not aliases:
            return edges
        table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        return edges.withColumns({c: F.coalesce(F.try_element_at(table, F.col(c)), F.col(c)) for c in ("src", "dst")})
    for c in ("src", "dst"):
        edges = edges.join(aliases.select(F.col("name").alias(c), F.col("alias").alias("__a")), c, "left").withColumn(c, F.coalesce("__a", c)).drop("__a")
    return edges


def dedupe(edges: DataFrame, mode: str = "snake", aliases: dict[str, str] | DataFrame | None = None, self_loops: bool = False) -> DataFrame:
    """Canonical names, then aliases, then no self-loops, then distinct edges as first seen."""
    out = edges.where("src is not null and dst is not null").withColumns({c: canonical(F.col(c), mode) for c in ("src", "dst")})
    out = alias(out, aliases) if aliases is not None else out
    return distinct(out if self_loops else drop_self_loops(out))


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


def node_count(edges: DataFrame) -> int:
    return nodes(edges).count()


def union(**by_source: DataFrame) -> DataFrame:
    """Edges of several sources, one after the other, with the source's name."""
    out = None
    for name, e in by_source.items():
        e = e.select("src", "dst", F.lit(name).alias("source"))
        out = e if out is None else out.unionByName(e)
    return out


def source_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("source").agg(F.count("*").alias("n_edges"))


def _pairs(e: DataFrame) -> DataFrame:
    return e.select("src", "dst")


def common(before: DataFrame, after: DataFrame) -> DataFrame:
    return _pairs(before).intersect(_pairs(after))


def added(before: DataFrame, after: DataFrame) -> DataFrame:
    return _pairs(after).subtract(_pairs(before))


def removed(before: DataFrame, after: DataFrame) -> DataFrame:
    return added(after, before)


def node_status(before: DataFrame, after: DataFrame) -> DataFrame:
    """(node, status): added, removed or both."""
    b, a = nodes(before).withColumn("b", F.lit(True)), nodes(after).withColumn("a", F.lit(True))
    status = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").otherwise("both")
    return b.join(a, "node", "full_outer").select("node", status.alias("status"))


def what_if(current: DataFrame, add: DataFrame | None = None, remove: DataFrame | None = None) -> DataFrame:
    """(current without remove) and all of add, as a bag."""
    out = _pairs(current)
    if remove is not None:
        out = out.join(_pairs(remove).distinct(), ["src", "dst"], "left_anti")
    return out if add is None else out.unionByName(_pairs(add))


def fingerprint(edges: DataFrame) -> str:
    return edges.agg(edge_set_key(F.col("src"), F.col("dst")).alias("k")).first()["k"]
