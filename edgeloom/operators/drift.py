"""Two versions of a graph: long drift, summary, top changes, risk changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DIMENSIONS

#: A change smaller than this is none; a node whose largest change is over MOVED has moved.
EPSILON, MOVED = 1e-6, 0.05


def _long(v: DataFrame, dims: tuple[str, ...], name: str) -> DataFrame:
    return v.unpivot("node", list(dims), "dim", name)


def drift(before: DataFrame, after: DataFrame, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """(node, dim, before, after, delta, status) of the dimensions that changed; a node
    that one side lacks counts as zeros there. Compared unrounded, given to 4 places."""
    b, a = _long(before, dims, "b"), _long(after, dims, "a")
    there = b.join(a, ["node", "dim"], "full_outer")
    status = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").otherwise("both")
    x, y = F.coalesce("b", F.lit(0.0)), F.coalesce("a", F.lit(0.0))
    return there.where(F.abs(y - x) > EPSILON).select("node", "dim", F.round(x, 4).alias("before"), F.round(y, 4).alias("after"), F.round(y - x, 4).alias("delta"), status.alias("status"))


def drift_maps(d: DataFrame, detail: bool = False) -> DataFrame:
    """(node, changes): a map from dimension to delta, or to (before, after, delta)."""
    value = F.struct("before", "after", "delta") if detail else F.col("delta")
    return d.groupBy("node").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("dim"), value.alias("v"))))).alias("changes"))


def wide(before: DataFrame, after: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """(node, in_before, in_after, before_x, after_x, delta_x for each dimension)."""
    b = before.select("node", F.lit(True).alias("in_before"), *[F.col(d).alias(f"before_{d}") for d in dims])
    a = after.select("node", F.lit(True).alias("in_after"), *[F.col(d).alias(f"after_{d}") for d in dims])
    both = b.join(a, "node", "full_outer").fillna(False, ["in_before", "in_after"]).fillna(0.0, [f"{s}_{d}" for s in ("before", "after") for d in dims])
    return both.withColumns({f"delta_{d}": F.col(f"after_{d}") - F.col(f"before_{d}") for d in dims})


def summary(before: DataFrame, after: DataFrame, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """One row: n_added, n_removed, n_changed (nodes of both that moved)."""
    w = wide(before, after, dims)
    moved = F.greatest(*[F.abs(f"delta_{d}") for d in dims]) if len(dims) > 1 else F.abs(f"delta_{dims[0]}")
    return w.agg(
        F.count_if(~F.col("in_before")).alias("n_added"), F.count_if(~F.col("in_after")).alias("n_removed"),
        F.count_if(F.col("in_before") & F.col("in_after") & (moved > MOVED)).alias("n_changed"),
    )


def top_changes(before: DataFrame, after: DataFrame, by: str = "criticality", dims: tuple[str, ...] = ("criticality", "throughput", "fanout"), k: int = 20) -> DataFrame:
    """The k nodes whose `by` changed most, with its values and all deltas to 3 places."""
    w = wide(before, after, dims)
    status = F.when(~F.col("in_before"), "added").when(~F.col("in_after"), "removed").otherwise("both")
    cols = [F.round(f"before_{by}", 3).alias("before"), F.round(f"after_{by}", 3).alias("after"), *[F.round(f"delta_{d}", 3).alias(f"delta_{d}") for d in dims]]
    return w.orderBy(F.desc(F.abs(f"delta_{by}")), "node").limit(k).select("node", status.alias("status"), *cols)


def risk_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(node, n_before, n_after, delta) of risk counts."""
    b = before.groupBy("node").agg(F.count("*").alias("n_before"))
    a = after.groupBy("node").agg(F.count("*").alias("n_after"))
    out = b.join(a, "node", "full_outer").fillna(0, ["n_before", "n_after"])
    return out.withColumn("delta", F.col("n_after") - F.col("n_before"))
