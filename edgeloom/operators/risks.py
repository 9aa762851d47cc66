"""Queries over vectors and risk entries: filters, ranks, counts, cards, texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bar, category_label, short
from ..schema import DIMENSIONS, SEVERITIES

#: What to do about each category.
ACTIONS = {
    "SINGLE_POINT_OF_FAILURE": "add a second instance or a fallback for",
    "AMPLIFICATION_RISK": "put limits or queues in front of what depends on",
    "CONVERGENCE_SINK": "watch the load and give room to",
    "DEEP_BOTTLENECK": "shorten or cache the chain up to",
    "MONITORING_GAP_CANDIDATE": "add alerts and traces for",
}


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def severity_rank(severity: Column) -> Column:
    """0 for critical, then on; what isn't known counts as info."""
    return F.when(severity == "critical", 0).when(severity == "warning", 1).otherwise(2)


def by_category(risks: DataFrame, text: str) -> DataFrame:
    """Substring of the category in any case, "_", "-" and space alike in the query."""
    wanted = text.lower().replace("_", " ").replace("-", " ")
    return risks.where(F.contains(F.lower(F.translate("category", "_", " ")), F.lit(wanted)))


def by_severity(risks: DataFrame, level: str) -> DataFrame:
    return risks.where(F.col("severity") == level)


def of_node(risks: DataFrame, node: str) -> DataFrame:
    return risks.where(F.col("node") == node)


def severity_counts(risks: DataFrame) -> DataFrame:
    """(severity, n), unknown severities as info."""
    known = F.when(F.col("severity").isin(*SEVERITIES), F.col("severity")).otherwise("info")
    return risks.groupBy(known.alias("severity")).agg(F.count("*").alias("n"))


def top_severity(risks: DataFrame) -> DataFrame:
    return risks.groupBy("node").agg(F.min_by("severity", severity_rank(F.col("severity"))).alias("severity"))


def by_category_list(risks: DataFrame) -> DataFrame:
    """(category, n, nodes): sorted distinct names. A category's nodes are what a report prints."""
    return risks.groupBy("category").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("node")), ", ").alias("nodes"))


def actions(risks: DataFrame) -> DataFrame:
    todo = F.coalesce(F.try_element_at(_map(ACTIONS), F.col("category")), F.lit("look at"))
    return by_category_list(risks).select("category", F.concat_ws(" ", todo, "nodes").alias("action"))


def sort(risks: DataFrame, by: str = "severity", descending: bool = False) -> DataFrame:
    key = severity_rank(F.col("severity")) if by == "severity" else F.col(by)
    return risks.orderBy(key.desc() if descending else key.asc(), "node", "category")


def kpis(vectors: DataFrame, edges: DataFrame, risks: DataFrame, max_depth: DataFrame) -> DataFrame:
    """One row of cards; max_depth: a row with that column. All sides are one row each."""
    r = risks.agg(
        F.count_if(F.col("category") == "SINGLE_POINT_OF_FAILURE").alias("n_spof"),
        F.count_if(F.col("severity") == "warning").alias("n_warning"), F.count_if(F.col("severity") == "info").alias("n_info"),
    )
    n, e = vectors.agg(F.count("*").alias("n_nodes")), edges.agg(F.count("*").alias("n_edges"))
    return n.crossJoin(e).crossJoin(max_depth.select("max_depth")).crossJoin(r)


def has_critical(risks: DataFrame) -> bool:
    return not by_severity(risks, "critical").isEmpty()


def ranked(vectors: DataFrame, k: int | None = None, digits: int = 3) -> DataFrame:
    """Vectors by criticality, names cut at 35 characters; top k where given."""
    dims = [d for d in DIMENSIONS if d in vectors.columns]
    out = vectors.orderBy(F.desc("criticality"), "node")
    out = out if k is None else out.limit(k)
    return out.select(short(F.col("node")).alias("node"), *[F.round(d, digits).alias(d) for d in dims])


def radar(risks: DataFrame, vectors: DataFrame, n: int = 5) -> DataFrame:
    """Vectors of the first n nodes with risks, the most severe first."""
    first = risks.groupBy("node").agg(F.min(severity_rank(F.col("severity"))).alias("r")).join(vectors.select("node"), "node", "left_semi").orderBy("r", "node").limit(n)
    return vectors.join(F.broadcast(first.select("node")), "node", "left_semi")


# Limits of the public filters.
def convergence(vectors: DataFrame) -> DataFrame:
    return vectors.where("fanout < 0.3 and throughput > 0.05")


def amplification(vectors: DataFrame) -> DataFrame:
    return vectors.where("fanout > 0.6")


def insights(vectors: DataFrame) -> DataFrame:
    """(node, messages): what each vector says by fixed limits; nodes without a message go."""
    rules = (
        (F.col("independence") < 0.2, "no peer at its stage"), (F.col("fanout") > 0.7, "spreads to many"), (F.col("criticality") > 0.05, "on many paths"),
        (F.col("throughput") > 0.2, "carries much of the traffic"), ((F.col("fanout") == 0) & (F.col("depth") > 0.7), "a deep end point"),
    )
    found = F.filter(F.array(*[F.when(c, F.lit(m)) for c, m in rules]), lambda x: x.isNotNull())
    return vectors.select("node", F.array_join(found, "; ").alias("messages")).where("messages <> ''")


def hit_rate(incidents: DataFrame, flagged: DataFrame) -> DataFrame:
    """One row: n_incidents, n_hit, rate. incidents: (incident, entities array); a hit
    touches a flagged node. Also n_confirmed, flagged nodes that an incident touched."""
    touched = incidents.select("incident", F.explode("entities").alias("node")).join(flagged.select("node").distinct(), "node", "left_semi")
    hit = touched.agg(F.count_distinct("incident").alias("n_hit"), F.count_distinct("node").alias("n_confirmed"))
    n = incidents.agg(F.count_distinct("incident").alias("n_incidents"))
    return n.crossJoin(hit).withColumn("rate", F.try_divide("n_hit", "n_incidents"))


# --- texts (of collected, small results) ------------------------------------


def cards(vectors: DataFrame, steps: int = 20) -> DataFrame:
    """(node, card): a bar for each dimension."""
    dims = [d for d in DIMENSIONS if d in vectors.columns]
    lines = [F.format_string(f"{d:<14}%s %.3f", bar(F.col(d), steps), F.col(d)) for d in dims]
    return vectors.select("node", F.concat_ws("\n", *lines).alias("card"))


def report(risks: DataFrame) -> str:
    """The report: a block for each category in the order of severity, then what to do, then totals."""
    rows = risks.select("node", "category", "severity", "description", "value", category_label(F.col("category")).alias("label"), severity_rank(F.col("severity")).alias("r")).orderBy("r", "category", F.desc("value"), "node").collect()
    if not rows:
        return "No structural risks found."
    out = [f"Structural risks: {len(rows)}", ""]
    for label in dict.fromkeys(r["label"] for r in rows):
        own = [r for r in rows if r["label"] == label]
        out += [f"{label} ({len(own)})"] + [f"  [{r['severity']}] {r['node']}: {r['description'] or ''} ({r['value']:.3f})" for r in own] + [""]
    out += ["What to do"] + [f"  - {a['action']}" for a in actions(risks).orderBy("category").collect()]
    counts = {r["severity"]: r["n"] for r in severity_counts(risks).collect()}
    return "\n".join([*out, "", ", ".join(f"{counts.get(s, 0)} {s}" for s in SEVERITIES)])


def markdown(risks: DataFrame) -> str:
    rows = sort(risks).collect()
    out = []
    for s in SEVERITIES:
        own = [r for r in rows if (r["severity"] if r["severity"] in SEVERITIES else "info") == s]
        if own:
            out += [f"### {s.title()} ({len(own)})", *[f"- **{r['node']}**: {r['category'].replace('_', ' ').lower()} ({r['value']:.3f})" for r in own], ""]
    return "\n".join(out).strip()


def headline(n_nodes: int, n_edges: int, max_depth: int, risks: DataFrame) -> str:
    counts = {r["severity"]: r["n"] for r in severity_counts(risks).collect()}
    return f"{n_nodes} nodes, {n_edges} edges, depth {max_depth}; " + ", ".join(f"{counts.get(s, 0)} {s}" for s in SEVERITIES)


def context(vectors: DataFrame, risks: DataFrame, k: int | None = None) -> str:
    """What a language model is told: every vector, the most critical first, then every risk; with
    k at most so many of each, and how many were left out. No file contents."""
    v, r = ranked(vectors, k).collect(), (sort(risks) if k is None else sort(risks).limit(k)).collect()
    more = lambda df, rows: [] if k is None or not (n := df.count() - len(rows)) else [f"({n} more)"]
    lines = [", ".join([x["node"], *[f"{d} {x[d]:.3f}" for d in x.asDict() if d != "node"]]) for x in v]
    found = [f"{x['severity']} {x['category']} {x['node']} {x['value']:.3f}" for x in r]
    return "\n".join(["Nodes by criticality:", *lines, *more(vectors, v), "Risks:", *found, *more(risks, r)])


def to_json(df: DataFrame) -> DataFrame:
    """One JSON document for each row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def result_document(vectors: DataFrame, risks: DataFrame, info: DataFrame) -> DataFrame:
    """One row, one JSON document: vectors by node, risks, info. For results that one document can hold."""
    dims = [d for d in DIMENSIONS if d in vectors.columns]
    v = vectors.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("node", F.struct(*dims).alias("v"))))).alias("vectors"))
    r = risks.agg(F.sort_array(F.collect_list(F.struct(*risks.columns))).alias("risks"))
    return to_json(v.crossJoin(r).crossJoin(info.select(F.struct(*info.columns).alias("graph_info"))))
