"""One query for each operator that the tables can show, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import drift, edges, graph, risks
from ..operators import spans as spans_
from ..sources.text import arrow_edges
from . import graphs as g
from .graphs import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


JAN, FEB = "1995-01", "1995-02"
BOTH = f"WITH {g.trade_sql('b', JAN)}, {g.trade_sql('a', FEB)}"


# --- spans and edge algebra ---------------------------------------------------


@query(f"WITH {g.SPAN} SELECT DISTINCT src, dst FROM call")
def span_service_edges(spark: SparkSession, d: str) -> DataFrame:
    return spans_.service_edges(g.spans(spark, d), ("trace_id",))


@query(f"WITH {g.SPAN} SELECT src, dst, count(*) AS n FROM call GROUP BY src, dst")
def span_edge_weights(spark: SparkSession, d: str) -> DataFrame:
    return spans_.service_calls(g.spans(spark, d), ("trace_id",))


@query("SELECT l_suppkey::VARCHAR AS src, l_partkey::VARCHAR AS dst, min(l_orderkey * 8 + l_linenumber) AS ord FROM lineitem GROUP BY 1, 2")
def edges_dedupe_first_seen(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"))
    return edges.distinct(e).select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"), "ord")


@query(f"WITH {g.trade_sql()} SELECT src, dst, weight FROM trade WHERE src <> dst")
def edges_drop_self_loops(spark: SparkSession, d: str) -> DataFrame:
    return edges.drop_self_loops(g.trade(spark, d))


#: Names in several styles from the part table.
_NAMES = """names AS (SELECT DISTINCT p_type || ' ' || p_brand AS n FROM part UNION SELECT p_name FROM part UNION SELECT replace(p_brand, '#', 'HTTPServer') || 'AuthService' FROM part
  UNION SELECT 'auth--svc/' || lower(p_brand) FROM part)"""


def _names(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    kinds = (F.concat_ws(" ", "p_type", "p_brand"), F.col("p_name"), F.concat(F.replace("p_brand", F.lit("#"), F.lit("HTTPServer")), F.lit("AuthService")), F.concat(F.lit("auth--svc/"), F.lower("p_brand")))
    return p.select(F.explode(F.array(*kinds)).alias("n")).distinct()


_SNAKE = r"""lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(n, '([a-z0-9])([A-Z])', '\1_\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '[\s\-/]+', '_', 'g'), '_+', '_', 'g'), '_'))"""


@query(f"WITH {_NAMES} SELECT n, {_SNAKE} AS name FROM names")
def edges_normalize_snake(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).select("n", text.canonical(F.col("n"), "snake").alias("name"))


@query(f"WITH {_NAMES} SELECT n, replace({_SNAKE}, '_', '-') AS name FROM names")
def edges_normalize_kebab(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).select("n", text.canonical(F.col("n"), "kebab").alias("name"))


@query(f"WITH {_NAMES} SELECT n, lower(n) AS name FROM names")
def edges_normalize_lower(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).select("n", text.canonical(F.col("n"), "lower").alias("name"))


_ALIAS = {"UNITED STATES": "USA", "UNITED KINGDOM": "UK", "FRANCE": "EU", "GERMANY": "EU"}
_WHEN = lambda c: "CASE " + " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in _ALIAS.items()) + f" ELSE {c} END"


@query(f"WITH {g.trade_sql()} SELECT DISTINCT {_WHEN('src')} AS src, {_WHEN('dst')} AS dst FROM trade")
def edges_alias(spark: SparkSession, d: str) -> DataFrame:
    return edges.alias(g.trade(spark, d), _ALIAS).select("src", "dst").distinct()


@query(f"WITH {g.trade_sql()} SELECT DISTINCT lower(replace({_WHEN('src')}, ' ', '_')) AS src, lower(replace({_WHEN('dst')}, ' ', '_')) AS dst FROM trade WHERE {_WHEN('src')} <> {_WHEN('dst')}")
def edges_dedupe_full(spark: SparkSession, d: str) -> DataFrame:
    own = {k.lower().replace(" ", "_"): v.lower() for k, v in _ALIAS.items()}
    return edges.dedupe(g.trade(spark, d).withColumn("ord", F.lit(0)), "snake", own).select("src", "dst")


@query(f"WITH {g.trade_sql()}, {g.SMALL} SELECT src, dst, 'trade' AS source FROM trade UNION ALL SELECT src, dst, 'dag' FROM small")
def edges_union_sources(spark: SparkSession, d: str) -> DataFrame:
    return edges.union(trade=g.trade(spark, d), dag=g.small_dag(spark, d))


@query(f"WITH {g.trade_sql()}, {g.SMALL} SELECT source, count(*) AS n_edges FROM (SELECT 'trade' AS source FROM trade UNION ALL SELECT 'dag' FROM small) GROUP BY source")
def source_counts(spark: SparkSession, d: str) -> DataFrame:
    return edges.source_counts(edges.union(trade=g.trade(spark, d), dag=g.small_dag(spark, d)))


@query(f"WITH {g.trade_sql()}, {g.DAG} SELECT src, dst, 'trade' AS source FROM trade UNION ALL SELECT src, dst, 'dag' FROM dag")
def edges_union_sources_dag(spark: SparkSession, d: str) -> DataFrame:
    """edges_union_sources with the parts that its SQL leaves out."""
    return edges.union(trade=g.trade(spark, d), dag=g.dag(spark, d))


@query(f"WITH {g.trade_sql()}, {g.DAG} SELECT source, count(*) AS n_edges FROM (SELECT 'trade' AS source FROM trade UNION ALL SELECT 'dag' FROM dag) GROUP BY source")
def source_counts_dag(spark: SparkSession, d: str) -> DataFrame:
    """source_counts with the parts that its SQL leaves out."""
    return edges.source_counts(edges.union(trade=g.trade(spark, d), dag=g.dag(spark, d)))


def _months(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return g.trade(spark, d, JAN), g.trade(spark, d, FEB)


@query(f"{BOTH} SELECT src, dst FROM b INTERSECT SELECT src, dst FROM a")
def edges_intersect(spark: SparkSession, d: str) -> DataFrame:
    return edges.common(*_months(spark, d))


@query(f"{BOTH} SELECT src, dst FROM a EXCEPT SELECT src, dst FROM b")
def edges_added(spark: SparkSession, d: str) -> DataFrame:
    return edges.added(*_months(spark, d))


@query(f"{BOTH} SELECT src, dst FROM b EXCEPT SELECT src, dst FROM a")
def edges_removed(spark: SparkSession, d: str) -> DataFrame:
    return edges.removed(*_months(spark, d))


@query(f"{BOTH}, bn AS (SELECT src AS node FROM b UNION SELECT dst FROM b), an AS (SELECT src AS node FROM a UNION SELECT dst FROM a) SELECT coalesce(bn.node, an.node) AS node, CASE WHEN bn.node IS NULL THEN 'added' WHEN an.node IS NULL THEN 'removed' ELSE 'both' END AS status FROM bn FULL JOIN an ON bn.node = an.node")
def node_status_diff(spark: SparkSession, d: str) -> DataFrame:
    return edges.node_status(*_months(spark, d))


@query(f"WITH {g.SMALL} SELECT src, dst FROM small WHERE NOT (src = 'R:ASIA' AND dst = 'N:CHINA') UNION ALL SELECT 'R:AFRICA', 'N:CHINA' UNION ALL SELECT 'N:CHINA', 'X:NEW'")
def whatif_edges(spark: SparkSession, d: str) -> DataFrame:
    pairs = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    return edges.what_if(g.small_dag(spark, d), pairs([("R:AFRICA", "N:CHINA"), ("N:CHINA", "X:NEW")]), pairs([("R:ASIA", "N:CHINA")]))


@query(f"WITH {g.DAG} SELECT src, dst FROM dag WHERE NOT (src = 'R:ASIA' AND dst = 'N:CHINA') UNION ALL SELECT 'R:AFRICA', 'N:CHINA' UNION ALL SELECT 'N:CHINA', 'X:NEW'")
def whatif_edges_dag(spark: SparkSession, d: str) -> DataFrame:
    """whatif_edges with the parts that its SQL leaves out."""
    pairs = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    return edges.what_if(g.dag(spark, d), pairs([("R:AFRICA", "N:CHINA"), ("N:CHINA", "X:NEW")]), pairs([("R:ASIA", "N:CHINA")]))


@query(f"WITH {g.trade_sql()} SELECT sha256('[' || string_agg('{{\"s\":\"' || src || '\",\"d\":\"' || dst || '\"}}', ',' ORDER BY src, dst) || ']') AS fingerprint FROM trade")
def edge_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return g.trade(spark, d).agg(text.edge_set_key(F.col("src"), F.col("dst")).alias("fingerprint"))


# --- counts, degrees, ranks ----------------------------------------------------


@query(f"WITH {g.DAG} SELECT count(DISTINCT node) AS n_nodes FROM (SELECT src AS node FROM dag UNION SELECT dst FROM dag)")
def node_count(spark: SparkSession, d: str) -> DataFrame:
    return edges.nodes(g.dag(spark, d)).agg(F.count("*").alias("n_nodes"))


@query(f"WITH {g.DAG} SELECT (SELECT count(*) FROM (SELECT src FROM dag UNION SELECT dst FROM dag)) AS n_nodes, (SELECT count(*) FROM dag) AS n_edges, 3::BIGINT AS max_depth")
def graph_info(spark: SparkSession, d: str) -> DataFrame:
    return graph.graph_info(g.dag(spark, d))


def _degree(of: str) -> str:
    return f"(SELECT node, count(*) - sum(o) AS n_in, sum(o) AS n_out, count(*) AS n_total, sum(w) AS w_total FROM (SELECT src AS node, 1 AS o, weight AS w FROM {of} UNION ALL SELECT dst, 0, weight FROM {of}) GROUP BY node)"


@query(f"WITH {g.trade_sql()} SELECT node, n_in::BIGINT AS n_in, n_out::BIGINT AS n_out, n_total::BIGINT AS n_total, w_total FROM {_degree('trade')}")
def degrees(spark: SparkSession, d: str) -> DataFrame:
    return graph.degrees(g.trade(spark, d))


@query(f"WITH {g.DAG}, e AS (SELECT *, 1.0 AS weight FROM dag) SELECT node, round(n_out::DOUBLE / n_total, 6) AS fanout FROM {_degree('e')}")
def fanout_ratio(spark: SparkSession, d: str) -> DataFrame:
    return graph.fanout(g.dag(spark, d)).select("node", F.round("fanout", 6).alias("fanout"))


@query(f"WITH {g.trade_sql()} SELECT node, round(w_total / (SELECT sum(weight) FROM trade), 6) AS throughput FROM {_degree('trade')}")
def throughput_share(spark: SparkSession, d: str) -> DataFrame:
    return graph.throughput(g.trade(spark, d)).select("node", F.round("throughput", 6).alias("throughput"))


@query(f"WITH {g.DAG}, e AS (SELECT *, 1 AS weight FROM dag) SELECT node, n_total::BIGINT AS cites FROM {_degree('e')}")
def citations(spark: SparkSession, d: str) -> DataFrame:
    return graph.citations(g.dag(spark, d))


@query(f"WITH {g.DAG}, e AS (SELECT *, 1 AS weight FROM dag) SELECT node, CASE WHEN n_in = 0 THEN 'source' ELSE 'sink' END AS role FROM {_degree('e')} WHERE n_in = 0 OR n_out = 0")
def sources_and_sinks(spark: SparkSession, d: str) -> DataFrame:
    return graph.sources_and_sinks(g.dag(spark, d))


@query(f"WITH {g.DAG}, e AS (SELECT *, 1 AS weight FROM dag) SELECT node, n_total::BIGINT AS cites FROM {_degree('e')} ORDER BY n_total DESC, node LIMIT 10")
def topk_cited(spark: SparkSession, d: str) -> DataFrame:
    return graph.top_cited(g.dag(spark, d), 10)


# --- loops -----------------------------------------------------------------------

_LAYER = f"""WITH RECURSIVE {g.DAG}, l AS (SELECT DISTINCT src AS node, 0::BIGINT AS layer FROM dag WHERE src NOT IN (SELECT dst FROM dag)
  UNION SELECT dag.dst, l.layer + 1 FROM l JOIN dag ON dag.src = l.node), m AS (SELECT node, max(layer) AS layer FROM l GROUP BY node)"""


@query(f"{_LAYER} SELECT node, layer FROM m")
def layers(spark: SparkSession, d: str) -> DataFrame:
    return graph.layers(g.dag(spark, d))[0]


@query(f"{_LAYER} SELECT node, layer, round(layer / (SELECT max(layer) FROM m)::DOUBLE, 6) AS depth FROM m")
def depth(spark: SparkSession, d: str) -> DataFrame:
    return graph.depth(g.dag(spark, d)).select("node", "layer", F.round("depth", 6).alias("depth"))


@query(f"{_LAYER} SELECT node, layer, count(*) OVER (PARTITION BY layer) AS peers, round(1 - 1.0::DOUBLE / count(*) OVER (PARTITION BY layer), 6) AS independence FROM m")
def layer_peers(spark: SparkSession, d: str) -> DataFrame:
    own, _ = graph.layers(g.dag(spark, d))
    return graph.independence(own).select("node", "layer", "peers", F.round("independence", 6).alias("independence"))


@query(f"WITH RECURSIVE {g.SMALL}, r AS (SELECT src, dst FROM small UNION SELECT r.src, small.dst FROM r JOIN small ON small.src = r.dst) SELECT src AS node, count(*) AS n_reach FROM r GROUP BY src")
def reachability_counts(spark: SparkSession, d: str) -> DataFrame:
    return graph.reach_counts(g.small_dag(spark, d))


@query(f"WITH RECURSIVE {g.DAG}, r AS (SELECT src, dst FROM dag UNION SELECT r.src, dag.dst FROM r JOIN dag ON dag.src = r.dst) SELECT src AS node, count(*) AS n_reach FROM r GROUP BY src")
def reachability_counts_dag(spark: SparkSession, d: str) -> DataFrame:
    """reachability_counts with the parts that its SQL leaves out."""
    return graph.reach_counts(g.dag(spark, d))


@query(f"""WITH {g.DAG}, r AS (SELECT * FROM dag WHERE src LIKE 'R:%'), n AS (SELECT * FROM dag WHERE src LIKE 'N:%'), s AS (SELECT * FROM dag WHERE src LIKE 'S:%'),
  p AS (SELECT r.src AS a, r.dst AS b, n.dst AS c, s.dst AS e FROM r LEFT JOIN n ON n.src = r.dst LEFT JOIN s ON s.src = n.dst),
  x AS (SELECT unnest([a, b, c, e]) AS node FROM p) SELECT node, round(count(*)::DOUBLE / (SELECT count(*) FROM p), 6) AS share FROM x WHERE node IS NOT NULL GROUP BY node""")
def path_share(spark: SparkSession, d: str) -> DataFrame:
    return graph.path_share(g.dag(spark, d)).select("node", F.round("share", 6).alias("share"))


@query(f"""WITH RECURSIVE {g.LINK}, e AS (SELECT DISTINCT src AS a, dst AS b FROM link WHERE src <> dst), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  c AS (SELECT a AS node, a AS r FROM u UNION SELECT u.b, c.r FROM c JOIN u ON u.a = c.node) SELECT node, min(r) AS component FROM c GROUP BY node""")
def weak_components(spark: SparkSession, d: str) -> DataFrame:
    return graph.weak_components(g.links(spark, d))


@query(f"""WITH RECURSIVE {g.trade_sql('t', JAN)}, e AS (SELECT src, dst FROM t WHERE src <> dst), r AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON e.src = r.dst),
  n AS (SELECT src AS node FROM e UNION SELECT dst FROM e) SELECT node, EXISTS (SELECT 1 FROM r JOIN r q ON r.dst = node AND r.src = q.src AND q.dst = q.src) OR EXISTS (SELECT 1 FROM r WHERE r.src = node AND r.dst = node) AS stuck FROM n""")
def cycle_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes on or behind a cycle: what no round of peeling reaches."""
    e = edges.drop_self_loops(g.trade(spark, d, JAN))
    free, stuck = graph.layers(e)
    return free.select("node", F.lit(False).alias("stuck")).unionByName(stuck.select("node", F.lit(True).alias("stuck")))


@query()
def acyclic_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.break_cycles(g.trade(spark, d))[0]


@query()
def bfs_prune(spark: SparkSession, d: str) -> DataFrame:
    return graph.prune(g.dag(spark, d), 40)


def _teams(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_regionkey").cast("string").alias("team"), F.col("n_name").alias("member"), F.col("n_nationkey").alias("pos"))


@query("SELECT team, src, dst FROM (SELECT n_regionkey::VARCHAR AS team, n_name AS src, coalesce(lead(n_name) OVER w, first_value(n_name) OVER w) AS dst FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_nationkey)) WHERE src <> dst")
def ring_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.ring(_teams(spark, d))


@query("SELECT a.n_regionkey::VARCHAR AS team, a.n_name AS src, b.n_name AS dst FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name <> b.n_name")
def complete_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.complete(_teams(spark, d))


@query("SELECT n_regionkey::VARCHAR AS team, r_name AS src, n_name AS dst FROM nation JOIN region ON n_regionkey = r_regionkey")
def star_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.star(_teams(spark, d), table(spark, d, "region").select(F.col("r_regionkey").cast("string").alias("team"), F.col("r_name").alias("hub")))


@query("SELECT CASE WHEN i = 0 THEN 'embed' ELSE 'layer_' || (i - 1) END AS src, 'layer_' || i AS dst FROM range(24) t(i) UNION ALL SELECT 'layer_' || i, 'layer_' || (i + k) FROM range(24) t(i), range(2, 5) s(k) WHERE i + k < 24 UNION ALL SELECT 'layer_' || i, 'output' FROM range(24) t(i)")
def layer_chain_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.layer_chain(spark, 24, 4)


# --- joins of parsers ------------------------------------------------------------


@query("SELECT DISTINCT a.p_brand AS src, b.p_brand AS dst FROM part a JOIN part b ON b.p_partkey = a.p_partkey + a.p_size AND a.p_brand <> b.p_brand")
def semi_local_refs(spark: SparkSession, d: str) -> DataFrame:
    """Refs by key (a part's key and size) kept where the target is a known part."""
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_brand")
    refs = p.select(F.col("p_brand").alias("src"), (F.col("p_partkey") + F.col("p_size")).alias("ref"))
    return refs.join(p.select(F.col("p_partkey").alias("ref"), F.col("p_brand").alias("dst")), "ref").where("src <> dst").select("src", "dst").distinct()


@query("SELECT l.lang AS src, count(*) AS n FROM pages JOIN (SELECT DISTINCT lang FROM documents) l ON contains(url, '/' || l.lang || '/') GROUP BY l.lang")
def contains_theta_join(spark: SparkSession, d: str) -> DataFrame:
    lang = table(spark, d, "documents").select("lang").distinct()
    return table(spark, d, "pages").select("url").join(lang, F.contains("url", F.concat(F.lit("/"), "lang", F.lit("/")))).groupBy(F.col("lang").alias("src")).agg(F.count("*").alias("n"))


@query("SELECT s.n_name AS selector, count(*) AS n FROM customer JOIN nation s ON c_nationkey = s.n_nationkey WHERE c_mktsegment = 'BUILDING' GROUP BY s.n_name")
def selector_match(spark: SparkSession, d: str) -> DataFrame:
    """Selectors {nation, segment} against customers' labels: as many equal pairs as a selector has."""
    n = table(spark, d, "nation").select(F.col("n_name").alias("selector"), F.col("n_nationkey").cast("string").alias("k"))
    pairs = n.select("selector", F.explode(F.create_map(F.lit("nation"), F.col("k"), F.lit("segment"), F.lit("BUILDING"))).alias("key", "value"))
    labels = table(spark, d, "customer").select("c_custkey", F.explode(F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit("segment"), F.col("c_mktsegment"))).alias("key", "value"))
    return pairs.join(labels, ["key", "value"]).groupBy("selector", "c_custkey").agg(F.count("*").alias("same")).where("same = 2").groupBy("selector").agg(F.count("*").alias("n"))


_PATHS = "paths AS (SELECT page_id, '/' || regexp_replace(url, '^[a-z]+://[^/]+/?', '') AS p FROM pages), prefixes AS (SELECT DISTINCT unnest(['/en', '/de', '/de/1', '/de/12', '/fr/2', '/fr/20', '/es']) AS x)"


@query(f"WITH {_PATHS} SELECT page_id, max_by(x, length(x)) AS prefix FROM paths JOIN prefixes ON starts_with(p, x) GROUP BY page_id")
def prefix_best_match(spark: SparkSession, d: str) -> DataFrame:
    """The longest known prefix of each path: candidates of the known lengths meet by an equi-join."""
    known = ["/en", "/de", "/de/1", "/de/12", "/fr/2", "/fr/20", "/es"]
    path = F.concat(F.lit("/"), F.regexp_replace("url", r"^[a-z]+://[^/]+/?", ""))
    lengths = F.array(*[F.lit(n) for n in sorted({len(k) for k in known})])
    cand = table(spark, d, "pages").select("page_id", F.explode(F.transform(lengths, lambda n: F.struct(n.alias("n"), F.substr(path, F.lit(1), n).alias("x")))).alias("c")).select("page_id", "c.*")
    return cand.join(spark.createDataFrame([(k, len(k)) for k in known], "x string, n int"), ["x", "n"]).groupBy("page_id").agg(F.max_by("x", "n").alias("prefix"))


@query(f"WITH {g.LINK} SELECT src, dst, count(*) AS n FROM link GROUP BY src, dst")
def link_edges(spark: SparkSession, d: str) -> DataFrame:
    return g.links(spark, d).groupBy("src", "dst").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT o_orderpriority AS src, o_orderstatus AS dst FROM orders")
def text_arrow_edges(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "orders").select("o_orderpriority", "o_orderstatus").distinct().select(F.concat_ws(" → ", "o_orderpriority", "o_orderstatus").alias("value"))
    return arrow_edges(lines)


@query("SELECT doc_id, size, running FROM (SELECT doc_id, least(length(text), 60000) AS size, sum(least(length(text), 60000)) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM documents) WHERE running <= 250000")
def byte_budget_prefix(spark: SparkSession, d: str) -> DataFrame:
    """The first documents that fit the budget together. Partial sums by range of doc_id
    bound what the running sum reads to the ranges before the budget's end."""
    from ..operators.budget import within_budget

    return within_budget(table(spark, d, "documents").select("doc_id", F.least(F.length("text"), F.lit(60000)).cast("long").alias("size")), "doc_id", "size", 250_000)


# --- vectors, risks, drift ---------------------------------------------------------

_VEC = f"WITH RECURSIVE {g.trade_sql('t', JAN)}, {g.vectors_sql('v', 't')}"


@query(f"{_VEC} SELECT node, round(throughput, 6) AS throughput, round(fanout, 6) AS fanout FROM v WHERE fanout < 0.5 AND throughput > 0.05")
def convergence_filter(spark: SparkSession, d: str) -> DataFrame:
    return g.degree_vectors(g.trade(spark, d, JAN)).where("fanout < 0.5 and throughput > 0.05").select("node", F.round("throughput", 6).alias("throughput"), F.round("fanout", 6).alias("fanout"))


@query(f"WITH {g.DAG}, e AS (SELECT *, 1.0 AS weight FROM dag), {g.vectors_sql('v', 'e')} SELECT node, round(throughput, 6) AS throughput, round(fanout, 6) AS fanout FROM v WHERE fanout < 0.3 AND throughput > 0.05")
def convergence_filter_dag(spark: SparkSession, d: str) -> DataFrame:
    """The operator's own limits on all of E_dag; convergence_filter and its SQL are of one month."""
    v = g.degree_vectors(g.dag(spark, d).withColumn("weight", F.lit(1.0)))
    return risks.convergence(v).select("node", F.round("throughput", 6).alias("throughput"), F.round("fanout", 6).alias("fanout"))


@query(f"WITH {g.DAG}, e AS (SELECT *, 1.0 AS weight FROM dag), {g.vectors_sql('v', 'e')} SELECT node, round(fanout, 6) AS fanout FROM v WHERE fanout > 0.6")
def amplification_filter(spark: SparkSession, d: str) -> DataFrame:
    return risks.amplification(g.degree_vectors(g.dag(spark, d).withColumn("weight", F.lit(1.0)))).select("node", F.round("fanout", 6).alias("fanout"))


@query(f"""WITH {g.DAG}, e AS (SELECT *, 1.0 AS weight FROM dag), {g.vectors_sql('v', 'e')},
  m AS (SELECT node, array_to_string(list_filter([CASE WHEN fanout > 0.7 THEN 'spreads to many' END, CASE WHEN criticality > 0.05 THEN 'on many paths' END,
    CASE WHEN throughput > 0.2 THEN 'carries much of the traffic' END, CASE WHEN fanout = 0 THEN 'a deep end point' END], lambda x: x IS NOT NULL), '; ') AS messages FROM v)
  SELECT * FROM m WHERE messages <> ''""")
def insight_rules(spark: SparkSession, d: str) -> DataFrame:
    v = g.degree_vectors(g.dag(spark, d).withColumn("weight", F.lit(1.0)))
    return risks.insights(v.withColumns({"independence": F.lit(0.5), "depth": F.when(F.col("fanout") == 0, 1.0).otherwise(0.5)}))


@query(f"""{_LAYER}, e AS (SELECT *, 1.0 AS weight FROM dag), {g.vectors_sql('v', 'e')},
  r AS (SELECT * FROM dag WHERE src LIKE 'R:%'), n AS (SELECT * FROM dag WHERE src LIKE 'N:%'), s AS (SELECT * FROM dag WHERE src LIKE 'S:%'),
  p AS (SELECT r.src AS a, r.dst AS b, n.dst AS c, s.dst AS z FROM r LEFT JOIN n ON n.src = r.dst LEFT JOIN s ON s.src = n.dst),
  x AS (SELECT unnest([a, b, c, z]) AS node FROM p), share AS (SELECT node, count(*)::DOUBLE / (SELECT count(*) FROM p) AS share FROM x WHERE node IS NOT NULL GROUP BY node),
  k AS (SELECT node, layer / (SELECT max(layer) FROM m)::DOUBLE AS depth, 1 - 1.0::DOUBLE / count(*) OVER (PARTITION BY layer) AS independence FROM m),
  y AS (SELECT node, array_to_string(list_filter([CASE WHEN independence < 0.2 THEN 'no peer at its stage' END, CASE WHEN fanout > 0.7 THEN 'spreads to many' END, CASE WHEN share > 0.05 THEN 'on many paths' END,
    CASE WHEN throughput > 0.2 THEN 'carries much of the traffic' END, CASE WHEN fanout = 0 AND depth > 0.7 THEN 'a deep end point' END], lambda q: q IS NOT NULL), '; ') AS messages FROM v JOIN k USING (node) JOIN share USING (node))
  SELECT * FROM y WHERE messages <> ''""")
def insight_rules_dag(spark: SparkSession, d: str) -> DataFrame:
    """The rules on measured depth, independence and path share; insight_rules and its SQL have constants."""
    e = g.dag(spark, d)
    v = g.degree_vectors(e.withColumn("weight", F.lit(1.0))).drop("criticality")
    own = graph.depth(e)
    v = v.join(own.select("node", "depth"), "node").join(graph.independence(own).select("node", "independence"), "node")
    return risks.insights(v.join(graph.path_share(e).select("node", F.col("share").alias("criticality")), "node"))


#: Risk entries from order priorities: a table with the shape of risks.
_RISK = """risk AS (SELECT c_mktsegment AS node, CASE o_orderpriority WHEN '1-URGENT' THEN 'SINGLE_POINT_OF_FAILURE' WHEN '2-HIGH' THEN 'AMPLIFICATION_RISK' ELSE 'CONVERGENCE_SINK' END AS category,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'warning' ELSE 'info' END AS severity, o_totalprice AS value FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _risks(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("o_orderpriority")
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_totalprice")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("node"))
    return o.join(c, "o_custkey").select(
        "node", F.when(p == "1-URGENT", "SINGLE_POINT_OF_FAILURE").when(p == "2-HIGH", "AMPLIFICATION_RISK").otherwise("CONVERGENCE_SINK").alias("category"),
        F.when(p == "1-URGENT", "critical").when(p == "2-HIGH", "warning").otherwise("info").alias("severity"), F.col("o_totalprice").alias("value"),
    )


@query(f"WITH {_RISK} SELECT severity, count(*) AS n FROM risk GROUP BY severity")
def severity_rollup(spark: SparkSession, d: str) -> DataFrame:
    return risks.severity_counts(_risks(spark, d))


@query(f"WITH {_RISK} SELECT node, min_by(severity, CASE severity WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END) AS severity FROM risk GROUP BY node")
def top_severity_per_node(spark: SparkSession, d: str) -> DataFrame:
    return risks.top_severity(_risks(spark, d))


@query(f"WITH {_RISK} SELECT category, count(*) AS n, string_agg(DISTINCT node, ', ' ORDER BY node) AS nodes FROM risk GROUP BY category")
def report_by_category(spark: SparkSession, d: str) -> DataFrame:
    return risks.by_category_list(_risks(spark, d))


@query(f"WITH {_RISK} SELECT node, count(*) AS n FROM risk WHERE category = 'SINGLE_POINT_OF_FAILURE' GROUP BY node")
def risks_by_category_text(spark: SparkSession, d: str) -> DataFrame:
    return risks.by_category(_risks(spark, d), "Point-of_failure").groupBy("node").agg(F.count("*").alias("n"))


@query(f"WITH {_RISK} SELECT node, category, severity, round(value, 2) AS value FROM risk ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END, value DESC, node LIMIT 20")
def risk_sort_top(spark: SparkSession, d: str) -> DataFrame:
    r = _risks(spark, d)
    return r.orderBy(risks.severity_rank(F.col("severity")), F.desc("value"), "node").limit(20).select("node", "category", "severity", F.round("value", 2).alias("value"))


@query(f"WITH {g.DAG}, {_RISK} SELECT (SELECT count(*) FROM (SELECT src FROM dag UNION SELECT dst FROM dag)) AS n_nodes, (SELECT count(*) FROM dag) AS n_edges, 3::BIGINT AS max_depth, count(*) FILTER (category = 'SINGLE_POINT_OF_FAILURE') AS n_spof, count(*) FILTER (severity = 'warning') AS n_warning, count(*) FILTER (severity = 'info') AS n_info FROM risk")
def kpi_cards(spark: SparkSession, d: str) -> DataFrame:
    e = g.dag(spark, d)
    return risks.kpis(edges.nodes(e), e, _risks(spark, d), graph.layers(e)[0].agg(F.max("layer").alias("max_depth")))


_DIMS = ("criticality", "throughput", "fanout")
_DRIFT = f"""{BOTH}, {g.vectors_sql('vb', 'b')}, {g.vectors_sql('va', 'a')},
w AS (SELECT coalesce(vb.node, va.node) AS node, vb.node IS NULL AS fresh, va.node IS NULL AS gone, """ + ", ".join(f"coalesce(vb.{x}, 0) AS b_{x}, coalesce(va.{x}, 0) AS a_{x}" for x in _DIMS) + " FROM vb FULL JOIN va ON vb.node = va.node)"


def _both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    b, a = _months(spark, d)
    return g.degree_vectors(b), g.degree_vectors(a)


@query(f"{_DRIFT} SELECT * FROM (" + " UNION ALL ".join(f"SELECT node, '{x}' AS dim, round(b_{x}, 4) AS before, round(a_{x}, 4) AS after, round(a_{x} - b_{x}, 4) AS delta, CASE WHEN fresh THEN 'added' WHEN gone THEN 'removed' ELSE 'both' END AS status FROM w WHERE abs(a_{x} - b_{x}) > 1e-6" for x in _DIMS) + ")")
def drift_long(spark: SparkSession, d: str) -> DataFrame:
    return drift.drift(*_both(spark, d), dims=_DIMS)


@query(f"{_DRIFT} SELECT count(*) FILTER (fresh) AS n_added, count(*) FILTER (gone) AS n_removed, count(*) FILTER (NOT fresh AND NOT gone AND greatest({', '.join(f'abs(a_{x} - b_{x})' for x in _DIMS)}) > 0.05) AS n_changed FROM w")
def drift_summary(spark: SparkSession, d: str) -> DataFrame:
    return drift.summary(*_both(spark, d), dims=_DIMS)


@query(f"{_DRIFT} SELECT node, CASE WHEN fresh THEN 'added' WHEN gone THEN 'removed' ELSE 'both' END AS status, round(b_criticality, 3) AS before, round(a_criticality, 3) AS after, {', '.join(f'round(a_{x} - b_{x}, 3) AS delta_{x}' for x in _DIMS)} FROM w ORDER BY abs(a_criticality - b_criticality) DESC, node LIMIT 20")
def drift_top20(spark: SparkSession, d: str) -> DataFrame:
    return drift.top_changes(*_both(spark, d))


@query(f"{_VEC} SELECT CASE WHEN length(node) > 35 THEN substr(node, 1, 32) || '...' ELSE node END AS node, round(throughput, 3) AS throughput, round(criticality, 3) AS criticality, round(fanout, 3) AS fanout FROM v ORDER BY v.criticality DESC, v.node LIMIT 20")
def ranked_table(spark: SparkSession, d: str) -> DataFrame:
    return risks.ranked(g.degree_vectors(g.trade(spark, d, JAN)), 20)


@query(f"WITH {g.trade_sql('t')}, {g.vectors_sql('v', 't')} SELECT CASE WHEN length(node) > 35 THEN substr(node, 1, 32) || '...' ELSE node END AS node, round(throughput, 3) AS throughput, round(criticality, 3) AS criticality, round(fanout, 3) AS fanout FROM v ORDER BY v.criticality DESC, v.node LIMIT 20")
def ranked_table_all(spark: SparkSession, d: str) -> DataFrame:
    """ranked_table without its month."""
    return risks.ranked(g.degree_vectors(g.trade(spark, d)), 20)


@query("""WITH f AS (SELECT user_id FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) ORDER BY n DESC, user_id LIMIT 25), i AS (SELECT event_id, user_id FROM events WHERE event_type = 'error')
  SELECT count(*) AS n_incidents, count(*) FILTER (user_id IN (SELECT user_id FROM f)) AS n_hit, count(DISTINCT user_id) FILTER (user_id IN (SELECT user_id FROM f)) AS n_confirmed,
    round(count(*) FILTER (user_id IN (SELECT user_id FROM f))::DOUBLE / nullif(count(*), 0), 6) AS rate FROM i""")
def flag_hit_rate(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    flagged = ev.groupBy(F.col("user_id").cast("string").alias("node")).agg(F.count("*").alias("n"), F.first("user_id").alias("u")).orderBy(F.desc("n"), "u").limit(25)
    incidents = ev.where("event_type = 'error'").select(F.col("event_id").alias("incident"), F.array(F.col("user_id").cast("string")).alias("entities"))
    return risks.hit_rate(incidents, flagged).select("n_incidents", "n_hit", "n_confirmed", F.round("rate", 6).alias("rate"))


@query()
def streaming_window_edges(spark: SparkSession, d: str) -> DataFrame:
    """The streaming plan over a bounded table."""
    from ..streaming import windowed_edges

    return windowed_edges(g.spans(spark, d), apart="30 days", window="1 day").select(F.col("window.start").alias("start"), "src", "dst", "n")


from . import parsing, reports  # noqa: E402

QUERIES |= parsing.QUERIES | reports.QUERIES
ORACLES |= parsing.ORACLES | reports.ORACLES
