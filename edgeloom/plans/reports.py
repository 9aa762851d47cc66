"""Queries over measured vectors, risk entries, live pages and scalar functions, each with its SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import drift, edges, measures, risks
from ..sources import live
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


# --- risk entries --------------------------------------------------------------

RISK = """risk AS (SELECT c_mktsegment AS node, CASE o_orderpriority WHEN '1-URGENT' THEN 'SINGLE_POINT_OF_FAILURE' WHEN '2-HIGH' THEN 'AMPLIFICATION_RISK' ELSE 'CONVERGENCE_SINK' END AS category,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'warning' ELSE 'info' END AS severity, o_totalprice AS value, year(o_orderdate) AS y FROM orders JOIN customer ON o_custkey = c_custkey)"""
_RANK = "CASE severity WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END"


def entries(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("o_orderpriority")
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("y"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("node"))
    return o.join(c, "o_custkey").select(
        "node", F.when(p == "1-URGENT", "SINGLE_POINT_OF_FAILURE").when(p == "2-HIGH", "AMPLIFICATION_RISK").otherwise("CONVERGENCE_SINK").alias("category"),
        F.when(p == "1-URGENT", "critical").when(p == "2-HIGH", "warning").otherwise("info").alias("severity"), F.col("o_totalprice").alias("value"), "y",
    )


@query(f"WITH {RISK} SELECT node, count(*) AS n FROM risk WHERE severity = 'critical' GROUP BY node")
def risks_by_severity(spark: SparkSession, d: str) -> DataFrame:
    return risks.by_severity(entries(spark, d), "critical").groupBy("node").agg(F.count("*").alias("n"))


@query(f"WITH {RISK} SELECT category, count(*) AS n FROM risk WHERE node = 'BUILDING' GROUP BY category")
def risks_of_node(spark: SparkSession, d: str) -> DataFrame:
    return risks.of_node(entries(spark, d), "BUILDING").groupBy("category").agg(F.count("*").alias("n"))


@query(f"""WITH {RISK} SELECT category, CASE category {" ".join(f"WHEN '{k}' THEN '{v} '" for k, v in risks.ACTIONS.items())} ELSE 'look at ' END || string_agg(DISTINCT node, ', ' ORDER BY node) AS action FROM risk GROUP BY category""")
def action_list(spark: SparkSession, d: str) -> DataFrame:
    return risks.actions(entries(spark, d))


@query(f"WITH {RISK} SELECT node, round(value, 2) AS value FROM risk ORDER BY risk.value DESC, node, category LIMIT 20")
def risk_sort_by_value(spark: SparkSession, d: str) -> DataFrame:
    return risks.sort(entries(spark, d), "value", descending=True).limit(20).select("node", F.round("value", 2).alias("value"))


@query(f"""WITH {RISK}, b AS (SELECT node, count(*) AS n FROM risk WHERE y = 1995 GROUP BY node), a AS (SELECT node, count(*) AS n FROM risk WHERE y = 1996 GROUP BY node)
  SELECT coalesce(b.node, a.node) AS node, coalesce(b.n, 0) AS n_before, coalesce(a.n, 0) AS n_after, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta FROM b FULL JOIN a ON a.node = b.node""")
def risk_delta(spark: SparkSession, d: str) -> DataFrame:
    r = entries(spark, d)
    return drift.risk_changes(r.where("y = 1995"), r.where("y = 1996"))


@query(f"WITH {RISK} SELECT bool_or(severity = 'critical') AS fails FROM risk")
def risk_gate(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(risks.has_critical(entries(spark, d)),)], "fails boolean")


@query(f"WITH {RISK} SELECT '25 nodes, 7 edges, depth 3; ' || count(*) FILTER (severity = 'critical') || ' critical, ' || count(*) FILTER (severity = 'warning') || ' warning, ' || count(*) FILTER (severity = 'info') || ' info' AS text FROM risk")
def headline_text(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(risks.headline(25, 7, 3, entries(spark, d)),)], "text string")


#: A risk for each nation: few enough for a text.
FEW = """few AS (SELECT n_name AS node, CASE n_nationkey % 4 WHEN 0 THEN 'SINGLE_POINT_OF_FAILURE' WHEN 1 THEN 'DEEP_BOTTLENECK' ELSE 'CONVERGENCE_SINK' END AS category,
  CASE n_nationkey % 4 WHEN 0 THEN 'critical' WHEN 1 THEN 'warning' WHEN 2 THEN 'info' ELSE 'unknown' END AS severity, 'in region ' || n_regionkey AS description, n_nationkey / 8.0 AS value FROM nation)"""


def few(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey") % 4
    return table(spark, d, "nation").select(
        F.col("n_name").alias("node"), F.when(k == 0, "SINGLE_POINT_OF_FAILURE").when(k == 1, "DEEP_BOTTLENECK").otherwise("CONVERGENCE_SINK").alias("category"),
        F.when(k == 0, "critical").when(k == 1, "warning").when(k == 2, "info").otherwise("unknown").alias("severity"),
        F.concat(F.lit("in region "), F.col("n_regionkey").cast("string")).alias("description"), (F.col("n_nationkey") / 8).alias("value"),
    )


@query(f"""WITH {FEW}, x AS (SELECT *, CASE WHEN severity IN ('critical', 'warning') THEN severity ELSE 'info' END AS s FROM few),
  b AS (SELECT s, {_RANK.replace("severity", "s")} AS r, '### ' || upper(s[1]) || s[2:] || ' (' || count(*) || ')' || chr(10) ||
    string_agg('- **' || node || '**: ' || lower(replace(category, '_', ' ')) || ' (' || printf('%.3f', value::DOUBLE) || ')', chr(10) ORDER BY node, category) AS t FROM x GROUP BY s)
  SELECT string_agg(t, chr(10) || chr(10) ORDER BY r) AS text FROM b""")
def markdown_text(spark: SparkSession, d: str) -> DataFrame:
    """Unknown severities count as info."""
    return spark.createDataFrame([(risks.markdown(few(spark, d)),)], "text string")


@query(f"""WITH {FEW}, c AS (SELECT category, min({_RANK}) AS r, upper(replace(category, '_', ' ')) || ' (' || count(*) || ')' || chr(10) ||
    string_agg('  [' || severity || '] ' || node || ': ' || description || ' (' || printf('%.3f', value::DOUBLE) || ')', chr(10) ORDER BY {_RANK}, value DESC, node) || chr(10) AS t,
    '  - ' || CASE category {" ".join(f"WHEN '{k}' THEN '{v} '" for k, v in risks.ACTIONS.items())} END || string_agg(DISTINCT node, ', ' ORDER BY node) AS a FROM few GROUP BY category)
  SELECT 'Structural risks: ' || (SELECT count(*) FROM few) || chr(10) || chr(10) || string_agg(t, chr(10) ORDER BY r, category) || chr(10) || 'What to do' || chr(10) || string_agg(a, chr(10) ORDER BY category) || chr(10) || chr(10) ||
    (SELECT count(*) FILTER (severity = 'critical') || ' critical, ' || count(*) FILTER (severity = 'warning') || ' warning, ' || count(*) FILTER (severity NOT IN ('critical', 'warning')) || ' info' FROM few) AS text FROM c""")
def report_text(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(risks.report(few(spark, d)),)], "text string")


@query(f"WITH {FEW} SELECT '{{\"node\":\"' || node || '\",\"category\":\"' || category || '\",\"severity\":\"' || severity || '\",\"description\":\"' || description || '\",\"value\":' || value::DOUBLE || '}}' AS json FROM few")
def risk_json(spark: SparkSession, d: str) -> DataFrame:
    return risks.to_json(few(spark, d))


# --- vectors --------------------------------------------------------------------

TRADE = f"WITH {g.trade_sql('t')}, {g.vectors_sql('v', 't')}"


@query(f"""{TRADE}, {FEW}, f AS (SELECT node FROM few WHERE node IN (SELECT node FROM v) ORDER BY {_RANK}, node LIMIT 5)
  SELECT node, round(throughput, 6) AS throughput, round(fanout, 6) AS fanout FROM v WHERE node IN (SELECT node FROM f)""")
def radar_nodes(spark: SparkSession, d: str) -> DataFrame:
    return risks.radar(few(spark, d), g.degree_vectors(g.trade(spark, d)), 5).select("node", F.round("throughput", 6).alias("throughput"), F.round("fanout", 6).alias("fanout"))


_BAR = lambda name, c: f"printf('%-14s', '{name}') || repeat('█', floor({c} * 20)::INT) || repeat('░', 20 - floor({c} * 20)::INT) || ' ' || printf('%.3f', round({c}, 3))"


@query(f"{TRADE} SELECT node, {' || chr(10) || '.join(_BAR(x, x) for x in ('throughput', 'criticality', 'fanout'))} AS card FROM v")
def node_cards(spark: SparkSession, d: str) -> DataFrame:
    return risks.cards(g.degree_vectors(g.trade(spark, d)))


def measures_sql(name: str, of: str) -> str:
    """All measures of an acyclic graph `of` (src, dst) by listing its paths; needs WITH RECURSIVE."""
    n = name
    return f"""{n}_n AS (SELECT src AS node FROM {of} UNION SELECT dst FROM {of}),
{n}_q AS (SELECT node, [node] AS p FROM {n}_n WHERE node NOT IN (SELECT dst FROM {of}) UNION ALL SELECT e.dst, list_append(q.p, e.dst) FROM {n}_q q JOIN {of} e ON e.src = q.node),
{n}_l AS (SELECT node, max(len(p)) - 1 AS layer FROM {n}_q GROUP BY node),
{n}_full AS (SELECT p FROM {n}_q WHERE node NOT IN (SELECT src FROM {of})),
{n}_s AS (SELECT node, count(*)::DOUBLE / (SELECT count(*) FROM {n}_full) AS share FROM (SELECT unnest(p) AS node FROM {n}_full) GROUP BY node),
{n}_d AS (SELECT node, count(*) AS n_total, sum(o) AS n_out FROM (SELECT src AS node, 1 AS o FROM {of} UNION ALL SELECT dst, 0 FROM {of}) GROUP BY node),
{n} AS (SELECT node, layer, layer / (SELECT max(layer) FROM {n}_l)::DOUBLE AS depth, 1 - 1.0::DOUBLE / count(*) OVER (PARTITION BY layer) AS independence,
  n_total::DOUBLE / (SELECT count(*) FROM {of}) AS throughput, share AS criticality, n_out::DOUBLE / n_total AS fanout FROM {n}_l JOIN {n}_s USING (node) JOIN {n}_d USING (node))"""


_ALL = f"WITH RECURSIVE {g.DAG}, {measures_sql('v', 'dag')}"
_ROUND = ", ".join(f"round({x}, 6) AS {x}" for x in measures.MEASURES)


@query(f"{_ALL} SELECT node, layer::BIGINT AS layer, {_ROUND} FROM v")
def measures_dag(spark: SparkSession, d: str) -> DataFrame:
    """Every measure in one call."""
    return measures.measures(g.dag(spark, d)).vectors.select("node", "layer", *[F.round(x, 6).alias(x) for x in measures.MEASURES])


@query(f"{_ALL} SELECT (SELECT count(*) FROM v) AS n_nodes, (SELECT count(*) FROM dag) AS n_edges, (SELECT max(layer) FROM v)::BIGINT AS max_depth")
def measures_info(spark: SparkSession, d: str) -> DataFrame:
    return measures.measures(g.dag(spark, d)).info


#: Rules with limits of the caller's own.
RULES = [
    measures.Rule("SINGLE_POINT_OF_FAILURE", "critical", "independence < 0.9 AND criticality > 0.1", "criticality", "few peers, many paths"),
    measures.Rule("AMPLIFICATION_RISK", "warning", "fanout > 0.9 AND throughput > 0.01", "fanout"),
    measures.Rule("CONVERGENCE_SINK", "info", "fanout = 0 AND throughput > 0.0005", "throughput"),
]
_RULES = lambda of: " UNION ALL ".join(f"SELECT node, '{r.category}' AS category, '{r.severity}' AS severity, '{r.description}' AS description, round({r.value}, 6) AS value FROM {of} WHERE {r.condition}" for r in RULES)


@query(f"{_ALL} {_RULES('v')}")
def rule_risks(spark: SparkSession, d: str) -> DataFrame:
    return measures.apply_rules(measures.measures(g.dag(spark, d)).vectors, RULES).withColumn("value", F.round("value", 6))


@query(f"{_ALL} SELECT node, round(criticality * (0.5 + independence), 6) AS score FROM v")
def prunability_scores(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.graph import prunability

    return prunability(measures.measures(g.dag(spark, d)).vectors).select("node", F.round("score", 6).alias("score"))


ADD, REMOVE = [("R:AFRICA", "N:CHINA"), ("N:CHINA", "X:NEW"), ("X:NEW", "X:LAST")], [("R:ASIA", "N:CHINA")]
_EDIT = f"""WITH RECURSIVE {g.SMALL}, edited AS (SELECT src, dst FROM small WHERE NOT (src = 'R:ASIA' AND dst = 'N:CHINA') UNION SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in ADD)})),
{measures_sql('b', 'small')}, {measures_sql('a', 'edited')}"""


def _simulated(spark: SparkSession, d: str) -> measures.Compared:
    pairs = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    return measures.simulate(g.small_dag(spark, d), pairs(ADD), pairs(REMOVE), RULES)


@query(_EDIT + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT coalesce(b.node, a.node) AS node, '{x}' AS dim, round(coalesce(b.{x}, 0), 4) AS before, round(coalesce(a.{x}, 0), 4) AS after, round(coalesce(a.{x}, 0) - coalesce(b.{x}, 0), 4) AS delta, "
    f"CASE WHEN b.node IS NULL THEN 'added' WHEN a.node IS NULL THEN 'removed' ELSE 'both' END AS status FROM b FULL JOIN a ON a.node = b.node WHERE abs(coalesce(a.{x}, 0) - coalesce(b.{x}, 0)) > 1e-6" for x in measures.MEASURES) + ")")  # fmt: skip
def simulated_drift(spark: SparkSession, d: str) -> DataFrame:
    """What an edit changes, each graph measured once."""
    return _simulated(spark, d).drift


@query(f"{_EDIT}, rb AS ({_RULES('b')}), ra AS ({_RULES('a')}) SELECT 'new' AS kind, * FROM ra WHERE (node, category) NOT IN (SELECT node, category FROM rb) UNION ALL SELECT 'gone', * FROM rb WHERE (node, category) NOT IN (SELECT node, category FROM ra)")
def simulated_risks(spark: SparkSession, d: str) -> DataFrame:
    c = _simulated(spark, d)
    out = c.new_risks.select(F.lit("new").alias("kind"), "*").unionByName(c.gone_risks.select(F.lit("gone").alias("kind"), "*"))
    return out.withColumn("value", F.round("value", 6))


@query(f"""WITH RECURSIVE {g.SMALL}, r AS (SELECT src, dst FROM small UNION SELECT r.src, small.dst FROM r JOIN small ON small.src = r.dst), n AS (SELECT src AS node FROM small UNION SELECT dst FROM small)
  SELECT n.node, count(r.src) AS n_reached_by, round(count(r.src)::DOUBLE / ((SELECT count(*) FROM n) - 1), 6) AS mean_reach FROM n LEFT JOIN r ON r.dst = n.node GROUP BY n.node""")
def mean_reach(spark: SparkSession, d: str) -> DataFrame:
    return measures.mean_reach(g.small_dag(spark, d)).withColumn("mean_reach", F.round("mean_reach", 6))


# --- shapes and scalar functions ---------------------------------------------------


@query("""SELECT coalesce(nullif(CASE WHEN n_nationkey % 3 = 0 THEN n_name END, ''), CASE WHEN n_nationkey % 3 = 1 THEN n_name END, CASE WHEN n_nationkey % 3 = 2 THEN n_name END) AS src, n_regionkey::VARCHAR AS dst,
  CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey::DOUBLE ELSE 1.0 END AS weight FROM nation WHERE n_nationkey <> 7""")
def records_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Records whose ends stand under one of several names, one of them blank."""
    k = F.col("n_nationkey")
    r = table(spark, d, "nation").select(
        F.when(k == 7, "").when(k % 3 == 0, F.col("n_name")).alias("src"), F.when((k % 3 == 1) & (k != 7), F.col("n_name")).alias("source"), F.when(k % 3 == 2, F.col("n_name")).alias("from"),
        F.col("n_regionkey").alias("target"), F.when(k % 2 == 0, k.cast("double")).alias("weight"),
    )
    return edges.normalize(r, strict=False).select("src", "dst", "weight")


@query("""SELECT p_partkey, list_slice(string_split(x, '.'), 1, 2)[1] || '.' || list_slice(string_split(x, '.'), 1, 2)[2] AS first_two, string_split(x, '.')[-1] AS last_one,
  'src.' || replace(replace(p_name, ' ', '_'), '/', '.') AS module, upper(replace('A_B_' || p_brand, '_', ' ')) AS label, CASE WHEN length(p_type || p_name || p_brand) > 35 THEN substr(p_type || p_name || p_brand, 1, 32) || '...' ELSE p_type || p_name || p_brand END AS short,
  p_size % 3 = 0 AS zero FROM (SELECT *, p_brand || '.' || p_size || '.x' || p_partkey AS x FROM part)""")
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    """Dotted names, module paths, labels, cut names and empty span ids."""
    x = F.concat_ws(".", "p_brand", F.col("p_size").cast("string"), F.concat(F.lit("x"), F.col("p_partkey").cast("string")))
    tail = F.when(F.col("p_partkey") % 2 == 0, ".py").otherwise("/__init__.py")
    span = F.when(F.col("p_size") % 6 == 0, "0000000000000000").when(F.col("p_size") % 3 == 0, "AAAAAAAAAAA=").otherwise("00f0")
    return table(spark, d, "part").select(
        "p_partkey", text.dotted_rollup(x, 2).alias("first_two"), text.dotted_rollup(x, None).alias("last_one"), text.module_name(F.concat(F.lit("src/"), F.replace("p_name", F.lit(" "), F.lit("_")), tail)).alias("module"),
        text.category_label(F.concat(F.lit("A_B_"), "p_brand")).alias("label"), text.short(F.concat("p_type", "p_name", "p_brand")).alias("short"), text.zero_id(span).alias("zero"),
    )


# --- live services ------------------------------------------------------------------
# The transport answers as the service does, from rows of small tables.


def _fed(source: type[live.LiveSource], pages: list[dict], by_cursor) -> type[live.LiveSource]:
    def send(method: str, url: str, headers: dict, body: str | None) -> tuple[int, str]:
        return 200, json.dumps(by_cursor(pages, url, body))

    return type(source.__name__, (source,), {"transport": staticmethod(send)})


@query("SELECT DISTINCT a.n_name AS src, b.n_name AS dst FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey * 7 + 3) % 29 AND a.n_name <> b.n_name")
def live_dynatrace(spark: SparkSession, d: str) -> DataFrame:
    """Two pages of services; calls to keys over 24 point nowhere."""
    rows = table(spark, d, "nation").orderBy("n_nationkey").limit(100).collect()  # a transport's few rows
    found = [{"entityId": f"S-{r['n_nationkey']}", "displayName": r["n_name"], "fromRelationships": {"calls": [{"id": f"S-{(r['n_nationkey'] * 7 + 3) % 29}"}]}} for r in rows]
    pages = [{"entities": found[:10], "nextPageKey": "more"}, {"entities": found[10:]}]
    return live.from_dynatrace(spark, "https://x", "t", source=_fed(live.Dynatrace, pages, lambda p, url, body: p["nextPageKey=more" in url]))


_TREE = "WITH t AS (SELECT n_nationkey AS k, n_name AS name, CASE WHEN n_nationkey > 0 THEN (n_nationkey - 1) // 2 END AS parent FROM nation) SELECT DISTINCT p.name AS src, t.name AS dst FROM t JOIN t p ON p.k = t.parent"


@query(_TREE)
def live_honeycomb(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation").orderBy("n_nationkey").limit(100).collect()
    found = [{"data": {"trace.span_id": f"s{r['n_nationkey']}", "trace.parent_id": f"s{(r['n_nationkey'] - 1) // 2}" if r["n_nationkey"] else None, "service.name": r["n_name"]}} for r in rows]
    answer = {"id": "q", "complete": True, "data": {"results": found}}
    return live.from_honeycomb(spark, "set", "k", source=_fed(live.Honeycomb, [answer], lambda p, url, body: p[0])).select("src", "dst")


@query(_TREE)
def live_datadog(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation").orderBy("n_nationkey").limit(100).collect()
    found = [{"id": f"s{r['n_nationkey']}", "attributes": {"span_id": f"s{r['n_nationkey']}", "parent_id": f"s{(r['n_nationkey'] - 1) // 2}" if r["n_nationkey"] else None, "service": r["n_name"]}} for r in rows]
    pages = [{"data": found[:12], "meta": {"page": {"after": "more"}}}, {"data": found[12:], "meta": {}}]
    return live.from_datadog(spark, "a", "b", source=_fed(live.Datadog, pages, lambda p, url, body: p["more" in (body or "")])).select("src", "dst")
