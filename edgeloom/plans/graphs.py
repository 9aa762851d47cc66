"""The graphs that queries run on, from the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spans(spark: SparkSession, d: str) -> DataFrame:
    """Events as spans: the parent is the user's event before."""
    before = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("trace_id"), F.concat(F.lit("e"), "event_id").alias("span_id"),
        F.concat(F.lit("e"), F.lag("event_id").over(before)).alias("parent_id"), F.col("event_type").alias("service"), "ts",
    )


SPAN = """span AS (SELECT event_id, event_type AS dst, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS parent FROM events),
call AS (SELECT e.event_type AS src, s.dst FROM span s JOIN events e ON e.event_id = s.parent WHERE e.event_type <> s.dst)"""


def trade(spark: SparkSession, d: str, month: str | None = None) -> DataFrame:
    """Supplier nation to customer nation, weighted by line items; month: "1995-01".

    Line items shrink to (order, supplier) keys and combine to counts per order and
    nation before they meet orders; the small tables are joined by key."""
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if month:
        start = F.lit(f"{month}-01").cast("timestamp")
        orders = orders.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < F.add_months(start, 1).cast("timestamp")))
    supplier = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("sk"))
    items = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(supplier, "l_suppkey").groupBy("l_orderkey", "sk").agg(F.count("*").alias("w"))
    buyer = orders.join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("ck")), "o_custkey").select(F.col("o_orderkey").alias("l_orderkey"), "ck")
    pairs = items.join(buyer, "l_orderkey").groupBy("sk", "ck").agg(F.sum("w").cast("double").alias("weight"))
    name = lambda key, out: nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(out))
    return pairs.join(name("sk", "src"), "sk").join(name("ck", "dst"), "ck").select("src", "dst", "weight")


def trade_sql(name: str = "trade", month: str | None = None) -> str:
    when = f"WHERE o_orderdate >= TIMESTAMP '{month}-01' AND o_orderdate < TIMESTAMP '{month}-01' + INTERVAL 1 MONTH" if month else ""
    return f"""{name} AS (SELECT sn.n_name AS src, cn.n_name AS dst, count(*)::DOUBLE AS weight FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey {when} GROUP BY 1, 2)"""


def dag(spark: SparkSession, d: str) -> DataFrame:
    """Region to nation to supplier to part; names carry their kind."""
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    region = table(spark, d, "region")
    node = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    a = n.join(region, n["n_regionkey"] == region["r_regionkey"]).select(node("R:", "r_name").alias("src"), node("N:", "n_name").alias("dst"))
    b = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(node("N:", "n_name").alias("src"), node("S:", "s_suppkey").alias("dst"))
    c = table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct().select(node("S:", "l_suppkey").alias("src"), node("P:", "l_partkey").alias("dst"))
    return a.unionByName(b).unionByName(c)


DAG = """dag AS (SELECT 'R:' || r_name AS src, 'N:' || n_name AS dst FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION SELECT 'N:' || n_name, 'S:' || s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION SELECT DISTINCT 'S:' || l_suppkey, 'P:' || l_partkey FROM lineitem)"""


def small_dag(spark: SparkSession, d: str) -> DataFrame:
    """Region to nation to supplier."""
    return dag(spark, d).where(~F.startswith("dst", F.lit("P:")))


SMALL = DAG + ", small AS (SELECT * FROM dag WHERE dst NOT LIKE 'P:%')"


def links(spark: SparkSession, d: str) -> DataFrame:
    """Page host to the hrefs in its html."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1)
    hrefs = F.regexp_extract_all("html", F.lit(r'href="([^"]+)"'), F.lit(1))
    return table(spark, d, "pages").select(host.alias("src"), F.explode(hrefs).alias("dst"))


LINK = """link AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS src, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS dst FROM pages)"""


def degree_vectors(e: DataFrame) -> DataFrame:
    """(node, throughput, fanout, criticality) of a graph; criticality here is the share of in-edges."""
    from ..operators import graph

    d = graph.degrees(e)
    total = e.agg(F.sum("weight").alias("w"), F.count("*").alias("m"))
    return d.crossJoin(F.broadcast(total)).select(
        "node", (F.col("w_total") / F.col("w")).alias("throughput"), (F.col("n_out") / F.col("n_total")).alias("fanout"), (F.col("n_in") / F.col("m")).alias("criticality")
    )


def vectors_sql(name: str, of: str) -> str:
    return f"""{name} AS (SELECT node, sum(w) / (SELECT sum(weight) FROM {of}) AS throughput, sum(o)::DOUBLE / count(*) AS fanout,
  (count(*) - sum(o))::DOUBLE / (SELECT count(*) FROM {of}) AS criticality
  FROM (SELECT src AS node, weight AS w, 1 AS o FROM {of} UNION ALL SELECT dst, weight, 0 FROM {of}) GROUP BY node)"""
