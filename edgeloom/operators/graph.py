"""Graph operators on edge DataFrames: degrees, layers, cycles, reach, paths, pruning.

Loops run on the driver and keep only their frontier; each round's table is
checkpointed in the shared folder, so lineage stays short and a lost executor costs
a re-read. What a round shuffles is linear in the edges at the frontier.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .edges import nodes


def folder(spark) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of this process, on one machine only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="edgeloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """df, checkpointed in that folder."""
    folder(df.sparkSession)
    return df.checkpoint(eager=True)


class RoundsError(RuntimeError):
    """A loop that was given fewer rounds than the graph needs: there is no result."""


def simple(edges: DataFrame) -> DataFrame:
    """Distinct edges without self-loops, weights summed."""
    w = F.sum("weight") if "weight" in edges.columns else F.lit(1.0)
    return edges.where("src <> dst").groupBy("src", "dst").agg(w.alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """(node, n_in, n_out, n_total, w_total): one pass, both ends exploded, combined before the shuffle."""
    w = F.col("weight") if "weight" in edges.columns else F.lit(1.0)
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.lit(0).cast("long").alias("i"), F.lit(1).cast("long").alias("o"), w.alias("w")),
        F.struct(F.col("dst").alias("node"), F.lit(1).cast("long").alias("i"), F.lit(0).cast("long").alias("o"), w.alias("w")),
    )).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"), (F.sum("i") + F.sum("o")).alias("n_total"), F.sum("w").alias("w_total"))


def citations(edges: DataFrame) -> DataFrame:
    return degrees(edges).select("node", F.col("n_total").alias("cites"))


def fanout(edges: DataFrame) -> DataFrame:
    """Out-degree over degree."""
    return degrees(edges).select("node", (F.col("n_out") / F.col("n_total")).alias("fanout"))


def throughput(edges: DataFrame) -> DataFrame:
    """Share of all weight on edges at the node."""
    w = F.col("weight") if "weight" in edges.columns else F.lit(1.0)
    total = edges.agg(F.sum(w).alias("total"))  # one row
    return degrees(edges).crossJoin(F.broadcast(total)).select("node", F.try_divide("w_total", "total").alias("throughput"))


def sources_and_sinks(edges: DataFrame) -> DataFrame:
    """(node, role): source (nothing in) or sink (nothing out)."""
    d = degrees(edges)
    role = F.when(F.col("n_in") == 0, "source").when(F.col("n_out") == 0, "sink")
    return d.select("node", role.alias("role")).where("role is not null")


def top_cited(edges: DataFrame, k: int = 1) -> DataFrame:
    return citations(edges).orderBy(F.desc("cites"), "node").limit(k)


def layers(edges: DataFrame, max_rounds: int = 10_000, small: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(node, layer) by longest path from a source, and the nodes that no round peels
    (on or behind a cycle).

    A counted, small graph goes through one grouped-map task, so a long chain costs no rounds.
    A larger one is peeled: a table holds each node with its edges in that are left, a round
    takes the nodes with none and lowers the others by a join of the front with the edges,
    and each round writes that table once. Too few rounds raise an error."""
    e = kept(simple(edges).select("src", "dst"))
    if e.count() <= (SMALL_EDGES if small is None else small):
        every = kept(e.select(F.lit(0).alias("g"), "src", "dst").groupBy("g").applyInPandas(_layer_rows, "node string, layer long"))
        lone = nodes(edges).join(every, "node", "left_anti")  # nodes with loops only
        every = every.unionByName(lone.withColumn("layer", F.lit(0).cast("long")))
        return every.where("layer >= 0"), every.where("layer < 0").select("node")
    into = e.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("left"))
    state = kept(nodes(edges).join(into, "node", "left").select("node", F.coalesce("left", F.lit(0)).cast("long").alias("left")))
    parts = []
    while not (front := state.where("left = 0")).isEmpty():
        if len(parts) == max_rounds:
            raise RoundsError(f"the longest path has more than {max_rounds} nodes")
        parts.append(front.select("node", F.lit(len(parts)).cast("long").alias("layer")))
        gone = e.join(front.select(F.col("node").alias("src")), "src", "left_semi").groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("gone"))
        state = kept(state.where("left > 0").join(gone, "node", "left").select("node", (F.col("left") - F.coalesce("gone", F.lit(0))).alias("left")))
    stuck = state.select("node")
    if not parts:
        return stuck.limit(0).withColumn("layer", F.lit(0).cast("long")), stuck
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, stuck


def _layer_rows(pdf):
    """(node, layer) of one graph's edges; -1 where no round peels a node."""
    import pandas as pd

    out, into = {}, {}
    for a, b in zip(pdf["src"], pdf["dst"]):
        out.setdefault(a, []).append(b)
        into[b] = into.get(b, 0) + 1
        into.setdefault(a, 0)
    layer, todo = {}, [n for n, k in into.items() if not k]
    layer = dict.fromkeys(todo, 0)
    while todo:
        n = todo.pop()
        for m in out.get(n, ()):
            layer[m] = max(layer.get(m, 0), layer[n] + 1)
            into[m] -= 1
            if not into[m]:
                todo.append(m)
    return pd.DataFrame([(n, layer[n] if not k else -1) for n, k in into.items()], columns=["node", "layer"])


#: Up to so many edges a graph's cycles are broken in one task, beyond it by rounds.
SMALL_EDGES = 200_000


def break_cycles(edges: DataFrame, max_rounds: int = 100_000, small: int = SMALL_EDGES) -> tuple[DataFrame, DataFrame]:
    """(acyclic edges, deleted edges). Nodes without edges in are peeled; on a stall the
    node with the fewest edges left in (then the smallest name) loses those edges.

    A counted, small graph goes through one grouped-map task; a larger one through rounds
    of anti-joins. Both follow the same rule and give the same edges."""
    start = kept(simple(edges))
    if start.count() <= small:
        gone = kept(start.select(F.lit(0).alias("g"), "src", "dst").groupBy("g").applyInPandas(_stall_edges, "src string, dst string"))
    else:
        gone = _break_by_rounds(start, edges, max_rounds)
    return start.join(gone, ["src", "dst"], "left_anti").select("src", "dst", "weight"), gone


def _stall_edges(pdf):
    """The edges that the stall rule deletes, from one graph's edges."""
    import heapq

    import pandas as pd

    into, out = {}, {}
    for a, b in zip(pdf["src"], pdf["dst"]):
        for n in (a, b):
            into.setdefault(n, set()), out.setdefault(n, set())
        into[b].add(a)
        out[a].add(b)
    free = [n for n, x in into.items() if not x]
    stalled = [(len(x), n) for n, x in into.items() if x]
    heapq.heapify(stalled)
    done, gone = set(), []
    while len(done) < len(into):
        while free:
            n = free.pop()
            done.add(n)
            for m in out[n]:
                if n in into[m]:
                    into[m].remove(n)
                    heapq.heappush(stalled, (len(into[m]), m))
                    if not into[m]:
                        free.append(m)
        while stalled:
            k, n = heapq.heappop(stalled)
            if n not in done and k and k == len(into[n]):
                gone += [(a, n) for a in into[n]]
                into[n] = set()
                free.append(n)
                break
    return pd.DataFrame(gone, columns=["src", "dst"])


def _rounds(most: int):
    """As many rounds as allowed, then an error."""
    yield from range(most)
    raise RoundsError(f"more than {most} rounds are needed")


def _break_by_rounds(start: DataFrame, edges: DataFrame, max_rounds: int) -> DataFrame:
    left, todo = start.select("src", "dst"), kept(nodes(edges))
    gone = start.limit(0).select("src", "dst")
    for _ in _rounds(max_rounds):
        front = kept(todo.join(left.select(F.col("dst").alias("node")).distinct(), "node", "left_anti"))
        if front.isEmpty():
            if todo.isEmpty():
                break
            pick = left.groupBy("dst").agg(F.count("*").alias("n")).orderBy("n", "dst").limit(1).select("dst")
            cut = kept(left.join(pick, "dst", "left_semi").select("src", "dst"))
            gone = kept(gone.unionByName(cut))
            left = kept(left.join(cut, ["src", "dst"], "left_anti"))
            continue
        left = kept(left.join(front.select(F.col("node").alias("src")), "src", "left_anti").select("src", "dst"))
        todo = kept(todo.join(front, "node", "left_anti"))
    return gone


def depth(edges: DataFrame) -> DataFrame:
    """(node, layer, depth): layer over the deepest layer, 0 where that is 0."""
    return depth_of(kept(layers(edges)[0]))


def depth_of(own: DataFrame) -> DataFrame:
    """depth() of a graph whose layers are known."""
    most = own.agg(F.max("layer").alias("most"))
    return own.crossJoin(F.broadcast(most)).select("node", "layer", F.coalesce(F.try_divide("layer", "most"), F.lit(0.0)).alias("depth"))


def independence(layered: DataFrame) -> DataFrame:
    """1 - 1 / (nodes of the same layer): counts per layer come back by a join of few rows."""
    peers = layered.groupBy("layer").agg(F.count("*").alias("peers"))
    return layered.join(peers, "layer").select("node", "layer", "peers", (1 - 1 / F.col("peers")).alias("independence"))


def reach(edges: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """(src, dst) for every path of one edge or more: semi-naive rounds, each joining only
    the pairs that the last one found."""
    base = kept(edges.select("src", "dst").distinct())
    step = base.select(F.col("src").alias("mid"), F.col("dst").alias("to"))
    found = new = base
    parts = [base]
    for _ in _rounds(max_rounds):
        grown = new.join(step, new["dst"] == step["mid"]).select("src", F.col("to").alias("dst")).distinct()
        new = kept(grown.join(found, ["src", "dst"], "left_anti"))
        if new.isEmpty():
            break
        parts.append(new)  # each round writes what it found, and only that
        found = found.unionByName(new)
        if len(parts) % 16 == 0:  # a plan over many parts costs more than writing them together
            found = kept(found)
    return found


def reach_counts(edges: DataFrame) -> DataFrame:
    return reach(edges).groupBy("src").agg(F.count("*").alias("n_reach")).withColumnRenamed("src", "node")


def path_share(edges: DataFrame, layered: DataFrame | None = None) -> DataFrame:
    """(node, paths_in, paths_out, share): of all paths from sources to sinks, the share
    through the node. Paths are counted layer by layer, never listed. edges: acyclic;
    layered: their layers, where known.

    Each edge knows the layers of its ends. A layer's counts go along its edges as one small
    table, filed under the layer where they arrive; a layer then reads what was filed under it."""
    spark = edges.sparkSession
    e = kept(simple(edges).select("src", "dst"))
    if layered is None:
        own, stuck = layers(e)
        if not stuck.isEmpty():
            raise ValueError("paths are counted on acyclic graphs; use break_cycles() first")
    else:
        own = layered
    own = kept(own.select("node", "layer"))
    deepest = own.agg(F.max("layer")).first()[0]
    if deepest is None:
        raise ValueError("paths are counted on acyclic graphs; use break_cycles() first")
    at = lambda end: own.select(F.col("node").alias(end), F.col("layer").alias(f"{end}_layer"))
    e = kept(e.join(at("src"), "src").join(at("dst"), "dst"))

    def counts(near: str, far: str, order: list[int]) -> DataFrame:
        # a node's count is the sum of its neighbours', or 1 at an end
        place = f"{folder(spark)}/paths-{uuid.uuid4().hex}"
        parts, filed = [], set()
        for layer in order:
            here = own.where(F.col("layer") == layer).select("node")
            if layer in filed:
                got = spark.read.schema("node string, q double").parquet(f"{place}/to={layer}").groupBy("node").agg(F.sum("q").alias("p"))
                here = here.join(got, "node", "left").select("node", F.coalesce("p", F.lit(1.0)).alias("p"))
            else:
                here = here.withColumn("p", F.lit(1.0))
            here = kept(here)
            parts.append(here)
            out = e.where(F.col(f"{far}_layer") == layer).join(here.withColumnRenamed("node", far), far)
            sums = kept(out.groupBy(F.col(near).alias("node"), F.col(f"{near}_layer").alias("to")).agg(F.sum("p").alias("q")))
            sums.write.partitionBy("to").mode("append").parquet(place)
            filed |= {r["to"] for r in sums.select("to").distinct().collect()}
        done = parts[0]
        for p in parts[1:]:
            done = done.unionByName(p)
        done = kept(done)
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return done

    down = counts("dst", "src", list(range(deepest + 1))).toDF("node", "paths_in")
    up = counts("src", "dst", list(range(deepest, -1, -1))).toDF("node", "paths_out")
    both = kept(down.join(up, "node"))
    total = both.join(sources_and_sinks(e).where("role = 'source'"), "node").agg(F.sum("paths_out").alias("total"))
    return both.crossJoin(F.broadcast(total)).select("node", "paths_in", "paths_out", (F.col("paths_in") * F.col("paths_out") / F.col("total")).alias("share"))


def weak_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest name each node reaches, directions aside."""
    n = nodes(edges)
    e = kept(edges.select("src", "dst").where("src <> dst").distinct())
    both = kept(e.union(e.select("dst", "src")))
    label = kept(n.withColumn("component", F.col("node")))
    while True:
        near = both.join(label.toDF("dst", "c"), "dst").groupBy("src").agg(F.min("c").alias("c"))
        new = label.join(near.withColumnRenamed("src", "node"), "node", "left").select("node", "component", F.least("component", F.coalesce("c", "component")).alias("next"))
        # also jump to the label of one's label: paths halve, so rounds grow with their log
        jump = label.toDF("next", "of")
        new = kept(new.join(jump, "next", "left").select("node", "component", F.least("next", F.coalesce("of", "next")).alias("next")))
        done = new.where("component <> next").isEmpty()
        label = new.select("node", F.col("next").alias("component"))
        if done:
            return label


def prune(edges: DataFrame, max_nodes: int) -> DataFrame:
    """The subgraph induced by at most max_nodes nodes: breadth-first from the most cited
    node, busier neighbours first, names breaking ties. max_nodes is the caller's small
    number; only the nodes kept so far, at most that many, are held."""
    own = edges.select("src", "dst").distinct()
    if max_nodes <= 0 or nodes(own).limit(max_nodes + 1).count() <= max_nodes:
        return own
    own = kept(own)
    cites = kept(citations(own))
    both = own.union(own.select("dst", "src")).toDF("a", "b")
    chosen = kept(top_cited(own, 1).select("node"))
    front, room = chosen, max_nodes - 1
    while room > 0:
        near = both.join(front.toDF("a"), "a", "left_semi").select(F.col("b").alias("node")).distinct().join(chosen, "node", "left_anti")
        front = kept(near.join(cites, "node").orderBy(F.desc("cites"), "node").limit(room).select("node"))
        got = front.count()
        if not got:
            break
        room -= got
        chosen = kept(chosen.unionByName(front))
    return own.join(chosen.toDF("src"), "src", "left_semi").join(chosen.toDF("dst"), "dst", "left_semi")


def ring(members: DataFrame, by: str = "team", name: str = "member", order: str = "pos") -> DataFrame:
    """Each member to the next of its group, the last to the first."""
    w = Window.partitionBy(by).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return members.select(by, F.col(name).alias("src"), F.coalesce(F.lead(name).over(w), F.first(name).over(whole)).alias("dst")).where("src <> dst")


def complete(members: DataFrame, by: str = "team", name: str = "member") -> DataFrame:
    """Every ordered pair of a group's members. The output is that large by definition."""
    a, b = members.select(by, F.col(name).alias("src")), members.select(by, F.col(name).alias("dst"))
    return a.join(b, by).where("src <> dst").distinct()


def star(members: DataFrame, hubs: DataFrame, by: str = "team", name: str = "member", hub: str = "hub") -> DataFrame:
    return members.join(hubs, by).select(by, F.col(hub).alias("src"), F.col(name).alias("dst")).where("src <> dst")


def layer_chain(spark, n_layers: int, span: int = 4) -> DataFrame:
    """A stack of layers: embed, then each to the next, skips within `span`, every one to output."""
    name = lambda c: F.concat(F.lit("layer_"), c.cast("string"))
    i = spark.range(n_layers)
    chain = i.where("id > 0").select(name(F.col("id") - 1).alias("src"), name(F.col("id")).alias("dst"))
    first = i.where("id = 0").select(F.lit("embed").alias("src"), name(F.col("id")).alias("dst"))
    skips = i.select("id", F.explode(F.sequence(F.col("id") + 2, F.col("id") + span)).alias("to")).where(F.col("to") < n_layers).select(name(F.col("id")).alias("src"), name(F.col("to")).alias("dst"))
    out = i.select(name(F.col("id")).alias("src"), F.lit("output").alias("dst"))
    return first.unionByName(chain).unionByName(skips).unionByName(out)


def prunability(vectors: DataFrame) -> DataFrame:
    """criticality * (0.5 + independence), least first: what could go at the least loss."""
    return vectors.select("node", (F.col("criticality") * (0.5 + F.col("independence"))).alias("score")).orderBy("score", "node")


def graph_info(edges: DataFrame) -> DataFrame:
    """One row: n_nodes, n_edges, max_depth (longest path of what can be layered)."""
    own, _ = layers(edges)
    d = own.agg(F.coalesce(F.max("layer"), F.lit(0).cast("long")).alias("max_depth"))
    n = nodes(edges).agg(F.count("*").alias("n_nodes"))
    e = simple(edges).agg(F.count("*").alias("n_edges"))
    return n.crossJoin(e).crossJoin(d)
