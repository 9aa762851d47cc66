"""python -m edgeloom.cli: edges and structural measures of a source tree or edge list.

Exit codes: 0 done, 1 input that can't be used, 2 wrong arguments, 3 a critical risk (with --gate).
--rules names a JSON file: a list of objects with category, severity, condition, value and description.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from .operators import drift, measures, risks
from .sources import from_directory
from .sources.text import parse

DIMS = measures.MEASURES


def load(spark: SparkSession, given: str) -> DataFrame:
    """Edges of a directory, a file with an edge list, or text that is one."""
    if os.path.isdir(given):
        return from_directory(spark, os.path.abspath(given))[0]
    text = open(given, encoding="utf-8").read() if os.path.isfile(given) else given
    pairs, _ = parse(text)
    return spark.createDataFrame(pairs, "src string, dst string")


def document(edges: DataFrame, rules: list[measures.Rule]) -> dict:
    """Edges, measures, risks, counts and seconds as one JSON document."""
    began = time.time()
    m = measures.measures(edges)
    found = risks.sort(measures.apply_rules(m.vectors, rules))
    return {
        "edges": [[r["src"], r["dst"]] for r in edges.select("src", "dst").distinct().orderBy("src", "dst").collect()],
        "metadata": m.info.first().asDict(),
        "vectors": {r["node"]: {d: r[d] for d in measures.MEASURES} for r in m.vectors.orderBy("node").collect()},
        "risks": [r.asDict() for r in found.collect()],
        "seconds": round(time.time() - began, 3),
    }


def read_rules(path: str | None) -> list[measures.Rule]:
    if not path:
        return []
    with open(path, encoding="utf-8") as f:
        return [measures.Rule(**r) for r in json.load(f)]


def table(df: DataFrame) -> str:
    rows = df.collect()
    names = df.columns
    text = [[f"{v:.3f}" if isinstance(v, float) else str(v) for v in r] for r in rows]
    width = [max(map(len, c)) for c in zip(names, *text)]
    return "\n".join("  ".join(v.ljust(w) for v, w in zip(r, width)).rstrip() for r in [names, *text])


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="edgeloom")
    p.add_argument("--path", help="directory or edge-list file")
    p.add_argument("--edges", help="an edge list as text")
    p.add_argument("--before")
    p.add_argument("--after")
    p.add_argument("--json", action="store_true")
    p.add_argument("--document", action="store_true", help="one JSON document with edges, measures, risks and counts")
    p.add_argument("--rules", help="a JSON file of risk rules")
    p.add_argument("--gate", action="store_true", help="exit code 3 if a rule finds a critical risk")
    p.add_argument("--edges-only", action="store_true")
    try:
        a = p.parse_args(argv)
        if not (a.path or a.edges) and not (a.before and a.after):
            p.error("--path, --edges, or --before and --after")
    except SystemExit as e:
        return int(e.code or 0)
    spark = spark or SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false").getOrCreate()
    try:
        if a.before and a.after:
            b, c = (measures.measures(load(spark, x)).vectors for x in (a.before, a.after))
            out = drift.drift(b, c, DIMS).orderBy("node", "dim")
        else:
            e, rules = load(spark, a.path or a.edges), read_rules(a.rules)
            if a.document or a.gate:
                if e.isEmpty():
                    print("no edges", file=sys.stderr)
                    return 1
                found = document(e, rules)
                print(json.dumps(found, ensure_ascii=False))
                return 3 if a.gate and any(r["severity"] == "critical" for r in found["risks"]) else 0
            out = e.select("src", "dst").orderBy("src", "dst") if a.edges_only else risks.ranked(measures.measures(e).vectors)
        if out.isEmpty() and not a.before:
            print("no edges", file=sys.stderr)
            return 1
        print(json.dumps([r.asDict() for r in out.collect()], ensure_ascii=False) if a.json else table(out))
    except (ValueError, TypeError, OSError) as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
