"""Graph documents (JSON) and edge lists in text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EdgeError

# The arrow glyphs and a line with one, and typographic quotes.
ARROW = r"^\s*(\S.*?)\s*(?:->|=>|→|—>|--)\s*(\S.*?)\s*$"
_arrow = re.compile(ARROW)
_quotes = str.maketrans("“”‘’", "\"\"''")


def _pair(x, i: int) -> tuple[str, str]:
    if isinstance(x, dict):
        a = next((x[k] for k in ("source", "src", "from") if x.get(k)), None)
        b = next((x[k] for k in ("target", "tgt", "dst", "to") if x.get(k)), None)
    else:
        a, b = (x[0], x[1]) if isinstance(x, list | tuple) and len(x) >= 2 else (None, None)
    if a in (None, "") or b in (None, ""):
        raise EdgeError(f"edge {i}: two ends are needed")
    return str(a), str(b)


def parse(text: str) -> tuple[list[tuple[str, str]], int]:
    """(edges, lines that hold none): JSON object or array, arrows, or delimited columns."""
    text = text.lstrip("﻿").strip().translate(_quotes)
    if not text:
        raise EdgeError("no input")
    if text[0] in "{[":
        doc = json.loads(text)
        found = doc.get("edges") if isinstance(doc, dict) else doc
        if not isinstance(found, list):
            raise EdgeError("no list of edges")
        return [_pair(x, i) for i, x in enumerate(found)], 0
    lines = text.splitlines()
    arrows = [m.groups() for m in map(_arrow.match, lines) if m]
    if arrows:
        return [(a.strip().rstrip(",;"), b.strip().rstrip(",;")) for a, b in arrows], len(lines) - len(arrows)
    rows = [x.strip() for x in lines if x.strip() and not x.lstrip().startswith("#")]
    head = bool(rows) and re.match(r"(from|source)[,\t]", rows[0], re.I) is not None
    sample = rows[1 if head and len(rows) > 1 else 0] if rows else ""
    delimiter = next((d for d in ",\t|;" if d in sample), ",")
    out = [[c.strip() for c in r.split(delimiter)] for r in rows[head:]]
    if not out or any(len(r) < 2 for r in out):
        raise EdgeError("two columns are needed in every line")
    return [(r[0], r[1]) for r in out], 0


def text_edges(table: DataFrame, strict: bool = True) -> DataFrame:
    """(path, src, dst, ord, rejected) of a table (path, content), each row one edge list."""

    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    edges, rejected = parse(content)
                except ValueError:
                    if strict:
                        raise
                    continue
                rows += [(path, a, b, i, rejected) for i, (a, b) in enumerate(edges)]
            yield pd.DataFrame(rows, columns=["path", "src", "dst", "ord", "rejected"])

    return table.select("path", "content").mapInPandas(run, "path string, src string, dst string, ord long, rejected long")


def arrow_edges(lines: DataFrame, column: str = "value") -> DataFrame:
    """Arrow lines of a line table by built-in functions: the path for large inputs."""
    ends = [F.rtrim(F.regexp_extract(column, ARROW, i), F.lit(",;")).alias(n) for i, n in ((1, "src"), (2, "dst"))]
    return lines.where(F.regexp_like(F.col(column), F.lit(ARROW))).select(*ends)


def graph_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, src, dst, ord, rejected) of JSON graph files: an object with edges, or an array."""
    raw = spark.read.format("binaryFile").load(path).select("path", F.col("content").cast("string").alias("content"))
    return text_edges(raw)
