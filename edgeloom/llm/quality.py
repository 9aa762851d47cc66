"""Quality rules (4): a decision list learned by sequential covering.

Text statistics are counted over every whole text in one Arrow-batched pass. The
rules come from labelled rows: each is grown as a conjunction of threshold
conditions by information gain, pruned on rows set aside, and kept while it stays
precise; the rows it covers leave, and the next is grown. The list becomes one
ordered Spark `CASE WHEN`, so judging needs no Python.

Defined cases: null text counts as no words; rows repeated judge alike; an empty
table gives an empty result; without usable labels there are no rules and only the
base limits judge; columns of the input with clashing names are untouched, as the
statistics live in one struct column.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

STATS = "__edgeloom_stats"
#: Labelled rows used to learn the list, the smallest by a hash of their id.
TRAIN_ROWS = 20_000
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marks long, n_distinct long, top_word long"

_UPPER = bytes(range(65, 91))


def text_stats(text: str | None) -> tuple[int, ...]:
    """The counts of SCHEMA for one text."""
    b = (text or "").encode("utf-8", "replace")
    w = b.split()
    n = len(w)
    if not n:
        return (0, 0, len(b) - len(b.translate(None, b"#*$%&|<>")), 0, 0, 0, 0, 0, 0, 0)
    spaces = len(b) - sum(map(len, w))
    symbols = len(b) - len(b.translate(None, b"#*$%&|<>"))
    lines = [x for x in b.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeated = 0
    if n >= 3:
        tri = list(zip(w, w[1:], w[2:]))
        if len(set(tri)) < len(tri):
            seen, last = Counter(tri), -1
            for i, key in enumerate(tri):
                if seen[key] > 1:
                    repeated += i + 3 - max(i, last + 1)
                    last = i + 2
    freq = Counter(w)
    return (n, len(text) - spaces, symbols, dup, repeated, len(lines), len(b) - len(b.translate(None, _UPPER)),
            len(b) - len(b.translate(None, b"!?.,;:")), len(freq), max(freq.values()))


def _stats(text: pd.Series) -> pd.DataFrame:
    rows = [text_stats(t if isinstance(t, str) else None) for t in text]
    return pd.DataFrame(rows, columns=[x.split()[0] for x in SCHEMA.split(", ")], dtype="int64")


_stats.__annotations__ = {"text": pd.Series, "return": pd.DataFrame}


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs and the struct column STATS; only the text goes through Python."""
    ship(docs.sparkSession)
    return docs.withColumn(STATS, F.pandas_udf(_stats, SCHEMA)(F.col(text)))


def _ratio(a: str, b: str) -> Column:
    return F.col(f"{STATS}.{a}") / F.greatest(F.col(f"{STATS}.{b}"), F.lit(1)).cast("double")


#: What rules may test.
FEATURES = {
    "n_words": lambda: F.col(f"{STATS}.n_words").cast("double"),
    "mean_word": lambda: _ratio("word_chars", "n_words"),
    "symbol_ratio": lambda: _ratio("n_symbols", "word_chars"),
    "dup_line_ratio": lambda: _ratio("n_dup_lines", "n_lines"),
    "repeat_ratio": lambda: _ratio("n_repeat_words", "n_words"),
    "upper_ratio": lambda: _ratio("n_upper", "word_chars"),
    "mark_ratio": lambda: _ratio("n_marks", "word_chars"),
    "distinct_ratio": lambda: _ratio("n_distinct", "n_words"),
    "top_word_ratio": lambda: _ratio("top_word", "n_words"),
}


def base_failed() -> Column:
    n = F.col(f"{STATS}.n_words")
    return (n < 50) | (100 * F.col(f"{STATS}.n_repeat_words") > 50 * n)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def column(self) -> Column:
        f = FEATURES[self.feature]()
        return f >= F.lit(self.limit) if self.above else f <= F.lit(self.limit)

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.limit if self.above else x[self.feature] <= self.limit

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.limit:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int = 4, cuts: int = 48) -> Rule:
    """Add the condition of the largest FOIL gain until only bad rows are covered."""
    rule: Rule = ()
    on = np.ones(len(bad), bool)
    while len(rule) < most:
        p0, n0 = int(bad[on].sum()), int((~bad[on]).sum())
        if not p0 or not n0:
            break
        best, gain = None, 1e-9
        for name, values in x.items():
            v, y = values[on], bad[on]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            edges = np.unique(np.searchsorted(v, np.unique(np.concatenate([np.quantile(v, np.linspace(0, 1, cuts)), np.quantile(v[y], np.linspace(0, 1, cuts))]))))
            total = np.concatenate([[0], np.cumsum(y)])
            for e in edges[(edges > 0) & (edges < len(v))]:
                if v[e] == v[e - 1]:
                    continue
                cut = float((v[e] + v[e - 1]) / 2)
                for above, p, size in ((True, p0 - total[e], len(v) - e), (False, total[e], e)):
                    if p and (g := p * (math.log2(p / size) - math.log2(p0 / (p0 + n0)))) > gain:
                        best, gain = Condition(name, above, cut), g
        if best is None:
            break
        rule += (best,)
        on &= best.holds(x)
    return rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, held: np.ndarray, most: int = 12, precision: float = 0.9, least: int = 3) -> list[Rule]:
    """Sequential covering: rules in order, each a conjunction that marks bad rows.
    held: rows on which a grown rule is pruned and its precision measured."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < most:
        g, h = left & ~held, left & held
        if bad[g].sum() < least:
            break
        rule = _grow({k: v[g] for k, v in x.items()}, bad[g])
        if not rule:
            break
        part, y = {k: v[h] for k, v in x.items()}, bad[h]

        def worth(r: Rule) -> float:
            on = _covers(r, part, len(y))
            p, n = int(y[on].sum()), int((~y[on]).sum())
            return (p - n) / (p + n + 1)

        rule = max((rule[: i + 1] for i in range(len(rule))), key=worth)
        on = _covers(rule, x, len(bad)) & left
        p, n = int(bad[on].sum()), int((~bad[on]).sum())
        hp, hn = int(bad[on & held].sum()), int((~bad[on & held]).sum())
        if p < least or p < precision * (p + n) or hp < precision * (hp + hn):
            break
        rules.append(rule)
        left &= ~on
    return rules


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> list[Rule]:
    """Learn the list from at most train_rows labelled rows (quality 0 or 1)."""
    spark = docs.sparkSession
    own = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).toPandas()
    if not len(picked):
        return []
    chosen = spark.createDataFrame([(int(i), int(q)) for i, q in picked.itertuples(index=False)], "__id long, __quality int")
    rows = with_stats(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id"), "__text")
    # limits apply after collecting: a filter on the statistics would be pushed below the join
    got = rows.select("__id", "__quality", base_failed().alias("__failed"), *[f().alias(k) for k, f in FEATURES.items()]).toPandas()
    got = got[~got["__failed"]]
    if not len(got):
        return []
    got = got.sort_values(["__id"], kind="stable")
    return learn({k: got[k].to_numpy(float) for k in FEATURES}, got["__quality"].to_numpy() == 0, (got["__id"].to_numpy() // 7) % 3 == 0)


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional expression: false for the first rule that fits."""
    out = None
    for rule in rules:
        fits = functools.reduce(lambda a, b: a & b, [c.column() for c in rule])
        out = F.when(fits, F.lit(False)) if out is None else out.when(fits, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """docs with STATS and a boolean column `__kept`."""
    return with_stats(docs, text).withColumn("__kept", ~base_failed() & verdict(rules))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit(docs, read(spark, sf_dir, "labels"))
    out = judge(docs, rules)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *[F.col(f"{STATS}.{n}").alias(n) for n in names], base_failed().alias("base_failed"), F.col("__kept").alias("kept"))
