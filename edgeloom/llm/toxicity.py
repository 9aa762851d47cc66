"""Toxicity (1): a weighted finite-state pattern grammar over clauses.

Five transducers read a clause's tokens and write marks: insult, threat, target,
negation and reported speech. Each has a lexicon of words and stems and a small
state machine; they are composed by product into one transducer whose state is the
tuple of theirs, built lazily and remembered, so a clause is read once. What a
clause scores is the weight of its final state: an insult aimed at a target is worth
more than a bare one, a negated or reported one less, a threat needs a target. Only
matched clauses score, and a document is judged on their sums.

Words of the insult lexicon come in part from labelled rows: words and word stems whose
share of toxic documents is far above their share of others (likelihood ratio), in
at most `TERMS` terms. Weights of the patterns are learned by logistic regression on
the same rows. Held-out rows are never used; a document's score depends on its text only.

Defined cases: null and empty texts match nothing and get the score of a document
without matches; repeated rows score alike; rows labelled twice count by their
largest label; without labels the seed lexicon and prior weights judge; an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, ship, written

#: Labelled rows used to learn from, the smallest by a hash of their id, and terms learned from them.
TRAIN_ROWS = 24_000
TERMS = 4_000

# Seed lexicons of the five transducers.
INSULT = "idiot idiots moron morons loser losers scum trash worthless stupid pathetic disgusting clown clowns dumb imbecile cretin vermin filth garbage bastard bastards idiota imbécil estúpido basura inútil idiote imbécile stupide ordure abruti débile dummkopf abschaum arschloch wertlos ekelhaft erbärmlich".split()
THREAT = "kill murder hurt destroy beat stab shoot burn hang matar golpear destruir quemar tuer frapper détruire brûler töten umbringen schlagen vernichten verbrennen".split()
TARGET = "you your yours u they them he she him her these those tú usted ustedes vosotros ellos vous toi tu eux ils elles du dich dir euch sie ihr".split()
NEGATION = "not no never isn aren wasn weren don doesn didn neither nor without nunca jamás sin ne pas jamais sans nicht kein keine keinen niemals ohne".split()
REPORT = "said says say wrote writes called calls claimed claims quoted reported dijo dicen llamó escribió dit disent appelé écrit sagte sagen nannte schrieb angeblich".split()

#: Letter classes that tokens are written as; a word of several lexicons is of the first.
INS, THR, TGT, NEG, REP, OTHER = range(6)
WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = frozenset(".!?;:\n,|")
#: Stems are the first STEM letters of longer words.
STEMS = (6, 8)


def _machine(moves: dict[tuple[int, int], int]) -> callable:
    """A transducer's step: states stay where no move is given."""
    return lambda state, letter: moves.get((state, letter), state)


# Each machine's last state is what it says of the clause.
# insult: 0 none, 1 one, 2 two or more    threat, target: 0, 1
# negation: 0 none, 1 open, 2 an insult or threat came after one
# report: 0 none, 1 open, 2 an insult or threat came after one
MACHINES = (
    _machine({(0, INS): 1, (1, INS): 2}),
    _machine({(0, THR): 1}),
    _machine({(0, TGT): 1}),
    _machine({(0, NEG): 1, (1, INS): 2, (1, THR): 2}),
    _machine({(0, REP): 1, (1, INS): 2, (1, THR): 2}),
)


class Composed:
    """The product of the machines, states numbered as they are reached."""

    def __init__(self):
        self.states = [(0,) * len(MACHINES)]
        self.number = {self.states[0]: 0}
        self.next: list[list[int | None]] = [[None] * 6]

    def step(self, state: int, letter: int) -> int:
        to = self.next[state][letter]
        if to is None:
            new = tuple(m(s, letter) for m, s in zip(MACHINES, self.states[state]))
            if new not in self.number:
                self.number[new] = len(self.states)
                self.states.append(new)
                self.next.append([None] * 6)
            to = self.next[state][letter] = self.number[new]
        return to


#: Patterns that a clause's final state is read as, in order; the first that fits counts.
PATTERNS = ("reported", "negated", "threat_target", "insult_target", "insults", "insult")


def pattern_of(state: tuple[int, ...]) -> str | None:
    insult, threat, target, negation, report = state
    if not insult and not (threat and target):
        return None
    if report == 2:
        return "reported"
    if negation == 2:
        return "negated"
    if threat and target:
        return "threat_target"
    if target:
        return "insult_target"
    return "insults" if insult == 2 else "insult"


@dataclass
class Grammar:
    """The lexicon (words and stems to a letter and a weight) and the patterns' weights."""

    words: dict[str, tuple[int, float]]
    stems: dict[str, tuple[int, float]] = field(default_factory=dict)
    coef: np.ndarray | None = None

    def __post_init__(self):
        self.composed = Composed()
        self.shapes = {i: set() for i in STEMS}
        for s in self.stems:
            self.shapes[len(s)].add(s)
        self.cache: dict[str, tuple[int, float]] = {}

    def letter(self, word: str) -> tuple[int, float]:
        found = self.cache.get(word)
        if found is None:
            found = self.words.get(word) or next((self.stems[word[:n]] for n in reversed(STEMS) if len(word) > n and word[:n] in self.stems), (OTHER, 0.0))
            if len(self.cache) > 1_000_000:
                self.cache.clear()
            self.cache[word] = found
        return found

    def features(self, text: str | None) -> list[float]:
        """Sums over matched clauses: each pattern's count and the lexicon weight of its
        insults, the largest weight, and the log of the number of words."""
        counts = dict.fromkeys(PATTERNS, 0)
        total = largest = 0.0
        kinds = set()
        n = 0
        if text:
            low = text.lower()
            words = WORD.findall(low)
            n = len(words)
            hit = {w for w in set(words) if self.letter(w)[0] in (INS, THR)}
            if hit:
                for clause in self._clauses(low, hit):
                    state, weight = 0, 0.0
                    for w in WORD.findall(clause):
                        letter, v = self.letter(w)
                        if letter != OTHER:
                            state = self.composed.step(state, letter)
                            if letter == INS:
                                weight += v
                                kinds.add(w)
                    p = pattern_of(self.composed.states[state])
                    if p:
                        counts[p] += 1
                        if p not in ("reported", "negated"):
                            total += weight
                            largest = max(largest, weight)
        return [math.log1p(counts[p]) for p in PATTERNS] + [math.log1p(max(0.0, total)), min(largest, 12.0), math.log1p(len(kinds)), math.log1p(n), total / math.sqrt(n + 20.0)]

    @staticmethod
    def _clauses(low: str, hit: set[str]):
        """The clauses that hold a hit word."""
        for clause in re.split(r"[.!?;:\n,|]+", low):
            if not hit.isdisjoint(WORD.findall(clause)):
                yield clause

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip(rows @ self.coef[1:] + self.coef[0], -30, 30)
        return 1 / (1 + np.exp(-z))


def seeds() -> dict[str, tuple[int, float]]:
    out: dict[str, tuple[int, float]] = {}
    for letter, words in ((OTHER, ()), (REP, REPORT), (NEG, NEGATION), (TGT, TARGET), (THR, THREAT), (INS, INSULT)):
        out |= dict.fromkeys(words, (letter, 2.0))
    return out


#: Weights without labels: intercept, patterns, total, largest, kinds, length, density.
PRIOR = np.array([-2.0, 0.2, 0.2, 3.8, 2.0, 1.5, 0.8, 0.8, 0.3, 0.5, -0.1, 0.5])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _terms(docs: DataFrame) -> DataFrame:
    """(term, toxic, docs): in how many documents each word and stem stands, and how many are toxic."""

    def run(batches):
        for pdf in batches:
            seen: dict[str, list[int]] = {}
            for t, y in zip(pdf["t"], pdf["y"]):
                words = set(WORD.findall((t or "").lower()))
                terms = {w for w in words if 2 < len(w) <= 24} | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}
                for x in terms:
                    c = seen.setdefault(x, [0, 0])
                    c[0] += y
                    c[1] += 1
            if seen:
                yield pd.DataFrame([(k, *v) for k, v in seen.items()], columns=["term", "toxic", "docs"])

    parts = docs.mapInPandas(run, "term string, toxic long, docs long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS, terms: int = TERMS) -> Grammar:
    """Learn lexicon and weights from at most train_rows labelled rows that aren't held out."""
    spark = docs.sparkSession
    ship(spark)
    own = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    picked = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).collect()
    if len({r["y"] for r in picked}) < 2:
        return Grammar(seeds(), coef=PRIOR)
    chosen = spark.createDataFrame([(int(r["doc_id"]), int(r["y"])) for r in picked], "__id long, y int")
    # written once: halves, sizes, term counts and features all read these few rows
    rows = written(docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("t")).join(F.broadcast(chosen), "__id").select("t", "y", (F.pmod(F.xxhash64("__id"), F.lit(2)) == 0).alias("half")), "training")

    def lexicon(part: DataFrame) -> Grammar:
        size = part.agg(F.sum("y"), F.count("*")).first()
        pos, neg = float(size[0] or 0), float(size[1] - (size[0] or 0))
        weight = F.log((F.col("toxic") + 0.25) / (pos + 0.5)) - F.log((F.col("docs") - F.col("toxic") + 0.25) / (neg + 0.5))
        gain = F.col("toxic") * weight
        found = _terms(part).where("toxic >= 3").select("term", weight.alias("w"), gain.alias("g"), "toxic", "docs").where("w >= 2").orderBy(F.desc("g"), "term").limit(terms).collect()
        words, stems = seeds(), {}
        for r in found:
            entry = (INS, min(6.0, float(r["w"])))
            if r["term"].endswith("*"):
                stems[r["term"][:-1]] = entry
            elif words.get(r["term"], (INS, 0))[0] == INS:
                words[r["term"]] = entry
        return Grammar(words, stems)

    # pattern weights are learned where the lexicon wasn't: each half reads with the other's
    xs, ys = [], []
    for half in (True, False):
        g = lexicon(rows.where(F.col("half") != half))
        x, y = _features(rows.where(F.col("half") == half), g)
        xs.append(x)
        ys.append(y)
    grammar = lexicon(rows)
    grammar.coef = logistic(np.concatenate(xs), np.concatenate(ys))
    drop(rows)
    return grammar


def _features(rows: DataFrame, g: Grammar) -> tuple[np.ndarray, np.ndarray]:
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"x": [g.features(t) for t in pdf["t"]], "y": pdf["y"]})

    got = rows.select("t", "y").mapInPandas(run, "x array<double>, y int").toPandas()
    return np.array(got["x"].tolist()).reshape(-1, len(PRIOR) - 1), got["y"].to_numpy(float)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton's method."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, grammar: Grammar, text: str = "text") -> Column:
    """A column of scores in 0 to 1."""
    ship(docs.sparkSession)

    def run(t: pd.Series) -> pd.Series:
        x = [grammar.features(v if isinstance(v, str) else None) for v in t]
        return pd.Series(grammar.score(np.array(x).reshape(-1, len(PRIOR) - 1)))

    run.__annotations__ = {"t": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")(F.col(text))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    grammar = fit(docs, read(spark, sf_dir, "labels"))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(docs, grammar).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
