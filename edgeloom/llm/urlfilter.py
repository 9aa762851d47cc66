"""URL filters (2): pattern rules indexed by their rarest literal token.

Every rule has literal tokens, pieces of host and path that any url it fits holds as
whole tokens. The corpus tells how often each of these tokens occurs (one aggregate
over the rules' tokens only), and a rule is filed under its rarest one; a url's tokens
fetch the rules filed under them, and only those run their regular expressions. A
url sees the few rules whose rare token it holds, however long the list is.

Rules are a bounded list by size (`MOST_RULES`), so their index is shipped to the
tasks; a longer list is refused rather than broadcast.

Verdicts: of host-and-path rules that fit, the longest decides, at equal length an
allow before a block; without one, a block pattern that fits blocks, else allow.

Defined cases: a null url or one without "://" has empty host and path, fits no rule and
is allowed; repeated rows are judged alike; an empty table gives an empty result; only
the named columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

MOST_RULES = 100_000
TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """pattern runs on host + path; tokens are literals that any fit holds as whole tokens."""

    name: str
    block: bool
    pattern: str
    tokens: tuple[str, ...]
    listed: bool


def host_rule(text: str, block: bool) -> Rule:
    """A rule "host/path": its host and all subdomains, paths that start with its path."""
    host, slash, path = text.partition("/")
    path = slash + path
    # the last path token counts as whole only if something ends it inside the rule
    whole = path[: max((i + 1 for i, c in enumerate(path) if not c.isalnum()), default=0)]
    tokens = tuple(TOKEN.findall(host)) + tuple(TOKEN.findall(whole.lower()))
    return Rule(text, block, r"(?:[^/?#]*\.)?" + re.escape(host) + "\x00" + re.escape(path), tokens, True)


def word_rule(name: str, words: str) -> Rule:
    """A block pattern: the words of a host label or path part, joined by dashes or the like."""
    parts = words.split("-")
    body = r"[-_.+]?".join(map(re.escape, parts)) if len(parts) == 1 else r"[-_.+]".join(map(re.escape, parts))
    return Rule(name, True, rf"(?:.*[^a-z0-9])?{body}(?:[^a-z0-9].*)?\Z", tuple(parts), False)


# The query's host-and-path rules.
CONTRACT_RULES = (
    host_rule("com/en/", True), host_rule("example.com/en/7", False),
    host_rule("net/de/", False), host_rule("example.net/de/8", True),
    host_rule("org/es/", True),
)
# Names of gambling, adult and spam sites.
BLOCK_WORDS = (
    "free-bets", "free-spins", "online-casino", "casino-bonus", "live-casino", "poker-bonus", "slots-online", "sports-betting", "no-deposit-bonus",
    "casino", "xxx", "porn", "adult-chat", "live-cams", "hot-singles", "escort-service",
    "cheap-pills", "buy-viagra", "cheap-meds", "payday-loan", "payday-loans", "free-crypto", "get-rich", "win-prize", "free-iphone", "warez", "keygen", "torrent-download",
)
RULES = CONTRACT_RULES + tuple(word_rule(f"word:{w}", w) for w in BLOCK_WORDS)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    there = url.isNotNull() & (at > 0)
    return F.when(there, F.translate(host, upper, lower)).otherwise(""), F.when(there, path).otherwise("")


class Index:
    """Rules by their rarest literal token."""

    def __init__(self, rules: tuple[Rule, ...], seen: dict[str, int]):
        self.by: dict[str, list[tuple[Rule, re.Pattern, int]]] = {}
        self.always: list[tuple[Rule, re.Pattern, int]] = []
        for order, rule in enumerate(rules):
            entry = (rule, re.compile(rule.pattern, re.S), order)
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (seen.get(t, 0), -len(t), t))
                self.by.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)

    def judge(self, host: str, path: str) -> tuple[str | None, str, str | None, int]:
        """(listed rule, verdict, block pattern's name, regular expressions run)."""
        if not host and not path:
            return None, "allow", None, 0
        tokens = dict.fromkeys(TOKEN.findall(f"{host} {path}".lower()))
        fetched = [e for t in tokens if t in self.by for e in self.by[t]] + self.always
        best, word = None, None
        text, plain = f"{host}\x00{path}", f"{host}{path}".lower()
        for rule, pattern, _ in sorted(fetched, key=lambda e: e[2]):
            if rule.listed:
                if pattern.match(text) and (best is None or (len(rule.name), not rule.block) > (len(best.name), not best.block)):
                    best = rule
            elif word is None and pattern.match(plain):
                word = rule.name
        block = best.block if best else word is not None
        return best.name if best else None, "block" if block else "allow", word, len(fetched)


def token_counts(urls: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """How many urls hold each of the rules' tokens; urls needs __host and __path."""
    spark = urls.sparkSession
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} are shipped to tasks")
    own = F.array_distinct(F.regexp_extract_all(F.lower(F.concat_ws(" ", "__host", "__path")), F.lit("[a-z0-9]+"), F.lit(0)))
    tokens = urls.select(F.explode(own).alias("token"))
    table = spark.createDataFrame([(t,) for t in wanted], "token string")
    return {r["token"]: r["count"] for r in tokens.join(F.broadcast(table), "token").groupBy("token").count().collect()}


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule (that decides, of the listed ones), verdict,
    pattern (the block pattern that fits) and n_tried (regular expressions run)."""
    ship(pages.sparkSession)
    host, path = parts(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("__host"), path.alias("__path"))
    index = Index(rules, token_counts(rows, rules))

    def run(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        out = [index.judge(h, p) for h, p in zip(host, path)]
        return pd.DataFrame(out, columns=["rule", "verdict", "pattern", "n_tried"])

    run.__annotations__ = {"host": pd.Series, "path": pd.Series, "return": pd.DataFrame}
    judged = rows.withColumn("__j", F.pandas_udf(run, "rule string, verdict string, pattern string, n_tried long")("__host", "__path"))
    return judged.select("page_id", F.col("__host").alias("host"), F.col("__path").alias("path"), "__j.rule", "__j.verdict", "__j.pattern", "__j.n_tried")


def op2_urls(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return judge(read(spark, sf_dir, "pages")).drop("n_tried")


_fits = " ".join(
    f"""WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{r}'"""
    for r in sorted((x.name for x in CONTRACT_RULES), key=len, reverse=True)
    for h, p in [(r[: r.index("/")], r[r.index("/") :])]
)
# RE2's match is of the whole text
ORACLE = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT page_id, host, path, CASE {_fits} END AS rule,
        CASE {" ".join(f"WHEN regexp_full_match(lower(host || path), '(?s){r.pattern.replace(chr(92) + 'Z', '')}') THEN '{r.name}'" for r in RULES if not r.listed)} END AS pattern FROM h)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ({", ".join(f"'{r.name}'" for r in CONTRACT_RULES if r.block)}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern FROM r
"""
