"""Secret scans (5), native: corpus-wide ownership frequency.

Base spans come from three fixed patterns. Further candidates (generic credential
shapes) are added by the method: every candidate value is hashed, the corpus counts
its distinct repositories and owners, and a value of few of both and a live-looking
form adds its span, while a value that many owners or repositories share is a copied
example. The two frequencies differ: an owner may hold several repositories. The
table of documents names neither, so op5 takes `source` as the owner and a source's
documents in one language as a repository.

All of it is DataFrame expressions. Spans of a kind are found by extracting the
matches and splitting at them: the lengths of the pieces and matches, summed, are
the places. Texts are searched once and what was found is a table; counts and verdicts
work on that, and rows without a candidate go round them. Counting hashes is a two-step
aggregate (per hash, repository and owner, then per hash), so one value in a third of
all rows is summed before any shuffle; verdicts come back by an equi-join, which Spark
splits where a hash is hot. Overlaps are found by a sweep over sorted spans, so work is
linear in a document's matches but for their sorting.

Defined cases: null text is empty; null repository or owner counts as one unnamed
one; rows repeated in full give as many result rows; an empty table gives an empty
result; only the named columns are read, and working columns are prefixed.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, folded, written

# The base patterns by kind, in the order of kinds, and the least length.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Candidate shapes of the method: provider prefixes, then long mixed tokens.
PREFIXED = r"(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{30,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,})"
MIXED = r"[A-Za-z0-9+/_-]{32,}"
KINDS = ("assign", "access", "hex", "live")
#: A value of more owners or repositories than this is a copied example.
MOST_OWNERS = 2
MOST_REPOS = 4

_SPAN = "array<struct<s:bigint,e:bigint,v:string>>"


#: What a text must hold for each search: words of any case, a run of characters, prefixes.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LONG = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24}"


def spans(text: Column, pattern: str, may: Column) -> Column:
    """(s, e, v) of the leftmost non-overlapping matches, places counting code points; searched for only where `may`."""
    sizes = lambda p, m: F.struct(F.length(p).cast("long").alias("p"), F.length(m).cast("long").alias("m"), m.alias("v"))
    zipped = bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, sizes))

    def step(at: Column, z: Column) -> Column:
        one = F.struct((at + z["p"]).alias("s"), (at + z["p"] + z["m"]).alias("e"), z["v"].alias("v"))
        return F.struct((at + z["p"] + z["m"]).alias("state"), F.array(one).alias("out"))

    none = F.array().cast(_SPAN)
    return F.when(may, F.when(F.regexp_like(text, F.lit(pattern)), folded(zipped, F.lit(0).cast("long"), step, _SPAN)).otherwise(none)).otherwise(none)


def without_overlaps(rows: DataFrame, found: str, taken: str) -> DataFrame:
    """rows where the spans (s, e, k, v) of column `found` that overlap one of `taken` are gone:
    two sweeps over both in order of their places."""
    name = "array<struct<s:bigint,e:bigint,own:boolean,k:int,v:string>>"
    mark = lambda c, own: F.transform(c, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(own).alias("own"), x["k"].alias("k"), x["v"].alias("v")))

    def sweep(meets, reach) -> Column:
        def step(edge: Column, x: Column) -> Column:
            out = F.when(x["own"] & F.coalesce(meets(edge, x), F.lit(False)), F.array().cast(name)).otherwise(F.array(x))
            return F.struct(F.when(x["own"], edge).otherwise(reach(edge, x)).alias("state"), out.alias("out"))

        return F.when(F.exists("__both", lambda x: x["own"]), folded(F.col("__both"), F.lit(None).cast("long"), step, name)).otherwise(F.array().cast(name))

    rows = rows.withColumn("__both", F.array_sort(F.concat(mark(F.col(found), True), mark(F.col(taken), False))))
    # of spans taken before, the farthest end so far; of those after, the nearest start
    rows = rows.withColumn("__both", sweep(lambda edge, x: edge > x["s"], lambda edge, x: F.greatest(edge, x["e"])))
    rows = rows.withColumn("__both", F.reverse("__both"))
    rows = rows.withColumn("__both", sweep(lambda edge, x: edge < x["e"], lambda edge, x: F.least(edge, x["s"])))
    own = F.filter(F.reverse("__both"), lambda x: x["own"])
    return rows.withColumn(found, F.transform(own, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"), x["v"].alias("v")))).drop("__both")


def live_looking(v: Column) -> Column:
    """Letters of both cases and several digits, or a provider's prefix, and no run of one character."""
    digits = F.length(F.regexp_replace(v, "[^0-9]", ""))
    mixed = F.regexp_like(v, F.lit("[A-Z]")) & F.regexp_like(v, F.lit("[a-z]")) & (digits >= 4)
    return (mixed | F.regexp_like(v, F.lit(f"^{PREFIXED}$"))) & ~F.regexp_like(v, F.lit(r"0000|1111|XXXX|xxxx|AAAA|aaaa"))


def with_spans(docs: DataFrame, text: str = "text", repo: tuple[str, ...] = ("source",), owner: tuple[str, ...] = ("source",), keep: tuple[str, ...] = (),
               most_owners: int = MOST_OWNERS, most_repos: int = MOST_REPOS) -> DataFrame:
    """Columns `keep` of every row of docs with arrays of (s, e, k, v), sorted: __base
    (base spans), __added (the method's spans), __examples (those of either sort whose
    value the corpus shows to be a copied example)."""
    joined = lambda names: F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    rows = docs.select(*keep, joined(repo).alias("__repo"), joined(owner).alias("__owner"), F.coalesce(F.col(text), F.lit("")).alias("__t"))
    rows = rows.withColumn("__low", F.lower("__t"))
    assign = functools.reduce(lambda a, b: a | b, [F.contains(F.col("__low"), F.lit(w)) for w in ASSIGN_WORDS])
    rows = rows.withColumns({"__assign": assign, "__long": F.regexp_like("__t", F.lit(LONG))})
    tag = lambda c, kind: F.transform(c, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("k"), x["v"].alias("v")))
    t, long = F.col("__t"), F.col("__long")
    # a match of MIXED is a run of 32, one of PREFIXED holds a run of 24 or is a dotted token
    rows = rows.select(
        *keep, "__repo", "__owner", spans(t, ASSIGN, F.col("__assign")).alias("__a"), spans(t, ACCESS, F.contains(t, F.lit("AKIA"))).alias("__k"),
        spans(t, HEX, long).alias("__h"), spans(t, PREFIXED, long | F.contains(t, F.lit("eyJ"))).alias("__p"), spans(t, MIXED, long).alias("__m"),
    )
    long_enough = F.filter("__a", lambda x: F.length(F.regexp_extract(x["v"], ASSIGN, 2)) >= 6)
    rows = rows.withColumn("__base", F.concat(tag(long_enough, 0), tag(F.col("__k"), 1), tag(F.col("__h"), 2)))
    # candidates count where no base span lies, mixed ones where no prefixed one does either
    rows = rows.withColumns({"__p": tag(F.col("__p"), 3), "__m": tag(F.col("__m"), 3)})
    for found, taken in (("__p", "__base"), ("__m", "__base"), ("__m", "__p")):
        rows = without_overlaps(rows, found, taken)
    cand = F.filter(F.concat("__p", "__m"), lambda x: live_looking(x["v"]))
    rows = rows.select(*keep, "__repo", "__owner", F.array_sort(F.concat("__base", cand)).alias("__all")).withColumn("__row", F.monotonically_increasing_id())
    rows = written(rows, "candidates")

    each = rows.where(F.size("__all") > 0).select(*keep, "__row", "__repo", "__owner", F.explode("__all").alias("__c"))
    value = F.when(F.col("__c.k") == 0, F.regexp_extract("__c.v", ASSIGN, 2)).otherwise(F.col("__c.v"))
    each = each.withColumn("__hash", F.sha2(value, 256))
    counts = each.groupBy("__hash", "__repo", "__owner").agg(F.count("*").alias("__n"))
    counts = counts.groupBy("__hash").agg(F.count_distinct("__owner").alias("__owners"), F.count_distinct("__repo").alias("__repos"))
    copied = counts.where((F.col("__owners") > most_owners) | (F.col("__repos") > most_repos)).select("__hash", F.lit(True).alias("__copied"))
    each = each.join(copied, "__hash", "left").withColumn("__copied", F.coalesce("__copied", F.lit(False)))
    here = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("__c"))))
    some = each.groupBy("__row", *keep).agg(
        here(F.col("__c.k") < 3).alias("__base"), here((F.col("__c.k") == 3) & ~F.col("__copied")).alias("__added"), here(F.col("__copied")).alias("__examples"),
    )
    none = F.filter("__all", lambda x: F.lit(False))
    return some.drop("__row").unionByName(rows.where(F.size("__all") == 0).select(*keep, *[none.alias(c) for c in ("__base", "__added", "__examples")]))


def masked(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """text with each span of the array (s, e, k, v; sorted) replaced; overlapping ones become one."""

    def step(at: Column, x: Column) -> Column:
        # a span that starts inside the last one only moves the end
        upto = F.substr(text, (at + 1).cast("int"), F.greatest(x["s"] - at, F.lit(0).cast("long")).cast("int"))
        out = F.when(x["s"] >= at, F.array(upto, F.lit(mask))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(at, x["e"]).alias("state"), out.alias("out"))

    pieces = folded(found, F.lit(0).cast("long"), step, "array<string>")
    end = F.array_max(F.transform(found, lambda x: x["e"]))
    return F.when(F.size(found) == 0, text).otherwise(F.concat(F.array_join(pieces, ""), F.substr(text, (end + 1).cast("int"))))


def _joined(found: Column) -> Column:
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", name(x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    from .common import read

    out = with_spans(read(spark, sf_dir, "documents"), repo=("source", "lang"), keep=("doc_id",))
    n = lambda k: F.size(F.filter("__base", lambda x: x["k"] == k)).cast("long")
    every = F.array_sort(F.concat("__base", "__added"))
    return out.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_joined(F.col("__base")), 256).alias("base_sha256"), _joined(every).alias("spans"),
        F.size("__examples").cast("long").alias("n_examples"),
    )


def _find(kind: int, pattern: str) -> str:
    p = pattern.replace("'", "''")
    return f"SELECT doc_id, source, repo, {kind} AS k, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS p FROM d"


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(source, '') || chr(1) || coalesce(lang, '') AS repo, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_find(k, p) for k, p in enumerate((ASSIGN, ACCESS, HEX, PREFIXED, MIXED)))}),
x AS (SELECT doc_id, source, repo, k, m, p, unnest(range(1, len(m) + 1)) AS i FROM f WHERE len(m) > 0),
y AS (SELECT doc_id, source, repo, k, m[i] AS v,
        coalesce(list_sum(list_transform(p[1:i], lambda q: length(q))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda q: length(q))), 0) AS s
      FROM x),
z AS (SELECT doc_id, source, repo, k, v, s::BIGINT AS s, (s + length(v))::BIGINT AS e FROM y
      WHERE k <> 0 OR length(regexp_extract(v, '{ASSIGN.replace("'", "''")}', 2)) >= 6),
base AS (SELECT * FROM z WHERE k < 3),
p1 AS (SELECT * FROM z WHERE k = 3 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = z.doc_id AND z.s < b.e AND b.s < z.e)),
p2 AS (SELECT * FROM z WHERE k = 4 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = z.doc_id AND z.s < b.e AND b.s < z.e)
         AND NOT EXISTS (SELECT 1 FROM p1 b WHERE b.doc_id = z.doc_id AND z.s < b.e AND b.s < z.e)),
cand AS (SELECT doc_id, source, repo, 3 AS k, v, s, e FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2)
         WHERE ((regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]') AND length(regexp_replace(v, '[^0-9]', '', 'g')) >= 4)
                OR regexp_matches(v, '^{PREFIXED}$'))
           AND NOT regexp_matches(v, '0000|1111|XXXX|xxxx|AAAA|aaaa')),
c AS (SELECT *, CASE WHEN k = 0 THEN regexp_extract(v, '{ASSIGN.replace("'", "''")}', 2) ELSE v END AS w FROM (SELECT * FROM base UNION ALL SELECT * FROM cand)),
o AS (SELECT w, count(DISTINCT source) AS n, count(DISTINCT repo) AS n_repos FROM c GROUP BY w),
r AS (SELECT c.*, (o.n > {MOST_OWNERS} OR o.n_repos > {MOST_REPOS}) AS copied, ['assign','access','hex','live'][c.k + 1] || ':' || s || ':' || e AS label FROM c JOIN o USING (w)),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
        coalesce(string_agg(label, ',' ORDER BY s, k) FILTER (k < 3), '') AS base,
        coalesce(string_agg(label, ',' ORDER BY s, k) FILTER (k < 3 OR NOT copied), '') AS spans, count(*) FILTER (copied) AS n_examples
      FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_examples, 0)::BIGINT AS n_examples
FROM d LEFT JOIN g USING (doc_id)
"""
