"""License scans (10), native: sentence-rule recognition.

A text is split into sentences (blank lines, and full stops, exclamation or question
marks before white space) and these into lines, lines are normalised (lower case, words
only), each line that is a known licence sentence becomes its identifier, and so do lines
that are one together, as hard-wrapped texts have them; the sequence of identifiers is
matched against ordered licence rules, each of which is told by identifiers that follow
one another with anything between. All of it is one projection of DataFrame expressions:
no shuffle, no Python; work is linear in the text.

Defined cases: null and empty texts have no sentences and no licence; rows repeated
are judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, folded

# Licence names that a tag line may give.
SPDX = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "ISC", "Unlicense", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")
# Known sentences, as patterns over the normalised sentence, by identifier.
# A sentence gets the first identifier whose pattern it matches as a whole.
SENTENCES = {
    "grant-mit": r"(?:this (?:work|software|project|file|code) is )?(?:released|licensed|distributed|available)? ?under the (?:terms of the )?(?:mit|expat) licen[cs]e(?: see .*)?",
    "body-mit": r"permission is hereby granted free of charge to any person obtaining a copy of this software.*",
    "notice-kept": r"the above copyright notice and this permission notice shall be included in all copies.*",
    "grant-apache-2": r"(?:this (?:work|software|project|file|code) is )?(?:released|licensed|distributed|available)? ?under the (?:terms of the )?apache licen[cs]e version 2(?: 0)?(?: the licen[cs]e)?",
    "use-apache-2": r"you may not use this (?:file|work) except in compliance with the licen[cs]e",
    "grant-gpl-3": r"(?:this (?:work|software|project|file|code|program) is )?(?:released|licensed|distributed|available)? ?under the (?:terms of the )?gnu general public licen[cs]e version 3(?: 0)?(?: or later| or any later version)?",
    "free-gpl-3": r"this (?:program|software) is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e.*",
    "free-gpl-2": r"this (?:program|software) is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e.*",
    "free-lgpl": r"this (?:library|program|software) is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e.*",
    "free-agpl": r"this (?:program|software) is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e.*",
    "subject-mpl-2": r"this source code form is subject to the terms of the mozilla public licen[cs]e(?: v.*)?",
    "body-isc": r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted.*",
    "refer-unlicense": r"for more information please refer to https? unlicense org",
    **{f"spdx-{name.lower()}": rf"(?:[a-z]+ )?spdx licen[cs]e identifier {re.sub('[^a-z0-9]+', ' ', name.lower())}(?: only| or later)?" for name in SPDX},
    "free-gpl": r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e.*",
    "later-gpl": r".*either version 3 of the licen[cs]e or at your option any later version",
    "grant-gpl-2": r"(?:this (?:work|software|project|file|code|program) is )?(?:released|licensed|distributed|available)? ?under the (?:terms of the )?gnu general public licen[cs]e version 2(?: 0)?(?: or later| or any later version)?",
    "grant-cc-by-nc-4": r"(?:this (?:work|text) is )?(?:released|licensed|distributed|available)? ?under (?:a |the )?(?:cc by nc 4 0|creative commons attribution noncommercial 4 0(?: international)?)(?: licen[cs]e)?",
    "grant-cc-by-sa-4": r"(?:this (?:work|text) is )?(?:released|licensed|distributed|available)? ?under (?:a |the )?(?:cc by sa 4 0|creative commons attribution sharealike 4 0(?: international)?)(?: licen[cs]e)?",
    "grant-cc-by-4": r"(?:this (?:work|text) is )?(?:released|licensed|distributed|available)? ?under (?:a |the )?(?:cc by 4 0|creative commons attribution 4 0(?: international)?)(?: licen[cs]e)?",
    "bsd-redistribution": r"redistribution and use in source and binary forms with or without modification are permitted.*",
    "bsd-no-endorsement": r"neither the name of .* may be used to endorse or promote products derived from this software.*",
    "no-warranty": r"(?:the|this) software is provided as is.*",
    "rights-reserved": r"all rights reserved",
    "copyright": r"copyright (?:c )?(?:19|20)\d\d.*",
}
# Ordered rules: a licence, the sequences of identifiers that tell it, of which each
# must occur in its order with anything between, and its family.
RULES = (
    ("BSD-3-Clause", (("bsd-redistribution", "bsd-no-endorsement"), ("spdx-bsd-3-clause",)), "permissive"),
    ("BSD-2-Clause", (("bsd-redistribution",), ("spdx-bsd-2-clause",)), "permissive"),
    ("MIT", (("body-mit",), ("grant-mit",), ("spdx-mit",)), "permissive"),
    ("Apache-2.0", (("grant-apache-2",), ("use-apache-2",), ("spdx-apache-2.0",)), "permissive"),
    ("GPL-3.0", (("grant-gpl-3",), ("free-gpl-3",), ("free-gpl", "later-gpl"), ("spdx-gpl-3.0",)), "copyleft"),
    ("GPL-2.0", (("grant-gpl-2",), ("free-gpl-2",), ("spdx-gpl-2.0",)), "copyleft"),
    ("GPL", (("free-gpl",),), "copyleft"),
    ("LGPL", (("free-lgpl",), ("spdx-lgpl-2.1",), ("spdx-lgpl-3.0",)), "copyleft"),
    ("AGPL-3.0", (("free-agpl",), ("spdx-agpl-3.0",)), "copyleft"),
    ("MPL-2.0", (("subject-mpl-2",), ("spdx-mpl-2.0",)), "copyleft"),
    ("ISC", (("body-isc",), ("spdx-isc",)), "permissive"),
    ("Unlicense", (("refer-unlicense",), ("spdx-unlicense",)), "public domain"),
    ("CC-BY-NC-4.0", (("grant-cc-by-nc-4",), ("spdx-cc-by-nc-4.0",)), "noncommercial"),
    ("CC-BY-SA-4.0", (("grant-cc-by-sa-4",), ("spdx-cc-by-sa-4.0",)), "copyleft"),
    ("CC-BY-4.0", (("grant-cc-by-4",), ("spdx-cc-by-4.0",)), "permissive"),
    ("Proprietary", (("rights-reserved",),), "closed"),
)
#: A rule doesn't fire on what one of these has explained.
EXPLAINED = {"BSD-2-Clause": "BSD-3-Clause", "GPL": "GPL-3.0"}
#: What the SQL asks of a sentence before it is normalised, and where it splits.
HINT = r"(?i)licen[cs]e|licen[cs]ed|released under|under cc by|creative commons|copyright|permission|redistribution|warranty|as is|endorse|free software|rights reserved"
SENTENCE_END = r"(?<=[.!?])\s+|\s*\n\s*"
#: Sentences without one of these, whatever stands between the words, can't be known ones.
WORDS = r"(?i)licen[cs]e|cc[^a-z0-9]+by|creative[^a-z0-9]+commons|copyright|permission|redistribution|as[^a-z0-9]+is|endorse|rights[^a-z0-9]+reserved"
PARAGRAPH = r"(?<=[.!?])\s+|\n[^\S\n]*\n\s*"
#: Words that known sentences begin with, but for "later-gpl", which is sought from its "either" on.
START = r"^(?:this|released|licensed|distributed|available|under|permission|the|you|redistribution|neither|all|copyright|for|[a-z]+ spdx|spdx)(?: |$)"
#: No known sentence needs so many characters to be told, but for a name inside ENDLESS.
MOST, ENDLESS = 200, "neither the name of "


def known(s: Column) -> Column:
    """The identifier of a normalised sentence, or null."""
    out = None
    for name, pattern in SENTENCES.items():
        fits = F.regexp_like(s, F.lit(f"^(?:{pattern})$"))
        out = F.when(fits, F.lit(name)) if out is None else out.when(fits, F.lit(name))
    return out


def wrapped_ids(lines: Column) -> Column:
    """Identifiers of the known sentences among the normalised lines of a sentence: a line by
    itself, else the earliest open beginning that it completes. Beginnings too long to become one are let go."""
    none = F.array().cast("array<string>")
    held = lambda a: F.filter(a, lambda x: x.isNotNull())

    def shorter(p: Column) -> Column:  # a name of any length has the same end
        return F.when(F.startswith(p, F.lit(ENDLESS)) & (F.length(p) > MOST), F.concat(F.lit(ENDLESS), F.right(p, F.lit(MOST - 50)))).otherwise(p)

    def step(open_: Column, line: Column) -> Column:
        grown = F.transform(open_, lambda p: F.concat(p, F.lit(" "), line))
        hit = F.coalesce(known(line), F.get(held(F.transform(grown, known)), F.lit(0)))
        begun = held(F.array(F.when(F.regexp_like(line, F.lit(START)), line), F.when(F.contains(line, F.lit("either")), F.regexp_extract(line, "^.*(either.*)$", 1))))
        still = F.filter(F.array_distinct(F.transform(F.concat(grown, begun), shorter)), lambda p: F.length(p) <= MOST)
        return bound(hit, lambda h: F.struct(F.when(h.isNotNull(), none).otherwise(still).alias("state"), held(F.array(h)).alias("out")))

    return folded(lines, none, step, "array<string>")


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    plain = lambda s: F.trim(F.regexp_replace(F.lower(s), r"[^a-z0-9]+", " "))

    def ids(s: Column) -> Column:
        lines = F.filter(F.transform(F.split(s, "\n"), plain), lambda x: x != "")
        alone = F.filter(F.array(known(plain(s))), lambda x: x.isNotNull())
        return F.when(F.contains(s, F.lit("\n")), wrapped_ids(lines)).otherwise(alone)

    hinted = F.filter(F.split(F.coalesce(text, F.lit("")), PARAGRAPH), lambda s: F.regexp_like(s, F.lit(WORDS)))
    found = F.flatten(F.transform(hinted, ids))
    return F.when(F.regexp_like(F.coalesce(text, F.lit("")), F.lit(WORDS)), found).otherwise(F.array().cast("array<string>"))


def told(ids: Column, sequences: tuple[tuple[str, ...], ...]) -> Column:
    """Whether one of the sequences occurs among the identifiers in its order: one pass over them for each."""
    out = F.lit(False)
    for seq in sequences:
        if len(seq) == 1:
            hit = F.array_contains(ids, F.lit(seq[0]))
        else:  # how much of the sequence has been met so far
            want = F.array(*[F.lit(x) for x in seq])
            hit = F.aggregate(ids, F.lit(0), lambda n, x: F.when(F.get(want, n) == x, n + 1).otherwise(n)) == len(seq)
        out = out | hit
    return out


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_sentences (known ones), sentence_ids (joined by ";"), licenses
    (all that rules find, in the order of rules, joined by ","), license (the first) and
    family, both null without one. A rule doesn't fire on what an earlier one of its
    kind has explained: BSD-2-Clause not beside BSD-3-Clause, GPL not beside GPL-3.0."""
    out = docs.select(F.col(doc_id).alias("doc_id"), sentence_ids(F.col(text)).alias("__ids"))
    fires = {}
    for name, sequences, _ in RULES:
        c = told(F.col("__ids"), sequences)
        if other := EXPLAINED.get(name):
            c = c & ~told(F.col("__ids"), {n: q for n, q, _ in RULES}[other])
        fires[name] = c
    out = out.withColumn("__all", F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in fires.items()]), lambda x: x.isNotNull()))
    family = F.element_at(F.create_map(*[F.lit(v) for n, _, f in RULES for v in (n, f)]), F.get("__all", F.lit(0)))
    return out.select(
        "doc_id", F.size("__ids").cast("long").alias("n_sentences"), F.concat_ws(";", "__ids").alias("sentence_ids"),
        F.concat_ws(",", "__all").alias("licenses"), F.get("__all", F.lit(0)).alias("license"), family.alias("family"),
    )


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return scan(read(spark, sf_dir, "documents"))


def _case(column: str, pairs) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{n}'" for n, p in pairs) + " END"


#: The rules as patterns over identifiers that are each followed by ";".
PATTERNS = {n: "|".join("(?:[^;]+;)*?".join(f"{x.replace('.', '[.]')};" for x in seq) for seq in sequences) for n, sequences, _ in RULES}
_plain = "trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))"
# RE2 has no look-behind: sentence ends are marked first, then split at
ORACLE = f"""
WITH s AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(10), 'g'), '[ \\t\\n\\x0B\\f\\r]*\\n[ \\t\\n\\x0B\\f\\r]*'),
             lambda x: regexp_matches(x, '{HINT}')) AS l FROM documents),
u AS (SELECT doc_id, i, {_case('p', [(n, f"^(?:{p})$") for n, p in SENTENCES.items()])} AS k
      FROM (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(list_transform(l, lambda s: {_plain})) AS p FROM s)),
q AS (SELECT doc_id, count(*) AS n, string_agg(k, ';' ORDER BY i) AS ids FROM u WHERE k IS NOT NULL GROUP BY doc_id),
d AS (SELECT documents.doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(ids || ';', '') AS seq FROM documents LEFT JOIN q USING (doc_id)),
f AS (SELECT *, list_filter([{", ".join(f"CASE WHEN regexp_matches(seq, '(?:^|;)(?:{p})')" + (f" AND NOT regexp_matches(seq, '(?:^|;)(?:{PATTERNS[EXPLAINED[n]]})')" if n in EXPLAINED else "") + f" THEN '{n}' END" for n, p in PATTERNS.items())}], lambda x: x IS NOT NULL) AS a FROM d)
SELECT doc_id, n_sentences, sentence_ids, array_to_string(a, ',') AS licenses, a[1] AS license,
  CASE a[1] {" ".join(f"WHEN '{n}' THEN '{c}'" for n, _, c in RULES)} END AS family FROM f
"""
