"""Cases beside those of test_operators: large identifiers next to nulls, repeated identifiers,
small memory, hot anchors, long licence texts, many secrets, whole query functions."""

import os
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edgeloom.llm import common, decontaminate, licenses, neardup, packing, secrets, sstable, suffix, toxicity

from .test_operators import DATA, WORDS, brute_components, brute_removed, prose

BIG = [(1 << 60) + 1, (1 << 60) + 3, None]


@pytest.fixture(scope="module")
def big(spark):
    """Identifiers above 2^53 and a null one in one partition."""
    rng = random.Random(11)
    rows = [(i, prose(rng, 40)) for i in BIG]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).cache()


def test_large_identifiers(spark, big):
    ids = set(BIG)
    vocab = common.vocabulary()
    assert {r["doc_id"] for r in packing.pack(big, vocab).collect()} == ids
    assert {r["doc_id"] for r in neardup.near_duplicates(big).collect()} == ids
    assert {r["doc_id"] for r in suffix.remove(big, suffix.repeated_spans(big)).collect()} == ids
    assert {r["doc_id"] for r in sstable.read_shards(sstable.write_shards(big, common.new_path(spark, "sst"), vocab)).collect()} == ids
    items = big.select(F.col("doc_id").alias("item_id"), "text")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(big, items).collect()} == {(i, i) for i in BIG}
    most = spark.createDataFrame([((1 << 63) - 1, "a b c"), (None, "a b d")], "doc_id long, text string")
    assert {r["doc_id"] for r in suffix.remove(most, suffix.repeated_spans(most)).collect()} == {(1 << 63) - 1, None}


def test_repeated_identifiers_link(spark):
    rng = random.Random(12)
    a, b = prose(rng, 60).split(), prose(rng, 60).split()
    near = lambda w: " ".join([*w[:30], rng.choice(WORDS), *w[31:]])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (8, near(a)), (9, near(b)), (9, near(b)), (4, prose(rng, 50)), (4, prose(rng, 50)), (4, None), (12, None)]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=5, percent=80)
    want = brute_components(rows, 5, 80)
    got = {}
    for r in out.collect():
        if r["n_shingles"]:
            got.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert got == {i: {want[i]} for i in got} and got[9] == got[8] == {5}
    assert out.count() == len(rows)


@pytest.mark.parametrize("bits", [(4, 4), (16, 24)])
def test_rare_shingles_lose_no_link(spark, bits, monkeypatch):
    """Every key is large, and the sketch is so small that its counts say nothing, or of full size."""
    monkeypatch.setattr(neardup, "SMALL", 1)
    monkeypatch.setattr(neardup, "SKETCH_BITS", bits)
    monkeypatch.setattr(neardup, "SKETCH_BLOCK", 4)
    rng = random.Random(13)
    base = prose(rng, 120).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(0, 14)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((i, " ".join(w)))
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == brute_components(rows, 3, 85)


def test_external_order_in_small_memory():
    """The order doesn't depend on how little is held, with recursion on names at several levels."""
    rng = random.Random(14)
    raw = "".join(rng.choice("ab") for _ in range(3000)) + "abcabd" * 60
    t = np.append(np.frombuffer(raw.encode(), np.uint8).astype(np.uint16) + 1, np.zeros(58, np.uint16))
    deepest = []
    real = suffix.External.__init__

    def noted(self, folder, letters, depth, memory, level=0):
        deepest.append(level)
        real(self, folder, letters, depth, memory, level)

    suffix.External.__init__ = noted
    try:
        found = [suffix.suffix_array(t, 50, memory=m) for m in (7, 64, 1 << 20)]
    finally:
        suffix.External.__init__ = real
    assert max(deepest) >= 2
    for sa, common_ in found:
        text = [t[i : i + 50].tolist() for i in sa]
        assert text == sorted(text) and sorted(sa.tolist()) == list(range(len(raw)))
        assert all(c >= next((k for k in range(50) if x[k] != y[k]), 50) for x, y, c in zip(text, text[1:], common_[1:]))


def test_queue_keeps_little_in_memory(tmp_path):
    queue = suffix.DiskQueue(str(tmp_path), "q", False, 100)
    rng, want = np.random.default_rng(1), []
    for n in range(400):
        letter, size = int(rng.integers(1, 9)), int(rng.integers(1, 9))
        rows = np.arange(n * 10, n * 10 + size)
        queue.push(letter, rows, rows % 7)
        want += [(letter, int(x)) for x in rows]
        assert queue.held <= 100
    got = []
    while (c := queue.letter()) is not None:
        while len(part := queue.take(c, 5)):
            got += [(int(a), int(b)) for a, b, _ in part]
    assert got == sorted(want) and not list(tmp_path.iterdir())


def test_only_what_may_repeat_is_sorted(monkeypatch):
    """Segments that share an anchor and one side, or nothing else, aren't sorted whole, and no repeat is lost."""
    rng = random.Random(17)
    some = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    gram, left, right = some(24), some(26), some(26)
    segs = [(some(26) + gram + some(26), 26) for _ in range(300)]
    segs += [(some(26 - n) + left[26 - n :] + gram + right[:m] + some(26 - m), 26) for n in range(0, 27, 2) for m in range(0, 27, 2)]
    segs += [(left[k:] + gram + right, 26 - k) for k in range(27)]
    docs = [rng.randrange(40) for _ in segs]
    letters, given = [], []
    real, order = suffix.External.__init__, suffix.External.order

    def noted(self, folder, text, depth, memory, level=0, **options):
        letters.extend([len(text)] if not level else [])
        real(self, folder, text, depth, memory, level, **options)

    def counted(self):
        for part in order(self):
            given.extend(part[0].tolist() if not self.level else [])
            yield part

    monkeypatch.setattr(suffix.External, "__init__", noted)
    monkeypatch.setattr(suffix.External, "order", counted)
    want = {}
    for i, ((s, _), d) in enumerate(zip(segs, docs)):
        for k in range(len(s) - 49):
            want.setdefault(s[k : k + 50], []).append((d, i, k))
    want = {(i, k): min(v)[0] for v in want.values() for d, i, k in v if min(v)[0] < d}
    blocks = [
        ([np.full(n, 5), np.array([x[1] for x in segs[a : a + n]]), np.arange(a, a + n), np.array(docs[a : a + n]), np.array(docs[a : a + n])], [x[0] for x in segs[a : a + n]])
        for a, n in ((0, 200), (200, len(segs) - 200))
    ]
    for memory in (300, 1 << 20):
        letters.clear()
        given.clear()
        got = {}
        for columns, first, last, least in suffix.smallest_documents(blocks, 50, memory=memory):
            for (_, _, i, d, _), a, b, x in zip(columns.tolist(), first.tolist(), last.tolist(), least.tolist()):
                got |= {(i, k): x for k in range(a, b + 1) if x < d}
        assert got == want
        total = sum(len(s) for s, _ in segs)
        assert len(letters) == 1 and letters[0] < total * 0.4
        assert len(set(given)) == len(given) < letters[0] * 0.5


def test_segments_of_texts_in_one_buffer(monkeypatch):
    """Texts that lie one after another, cut anywhere: each window with a wanted anchor is in one segment, none joins two
    texts, and equal windows have one anchor at one place."""
    monkeypatch.setattr(suffix, "CHUNK", 97)
    rng = random.Random(18)
    passage = prose(rng, 40)
    texts = ["x", "a" * 130, *(prose(rng, rng.randrange(40)) + passage[rng.randrange(99) :] + "é" * rng.randrange(9) for _ in range(12)), "a" * 70, "", passage]
    column = pa.array(["before", *texts, "after" * 30]).slice(1, len(texts))
    raw = [t.encode() for t in texts]
    every = [suffix.anchor_hashes(part, 50, 24, ends) for _, part, ends in suffix._chunks(column, 50)]
    wanted = np.unique(np.concatenate([h for h, _ in every]))[::2]
    anchor, seen = {}, {}
    for a, part, ends in suffix._chunks(column, 50):
        begin = np.concatenate([[-a], ends[:-1]])
        for h, first, last, at, text in zip(*(x.tolist() for x in suffix.segments(part, 50, 24, ends, wanted))):
            for s in range(first, last + 1):
                window = raw[text][s - begin[text] : s - begin[text] + 50]
                assert len(window) == 50 and 0 <= at - s <= 26
                assert (text, s - begin[text]) not in seen
                seen[text, s - begin[text]] = h
                assert anchor.setdefault(window, (h, at - s)) == (h, at - s)
    keys = set(wanted.tolist())
    for t, b in enumerate(raw):
        for s in range(len(b) - 49):
            h = int(suffix.gram_hashes(np.frombuffer(b[s : s + 50], np.uint8), 24).min() >> suffix.CUT)
            assert (h in keys) == ((t, s) in seen)


@pytest.mark.parametrize("q", [3, 8, 13, 24, 25])
def test_gram_hashes(q):
    rng = random.Random(q)
    b = bytes(rng.choice(b"ab") for _ in range(3000)) + bytes(rng.choice(b"abc") for _ in range(9)) * 20
    h = suffix.gram_hashes(np.frombuffer(b, np.uint8), q).tolist()
    grams = [b[k : k + q] for k in range(len(b) - q + 1)]
    assert len(h) == len(grams) and len(set(h)) == len(set(grams)) == len(set(zip(h, grams)))


def test_shuffles_of_written_tables_go(spark):
    """A table's shuffle files go when it is written, not when the driver happens to collect garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    rows = spark.range(2000).selectExpr("id % 700 as k", "id").groupBy("k").agg(F.collect_list("id").alias("all"))
    before = shuffled()
    table = suffix.written(rows, "rows")
    end = time.time() + 10
    while (left := shuffled() - before) and time.time() < end:
        time.sleep(0.1)
    assert not left and table.count() == 700
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    common.drop(table)


@pytest.mark.parametrize("options", [{"hot": 1}, {"per_shard": 60}, {"hot": 2, "per_shard": 200}])
def test_repeats_of_hot_anchors(spark, options):
    rng = random.Random(15)
    passage = prose(rng, 14)
    rows = [(i, prose(rng, rng.randrange(3, 30)) + " " + passage[rng.randrange(20) :] + " " + prose(rng, rng.randrange(20))) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.remove(table, suffix.repeated_spans(table, **options)).collect()}
    assert got == brute_removed(rows, 50)


def test_ids_of_shards(spark):
    rng = random.Random(16)
    rows = [(rng.randrange(20), prose(rng, rng.randrange(40))) for _ in range(60)] + [(3, None)]
    enc, docs = common.encoder(common.vocabulary()), spark.createDataFrame(rows, "doc_id long, text string")
    out = sstable.read_shards(sstable.write_shards(docs, common.new_path(spark, "sst"), common.vocabulary(), per_shard=600)).collect()
    crc = lambda t: zlib.crc32(np.append(enc.whole(t or ""), np.uint32(2)).astype("<u4").tobytes())
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in out) == sorted((i, crc(t)) for i, t in rows)
    assert [r["doc_id"] for r in sorted(out, key=lambda r: r["start"])] == sorted(i for i, _ in rows)


def test_licence_files(spark):
    texts = {
        "MIT": "MIT License\n\nCopyright (c) 2020 Foo\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to deal\nin the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\".",
        "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.',
        "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "LGPL": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
        "AGPL-3.0": "# SPDX-License-Identifier: AGPL-3.0-or-later\nx = 1",
        "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that.",
        "Unlicense": "For more information, please refer to <http://unlicense.org/>",
        "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.\n" + "Copyright 2019 X\n" * 3000,
    }
    rows = list(texts.items()) + [("", "copyright" + " " * 200_000 + "x")]
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert {k: r["license"] for k, r in out.items()} == {k: k or None for k, _ in rows}
    assert out["BSD-2-Clause"]["n_sentences"] == 3001


def test_components_in_one_task_and_in_rounds(spark):
    rng = random.Random(19)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1 << 61, (1 << 61) + 1), (7, 7)]
    links = spark.createDataFrame(pairs, "u long, v long").repartition(5)
    par = {x: x for p in pairs for x in p if p[0] != p[1]}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            par[max(a, b)] = min(a, b)
    want = {x: find(x) for x in par}
    for most in (None, 0):
        assert {r["node"]: r["comp"] for r in common.components(links, one_task=most).collect()} == want
    assert common.components(links.limit(0)).count() == 0


def test_composed_machine_is_five_machines():
    """A clause read by the composed transducer ends where each machine by itself ends."""
    rng = random.Random(18)
    for _ in range(300):
        letters = [rng.randrange(6) for _ in range(rng.randrange(12))]
        count = lambda x, seq=letters: seq.count(x)

        def after(opener, seq=letters):
            if opener not in seq:
                return 0
            rest = seq[seq.index(opener) + 1 :]
            return 2 if {toxicity.INS, toxicity.THR} & set(rest) else 1

        want = (min(2, count(toxicity.INS)), min(1, count(toxicity.THR)), min(1, count(toxicity.TGT)), after(toxicity.NEG), after(toxicity.REP))
        machine, state = toxicity.Composed(), 0
        for x in letters:
            state = machine.step(state, x)
        alone = tuple(_run_alone(m, letters) for m in toxicity.MACHINES)
        assert machine.states[state] == alone == want


def _run_alone(step, letters):
    state = 0
    for x in letters:
        state = step(state, x)
    return state


def test_many_secrets_in_one_text(spark):
    rng = random.Random(17)
    text = " ".join("".join(rng.choice("0123456789abcdef") for _ in range(26)) if i % 2 else "Zx9" + "".join(rng.choice("KQ3Dz5") for _ in range(33)) for i in range(3000))
    out = secrets.with_spans(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string"), keep=("doc_id",)).first()
    want = []
    at = 0
    for i, w in enumerate(text.split(" ")):
        want.append((at, at + len(w), 2 if i % 2 else 3))
        at += len(w) + 1
    assert sorted((x["s"], x["e"], x["k"]) for x in [*out["__base"], *out["__added"]]) == want


def test_two_frequencies(spark):
    v = "Ab1" * 12 + "9z"
    rows = [(i, f"see {v}", "owner", f"repo{i % n}") for n in (6,) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = lambda **kw: secrets.with_spans(docs, keep=("doc_id",), **kw).first()
    assert found()["__added"] and not found(repo=("source", "lang"))["__added"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ["op3_decontaminate", "op6_near_duplicates", "op7_packing", "op8_suffix_dedup", "op9_sstable"])
def test_query_functions(spark, name):
    """Whole queries: what they say of each document agrees with brute force or an exact count."""
    from edgeloom.llm.queries import QUERIES

    docs = [(r["doc_id"], r["text"]) for r in common.read(spark, DATA, "documents").select("doc_id", "text").collect()]
    out = QUERIES[name](spark, DATA).collect()
    enc = common.encoder(common.vocabulary())
    if name == "op3_decontaminate":
        items = [" ".join(r["text"].lower().split()) for r in common.read(spark, DATA, "benchmark").collect()]
        whole = {i for i, t in docs if any(x in " ".join((t or "").lower().split()) for x in items)}
        assert whole <= {r["doc_id"] for r in out}
    elif name == "op6_near_duplicates":
        assert {r["doc_id"]: r["component_id"] for r in out} == brute_components(docs, 3, 85)
    elif name == "op7_packing":
        assert sum(r["length"] for r in out) == sum(len(enc.whole(t or "")) + 1 for _, t in docs)
        by = {}
        for r in out:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert all(sorted(v)[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(sorted(v), sorted(v)[1:])) and sum(n for _, n in v) <= 2048 for v in by.values())
    elif name == "op8_suffix_dedup":
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out} == brute_removed(docs, 50)
    else:
        at = 0
        texts = dict(docs)
        for r in sorted(out, key=lambda r: r["start"]):
            ids = np.append(enc.whole(texts[r["doc_id"]] or ""), np.uint32(2)).astype("<u4")
            assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
            at += r["n_tokens"]
