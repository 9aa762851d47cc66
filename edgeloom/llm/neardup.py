"""MinHash near-dedup (6): a multi-index Hamming join over b-bit signatures.

A document's shingle set gets a signature of K symbols of 16 bits, each the mixed
minimum of one hash of the set. Signatures are cut into m chunks of `WIDTH` symbols.
Two signatures that differ in at most d = 2m - 1 symbols have a chunk with at most
one differing symbol (pigeonhole), so a document is indexed under every chunk with
each one of its symbols left out, and every pair within distance d meets under a key.
m is chosen so that a pair at the similarity threshold exceeds d with a probability
under `MISS`; what meets is confirmed on the full sets.

Equal sets are one class first, so copies never pair up. Under a key, members are
compared with the key's smallest member, never all with all; components then tell
which keys still hold members that aren't joined, and only those members are
compared further: in keys of up to `SMALL` members across components, and for
larger ones exactly, across components, where rare shingles are shared: first with
one hub for each shingle, which is linear and joins what belongs to a large group, then
what is still apart and may link. No key's members ever meet in one task.

Defined cases: null and empty texts, and texts of white space only, have an empty
set, link with nothing and are kept; rows whose id is null are kept with a null
component; rows that share an id are one document, linked if any of them is (each
text is a class of its own, and the classes of an id are linked); equal rows are
one class; an empty table gives an empty result; other columns of the input are not
touched. Identifiers go through Arrow as they are, so all 64 bits count.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, binary, components, drop, mix, shingle_set, ship, written

WIDTH = 4
MISS = 2e-6
#: A key's members are compared across components directly up to this number; beyond it
#: `_sharing_rare` finds the pairs that may link, without loss.
SMALL = 64


def chunks_for(threshold: float, miss: float = MISS) -> int:
    """The least m with P(more than 2m - 1 of 4m symbols differ) < miss at the threshold."""
    p = 1 - threshold
    for m in range(4, 64):
        k, d = WIDTH * m, 2 * m - 1
        if sum(math.comb(k, i) * p**i * (1 - p) ** (k - i) for i in range(d + 1, k + 1)) < miss:
            return m
    raise ValueError("threshold too low for this index")


def _functions(k: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7919 + level)
    return rng.integers(1, 2**63, k, dtype=np.uint64) | np.uint64(1), rng.integers(1, 2**63, k, dtype=np.uint64)


def signatures(sets: list[np.ndarray], k: int, level: int = 0) -> np.ndarray:
    """16-bit symbols, one row of k for each nonempty set."""
    a, b = _functions(k, level)
    sizes = np.array([len(s) for s in sets])
    out = np.empty((len(sets), k), np.uint16)
    at = 0
    while at < len(sets):  # blocks of about a quarter million shingles
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 250_000)))
        h = np.concatenate(sets[at:end])
        starts = np.concatenate([[0], np.cumsum(sizes[at:end])[:-1]])
        for j in range(k):
            least = np.minimum.reduceat(h * a[j] + b[j], starts)
            out[at:end, j] = (mix(least) >> np.uint64(48)).astype(np.uint16)
        at = end
    return out


def keys(sig: np.ndarray) -> np.ndarray:
    """Index keys, a row for each signature: chunk, symbol left out and the rest, hashed."""
    n, k = sig.shape
    wide = sig.astype(np.uint64)
    out = np.empty((n, k), np.uint64)
    for j in range(k):
        c = j - j % WIDTH
        rest = np.zeros(n, np.uint64)
        for i in range(c, c + WIDTH):
            if i != j:
                rest = (rest << np.uint64(16)) | wide[:, i]
        out[:, j] = mix(mix(rest + np.uint64(1)) + np.uint64(j))
    return out.view(np.int64)


def sketch(docs: DataFrame, doc_id: str, text: str, words: int, m: int) -> DataFrame:
    """(id, n, cls, sig): set size, 128-bit hash of the set, signature bytes."""
    import pyarrow as pa
    import xxhash

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column("t").to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = [b""] * len(sets)
            if full:
                for i, row in zip(full, signatures([sets[i] for i in full], WIDTH * m)):
                    sig[i] = row.tobytes()
            n, cls = pa.array([len(s) for s in sets], pa.int64()), [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "n": n, "cls": pa.array(cls, pa.binary()), "sig": pa.array(sig, pa.binary())})

    ship(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(run, "id long, n long, cls binary, sig binary")


def _index(reps: DataFrame) -> DataFrame:
    """(key, id): each signature under its keys."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                k = keys(binary(batch.column("sig")).view(np.uint16).reshape(batch.num_rows, -1))
                yield pa.RecordBatch.from_pydict({"key": k.ravel(), "id": np.repeat(batch.column("id").to_numpy(), k.shape[1])})

    return reps.select("id", "sig").mapInArrow(run, "key long, id long")


def _near(pairs: DataFrame, reps: DataFrame, percent: int, far: int) -> DataFrame:
    """Of the pairs (u, v), those within signature distance `far` and of like size, with the distance."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (binary(batch.column(c)).view(np.uint16).reshape(batch.num_rows, -1) for c in ("su", "sv"))
                d = (x != y).sum(1).astype(np.int32)
                near = d <= far
                yield pa.RecordBatch.from_pydict({"u": batch.column("u").to_numpy()[near], "v": batch.column("v").to_numpy()[near], "d": d[near]})

    r = reps.select("id", "n", "sig")
    both = pairs.join(r.toDF("u", "nu", "su"), "u").join(r.toDF("v", "nv", "sv"), "v")
    both = both.where(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv"))
    return both.select("u", "v", "su", "sv").mapInArrow(run, "u long, v long, d int")


#: Up to so many documents (48 bytes each) are named to the readers by a broadcast; more by a shuffle join.
BROADCAST_IDS = 300_000
#: Rows with one or two full sets that go to a Python worker at a time.
SETS_AT_A_TIME = 64


class _Sets:
    """Confirms pairs on full sets: only the documents in question are read again, and
    a pair's sets meet in two equi-joins that Spark splits when one partner is hot."""

    def __init__(self, docs: DataFrame, reps: DataFrame, repeated: DataFrame, doc_id: str, text: str, words: int, percent: int):
        self.docs, self.words, self.percent = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("t")), words, percent
        self.reps, self.repeated = reps.select("id", "doc", "cls"), None if repeated.isEmpty() else repeated

    def of(self, ids: DataFrame) -> DataFrame:
        """(id, s): the full sets of classes, a written table; ids: (id)."""
        import pyarrow as pa
        import xxhash

        words = self.words

        def sets(batches):
            for batch in batches:
                own, out = batch.column("id").to_numpy(), []
                for t, cls in zip(batch.column("t").to_pylist(), batch.column("cls").to_pylist()):
                    raw = shingle_set(t, words).tobytes()
                    out.append(raw if xxhash.xxh3_128_digest(raw) == cls else None)
                on = np.array([x is not None for x in out], bool)
                yield pa.RecordBatch.from_pydict({"id": own[on], "s": pa.array([x for x in out if x is not None], pa.binary())})

        needed = self.reps.join(ids.distinct(), "id")
        n = ids.distinct().count()
        found = self.docs.join(F.broadcast(needed) if n <= BROADCAST_IDS else needed, "doc").select("id", "cls", "t", "doc")
        kind = "id long, s binary"
        if self.repeated is None:
            return written(found.mapInArrow(sets, kind), "sets")
        # of rows that share their id and text, one stands for all
        once = found.join(self.repeated, "doc", "left_anti").mapInArrow(sets, kind)
        more = found.join(self.repeated, "doc", "left_semi").mapInArrow(sets, kind)
        return written(once.union(more.dropDuplicates(["id"])), "sets")

    def linked(self, pairs: DataFrame, s: DataFrame) -> DataFrame:
        """The pairs (u, v) that reach the threshold, a written table."""
        import pyarrow as pa

        percent = self.percent

        def run(batches):
            for batch in batches:
                on = np.zeros(batch.num_rows, bool)
                for i, (x, y) in enumerate(zip(batch.column("a"), batch.column("b"))):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    on[i] = 100 * both >= percent * (len(x) + len(y) - both)
                yield pa.RecordBatch.from_pydict({c: batch.column(c).to_numpy()[on] for c in ("u", "v")})

        both = pairs.select("u", "v").distinct().join(s.toDF("u", "a"), "u").join(s.toDF("v", "b"), "v")
        with batch_rows(pairs.sparkSession, SETS_AT_A_TIME):
            return written(both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long"), "links")


class _Joined:
    """Components by the links found so far."""

    def __init__(self):
        self.comp: DataFrame | None = None

    def add(self, links: DataFrame) -> None:
        """links is a written table, and goes."""
        if not links.isEmpty():
            old = self.comp
            self.comp = components(links if old is None else old.toDF("u", "v").union(links.select("u", "v")))
            if old is not None:
                drop(old)
        drop(links)

    def of(self, ids: DataFrame, column: str = "id", name: str = "c") -> DataFrame:
        """ids with the component that each is in by now."""
        if self.comp is None:
            return ids.withColumn(name, F.col(column))
        return ids.join(self.comp.select(F.col("node").alias(column), F.col("comp").alias(name)), column, "left").withColumn(name, F.coalesce(name, column))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) whose ends aren't in one component yet."""
        return self.of(self.of(pairs, "u", "cu"), "v", "cv").where("cu <> cv").select("u", "v")


#: Counters of the sketch by which shingles are ordered: so many bits at least and at most (32 MB), and counters of a block.
SKETCH_BITS, SKETCH_BLOCK = (16, 24), 1 << 12


def _frequencies(s: DataFrame, bits: int) -> np.ndarray:
    """How many shingles of (id, s) have each value of their first `bits` bits, up to 65,535. Tasks
    send what they counted by blocks; the result has a fixed size whatever the table's is."""
    import pyarrow as pa

    shift = np.uint64(64 - bits)
    kinds = pa.schema([("block", pa.int32()), ("n", pa.binary())])

    def rows(counts: np.ndarray):
        blocks = counts.reshape(-1, SKETCH_BLOCK)
        some = np.flatnonzero(blocks.any(1))
        for at in range(0, len(some), 64):
            part = some[at : at + 64]
            out = [zlib.compress(np.minimum(blocks[i], 65_535).astype(np.uint16).tobytes(), 1) for i in part]
            yield pa.RecordBatch.from_pydict({"block": part.astype(np.int32), "n": pa.array(out, pa.binary())}, schema=kinds)

    def count(batches):
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            if batch.num_rows:
                at, n = np.unique(binary(batch.column("s")).view(np.uint64) >> shift, return_counts=True)
                counts[at.astype(np.int64)] += n.astype(np.uint32)
        yield from rows(counts)

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, n in zip(batch.column("block").to_pylist(), batch.column("n").to_pylist()):
                n = np.frombuffer(zlib.decompress(n), np.uint16)
                held[block] = np.minimum(held[block] + n, 65_535) if block in held else n.astype(np.uint32)
        out = [(b, n.astype(np.uint16).tobytes()) for b, n in held.items()]
        yield pa.RecordBatch.from_pydict({"block": pa.array([b for b, _ in out], pa.int32()), "n": pa.array([n for _, n in out], pa.binary())})

    counts = np.zeros((1 << bits) // SKETCH_BLOCK * SKETCH_BLOCK, np.uint16).reshape(-1, SKETCH_BLOCK)
    kind = "block int, n binary"
    for block, n in s.select("s").mapInArrow(count, kind).repartition("block").mapInArrow(add, kind).toLocalIterator():
        counts[block] = np.frombuffer(n, np.uint16)
    return counts.ravel()


def _rare(s: DataFrame, percent: int) -> DataFrame:
    """(g, id, n, r): the shingles of a set, from (id, s), that a link must share, by rarity.

    Sets that reach the threshold share a shingle among the first
    n - ceil(n * percent / 100) + 1 of each in any common order, so no link is lost, and in
    order of rarity the edits that keep a near copy out of a group come first: it meets
    the members it may link with, not all of the group. Rarity is told by a sketch of a
    fixed size: any counts give a common order, better ones a more selective one. Shingles
    that it counts once are in one set only and needn't go on."""
    import pyarrow as pa

    total = s.agg(F.sum(F.octet_length("s"))).first()[0] or 0
    bits = min(max((total // 8).bit_length() + 1, SKETCH_BITS[0]), SKETCH_BITS[1])
    counts = s.sparkSession.sparkContext.broadcast(_frequencies(s, bits))
    shift = np.uint64(64 - bits)

    def each(batches):
        for batch in batches:
            gs, ids, ns, rs = [], [], [], []
            for i, raw in zip(batch.column("id").to_pylist(), batch.column("s")):
                own = np.frombuffer(raw.as_buffer(), np.uint64)
                n = len(own)
                f = counts.value[(own >> shift).astype(np.int64)]
                order = np.lexsort((own, f))[: n - -(-n * percent // 100) + 1]
                r = np.flatnonzero(f[order] > 1)
                gs.append(own[order[r]].view(np.int64))
                rs.append(r + 1)
                ids.append(np.full(len(r), i, np.int64))
                ns.append(np.full(len(r), n, np.int64))
            if gs:
                yield pa.RecordBatch.from_pydict({k: np.concatenate(v) for k, v in (("g", gs), ("id", ids), ("n", ns), ("r", rs))})

    out = written(s.mapInArrow(each, "g long, id long, n long, r long"), "rare")
    counts.destroy()
    return out


def _may_link(percent: int, nx="nx", rx="rx", ny="ny", ry="ry"):
    """At the first shingle that two sets share, what is left of both bounds their intersection."""
    most = F.least(F.col(nx) - F.col(rx), F.col(ny) - F.col(ry)) + 1
    return (100 + percent) * most >= percent * (F.col(nx) + F.col(ny))


def _hub_pairs(rare: DataFrame, joined: _Joined, percent: int) -> DataFrame:
    """Pairs of each row of rare with its shingle's hub: the member with least before that
    shingle, which is the one with fewest edits of its own. As many pairs as rows."""
    rows = joined.of(rare)
    hub = rows.groupBy("g").agg(F.min(F.struct("r", "id", "n", "c")).alias("h")).select("g", F.col("h.id").alias("y"), F.col("h.n").alias("ny"), F.col("h.r").alias("ry"), F.col("h.c").alias("cy"))
    pairs = rows.join(hub, "g").withColumnsRenamed({"n": "nx", "r": "rx"}).where((F.col("c") != F.col("cy")) & _may_link(percent))
    return pairs.select(F.greatest("id", "y").alias("u"), F.least("id", "y").alias("v")).distinct()


def _open_pairs(rare: DataFrame, joined: _Joined, percent: int) -> DataFrame:
    """Pairs in different components that share a shingle of rare and may link by it."""
    rows = written(joined.of(rare), "rows")
    by = rows.groupBy("g", "c").agg(F.count("*").alias("k"))
    main = by.groupBy("g").agg(F.max_by("c", F.struct("k", "c")).alias("main"), F.count("*").alias("comps")).where("comps > 1")
    # members outside a shingle's largest component, against all under that shingle
    few = rows.join(main, "g").where("c <> main").selectExpr("g", "id as x", "c as cx", "n as nx", "r as rx")
    rest = rows.selectExpr("g", "id as y", "c as cy", "n as ny", "r as ry")
    pairs = few.join(rest, (few["g"] == rest["g"]) & (F.col("cx") != F.col("cy")) & _may_link(percent))
    out = written(pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "pairs")
    drop(rows)
    return out


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs: documents whose
    sets of `words`-word shingles have 100 * intersection >= percent * union are
    linked, a component is named by its smallest id, and that document is kept."""
    m = chunks_for(percent / 100)
    far, ratio = 2 * m - 1, percent / 100
    # rows get a number of their own: a class is named by its least one, whatever the identifiers are
    sk = written(sketch(docs, doc_id, text, words, m).withColumn("row", F.monotonically_increasing_id()), "sketch")
    members = sk.where("n > 0 and id is not null")
    classes = written(members.groupBy("cls").agg(F.min("row").alias("row")), "classes")
    reps = written(members.join(classes.select("row"), "row", "left_semi").select(F.col("row").alias("id"), F.col("id").alias("doc"), "cls", "n", "sig"), "reps")
    repeated = written(members.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").select(F.col("id").alias("doc")), "repeated")
    sets, joined = _Sets(docs, reps, repeated, doc_id, text, words, percent), _Joined()
    ends = lambda pairs: pairs.select(F.explode(F.array("u", "v")).alias("id"))

    if sets.repeated is not None:  # the classes of one identifier are linked
        own = members.join(repeated.withColumnRenamed("doc", "id"), "id", "left_semi").select("id", "cls").distinct().join(classes, "cls")
        least = own.groupBy("id").agg(F.min("row").alias("v"))
        joined.add(written(own.join(least, "id").where("row <> v").select(F.col("row").alias("u"), "v"), "same"))

    def groups(index: DataFrame) -> DataFrame:
        """(key, id, pivot, size) for keys with two members or more."""
        g = index.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("size")).where("size > 1")
        return written(index.join(g, "key"), "groups")

    index = groups(_index(reps))
    star = index.where("id <> pivot").select(F.col("id").alias("u"), F.col("pivot").alias("v")).distinct()
    star = written(_near(star, reps, percent, far), "stars")
    # one confirmed partner for each document settles most components: its smallest likely one
    likely = F.struct((F.col("d") > (1 - ratio) * WIDTH * m).alias("far"), "v")
    s = sets.of(ends(star))
    joined.add(sets.linked(star.groupBy("u").agg(F.min(likely).alias("b")).select("u", "b.v"), s))
    joined.add(sets.linked(joined.apart(star.select("u", "v")), s))
    drop(s)
    drop(star)

    # keys whose members are still in several components
    held = joined.of(index)
    mixed = held.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    left = written(held.join(mixed, "key", "left_semi"), "open")
    drop(index)
    small = left.where(F.col("size") <= SMALL)
    a, b = small.select("key", F.col("id").alias("v"), F.col("c").alias("cv")), small.select("key", F.col("id").alias("u"), F.col("c").alias("cu"))
    cross = a.join(b, "key").where("u > v and cu <> cv").select("u", "v").distinct()
    near = written(_near(cross, reps, percent, far).select("u", "v"), "near")
    s = sets.of(ends(near))
    joined.add(sets.linked(near, s))
    drop(s)
    drop(near)
    rest = written(left.where(F.col("size") > SMALL).select("id").distinct(), "rest")
    drop(left)
    if not rest.isEmpty():
        s = sets.of(rest)
        rare = _rare(s, percent)
        joined.add(sets.linked(_hub_pairs(rare, joined, percent), s))
        pairs = _open_pairs(rare, joined, percent)
        joined.add(sets.linked(pairs, s))
        for table in (s, rare, pairs):
            drop(table)
    drop(rest)

    # a component is named by its smallest identifier
    by_class = joined.of(classes.withColumnRenamed("row", "id")).select("cls", "c")
    inside = members.select("id", "n", "cls").join(by_class, "cls").select("id", "n", "c")
    name = inside.groupBy("c").agg(F.min("id").alias("own"))
    outside = sk.where("n = 0 or id is null").select("id", "n", F.col("id").alias("own"))
    out = inside.join(name, "c").select("id", "n", "own").unionByName(outside)
    out = written(out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("own").alias("component_id"), F.coalesce(F.col("id") == F.col("own"), F.lit(True)).alias("kept")), "judged")
    for table in (sk, classes, reps, repeated, *([joined.comp] if joined.comp is not None else [])):
        drop(table)
    return out


def op6_near_duplicates(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return near_duplicates(read(spark, sf_dir, "documents"), words=3, percent=85)
