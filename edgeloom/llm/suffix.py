"""Suffix-array dedup (8): external induced sorting of repeated regions.

The question: which bytes lie in a string of `length` bytes that also starts in a
document with a smaller identifier. It is answered in four steps.
A text that a smaller document has too, whole, goes at once and takes no further part.

1  Anchors. Of every `length`-byte window the q-gram with the least hash is its anchor
   (a minimizer), so equal windows have equal anchors. Each task settles what it can by
   itself: an anchor that two documents of one block hold is shared, and only its first
   and last document go on. The rest goes to shards by range of the hash, a row for each
   shard and block, so a common anchor sends two entries a block however many hold it.
2  Segments. In documents with shared anchors, the windows of one anchor occurrence are
   one segment, 50 to 50 + w - 1 bytes. Segments that hold no shared anchor can't repeat,
   so what goes on is the repeated part of the corpus and little else. Equal segments are
   one, with their smallest document (combined before the shuffle), so a text that a
   third of all documents copy is sorted once. An anchor with more than `HOT` different
   segments is spread by the bytes beside it: each of its windows holds 13 of them on one side.
3  Sorting. A shard's distinct segments stream into a text on disk, without the sides whose 13
   bytes beside the anchor one document has alone, as nothing there repeats (`Sides`). Its suffix
   array with common prefix lengths comes by induced sorting there (`External`), for the suffixes
   that are windows and the few that these are induced from: substrings between
   starred suffixes are sorted by distribution over files and named; the string of names
   is sorted by recursion, or in memory once it has at most `BASE` times `memory` names;
   L-suffixes and then S-suffixes follow from priority queues on disk ordered by (first
   letter, arrival), whose tuples carry the suffix and its common prefix with the one
   before it. All of it works on blocks of `memory` entries; the text, the queues' runs and
   the orders are files, in the folder that Spark names for a task's own spill.
   Suffixes are told apart to `length` bytes only, which is all that the question needs.
   Neighbours whose common prefix reaches `length` are one string: its smallest document
   is known.
4  Spans. Each segment's windows with their smallest document go back to its occurrences,
   and a document's covered bytes are the union.

Every step's shuffle carries at most a few bytes for each byte of text.

Defined cases: null text is empty; texts under `length` bytes keep everything; rows
that share an identifier aren't smaller than one another, and each is judged by itself;
a null identifier is larger than all others (and ranks with 2^63 - 1); an empty table
gives an empty result; only the identifier and the text are read.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, drop, ship, shuffles_dropped
from .common import written as written_table

LENGTH, Q = 50, 24
#: Anchors of one shard and bytes of segments of one, about.
PER_SHARD, SEGMENT_BYTES = 500_000, 1_500_000
#: Entries of a block; twice as many of a queue or an order are held, and BASE times as many
#: of a plain array or of names that are sorted without a further level. The rest is on disk.
MEMORY, BASE = 500_000, 4
#: Different segments beyond which an anchor is spread, and the bytes beside it that spread it.
HOT, BESIDE = 20_000, 13
#: Bytes of text whose anchors are found at a time, anchors of a block, and rows given on together.
CHUNK, BLOCK, ROWS = 1 << 17, 400_000, 100_000
#: Up to so many ids (16 MB) are broadcast to pick documents.
BROADCAST_IDS = 1_000_000
NULL_ID = (1 << 63) - 1
#: Places of the table that tells which sides of a shard's segments several documents have.
SLOTS = 1 << 20
#: Anchor hashes keep their first 40 bits: chance equals only add segments to sort.
CUT = np.uint64(24)


# --- 1: anchors ------------------------------------------------------------------


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by doubling."""
    width, m = 1, x
    while width * 2 <= w:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return np.minimum(m[: len(m) - (w - width)], m[w - width :]) if w > width else m


def gram_hashes(b: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q bytes from each place on, eight at a time."""
    width, n = min(q, 8), len(b) - q + 1
    if width == 8:
        word = np.array(np.ndarray(len(b) - 7, np.uint64, b, 0, (1,)))  # the eight bytes from each place on
    else:
        word = np.zeros(n, np.uint64)
        for k in range(width):
            word = word << np.uint64(8) | b[k : k + n]
    h = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    for at in [*range(width, q - width, width), *([q - width] if q > width else [])]:
        h ^= h >> np.uint64(32)
        h += word[at : at + n]
        h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h


def _runs(b: np.ndarray, length: int, q: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each q-gram, least hash of each window, first window, last window, text) of the runs of windows with one
    least hash, in texts that lie one after another in b and end at `ends`; the last may end beyond it."""
    h = gram_hashes(b, q)
    least = _least(h, length - q + 1)
    new = np.empty(len(least), bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    for edge in (ends, ends - length + 1):  # a text's first window, and the first that doesn't lie in it
        new[edge[(edge > 0) & (edge < len(new))]] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(least)) - 1
    text = np.searchsorted(ends, first, side="right")
    on = first + length <= ends[text]
    return h, least, first[on], last[on], text[on]


def anchor_hashes(b: np.ndarray, length: int, q: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least hash, cut to its first 40 bits, text) of the runs of _runs."""
    _, least, first, _, text = _runs(b, length, q, ends)
    return least[first] >> CUT, text


def segments(b: np.ndarray, length: int, q: int, ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, first window, last window, place of the anchor, text) of the occurrences of wanted anchors. Of
    equal least hashes in a window the last is the anchor: that depends on the window alone."""
    h, least, first, last, text = _runs(b, length, q, ends)
    keys = least[first] >> CUT
    on = wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys
    first, last, text = first[on], last[on], text[on]
    value = least[first]

    def met(start: np.ndarray, value: np.ndarray, sign: int) -> np.ndarray:
        """The place nearest to each start where the hash is the value, among those of a window."""
        place, todo = np.empty(len(start), np.int64), np.arange(len(start))
        for k in range(length - q + 1):
            at = start[todo] + sign * k
            hit = h[at] == value[todo]
            place[todo[hit]] = at[hit]
            todo = todo[~hit]
            if not len(todo):
                break
        return place

    place = met(last + length - q, value, -1)  # a run's last anchor, which most often is its only one
    several = met(first, value, 1) < place
    if several.any():
        some = np.flatnonzero(several)
        size = last[some] - first[some] + 1
        begin = np.cumsum(size) - size
        own = np.arange(size.sum()) - np.repeat(begin - first[some], size)
        each, run = met(own + length - q, np.repeat(value[some], size), -1), np.repeat(some, size)
        cut = np.concatenate([[0], np.flatnonzero((np.diff(each) != 0) | (np.diff(run) != 0)) + 1])
        join = lambda x, y: np.concatenate([x[~several], y])
        first, last, place = join(first, own[cut]), join(last, own[np.append(cut[1:], len(own)) - 1]), join(place, each[cut])
        value, text = join(value, value[run[cut]]), join(text, text[run[cut]])
    return value >> CUT, first, last, place, text


def _packed(h: np.ndarray) -> bytes:
    """40-bit hashes in order, byte plane by byte plane: what order makes alike lies together."""
    return h.byteswap().view(np.uint8).reshape(-1, 8)[:, 3:].T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(5, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 3:] = planes.T
    return out.view(np.uint64).ravel().byteswap()


def _chunks(column, length: int):
    """Of an Arrow column of texts: (place, bytes from there on, ends of its texts from there on), where each window
    of `length` bytes starts in one of them."""
    import pyarrow as pa

    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    places = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    b = np.frombuffer(column.buffers()[2] or b"", np.uint8)[places[0] : places[-1]]
    ends = places[1:] - places[0]
    for a in range(0, len(b) - length + 1, CHUNK):
        yield a, b[a : a + CHUNK + length - 1], ends - a


def _blocks(h: np.ndarray, d: np.ndarray, ids: np.ndarray, shards: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """(shard, hashes, doc, ids) of a block's anchors h of documents d: packed
    hashes in order, the index of each one's document, and the identifiers of these. Shard -1
    has the anchors that two documents of the block hold; their extremes go on to others too."""
    both = np.sort(h << np.uint64(16) | d.astype(np.uint64))  # 40 bits of hash, 16 of the document's index
    both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    h, d = both >> np.uint64(16), (both & np.uint64(0xFFFF)).astype(np.int64)
    own = ids[d]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    size = np.diff(np.append(start, len(h)))
    low, high = np.minimum.reduceat(own, start), np.maximum.reduceat(own, start)
    known = np.repeat(low < high, size)
    # one entry with the smallest identifier and one with the largest
    first = np.flatnonzero(own == np.repeat(low, size))
    last = np.flatnonzero(known & (own == np.repeat(high, size)))
    on = np.sort(np.concatenate([first[np.concatenate([[True], h[first[1:]] != h[first[:-1]]])], last[np.concatenate([[True], h[last[1:]] != h[last[:-1]]])] if len(last) else last]))

    def packed(shard: int, pick: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
        docs, index = np.unique(d[pick], return_inverse=True)
        return shard, _packed(h[pick]), index.astype(np.uint16).tobytes(), ids[docs].tobytes()

    cut = np.searchsorted(h[on], np.arange(shards + 1, dtype=np.float64) * (2**40 / shards))
    rows = [packed(s, on[a:b]) for s, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
    return rows + ([packed(-1, np.flatnonzero(known))] if known.any() else [])


def _anchor_rows(docs: DataFrame, length: int, q: int, shards: int) -> DataFrame:
    """The rows of _blocks for all of docs (id, t)."""
    import pyarrow as pa

    names = ("shard", "hashes", "doc", "ids")
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())

    def run(batches):
        hs, ix, ids, held, n = [], [], [], 0, 0

        def flush():
            rows = _blocks(np.concatenate(hs), np.concatenate(ix), np.concatenate(ids), shards)
            return pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, k, c in zip(names, kinds, zip(*rows))})

        for batch in (whole.slice(a, 10_000) for whole in batches for a in range(0, whole.num_rows, 10_000)):
            own = batch.column("id").to_numpy()
            for _, part, ends in _chunks(batch.column("t"), length):
                h, text = anchor_hashes(part, length, q, ends)
                if not len(h):
                    continue
                more = not hs or ids[-1] is not own
                if hs and (held + len(h) > BLOCK or n + more * len(own) > 60_000):
                    yield flush()
                    hs, ix, ids, held, n, more = [], [], [], 0, 0, True
                if more:
                    ids.append(own)
                    n += len(own)
                hs.append(h)
                ix.append(text + (n - len(own)))
                held += len(h)
        if held:
            yield flush()

    return docs.select("id", "t").mapInArrow(run, "shard int, hashes binary, doc binary, ids binary")


def _entries(batch) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, identifiers) of packed rows."""
    h = [_unpacked(x) for x in batch.column("hashes").to_pylist()]
    own = [np.frombuffer(i, np.int64)[np.frombuffer(x, np.uint16)] for x, i in zip(batch.column("doc").to_pylist(), batch.column("ids").to_pylist())]
    return np.concatenate([np.empty(0, np.uint64), *h]), np.concatenate([np.empty(0, np.int64), *own])


def _shared(packed: DataFrame, shards: int) -> DataFrame:
    """(id, h): anchors that several documents hold, for each of the documents."""
    import pyarrow as pa

    def out(h, own):
        for a in range(0, len(h), ROWS):
            yield pa.RecordBatch.from_pydict({"id": own[a : a + ROWS], "h": h[a : a + ROWS].view(np.int64)})

    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield _entries(batch.slice(i, 1))

    def known(batches):
        for h, own in rows(batches):
            yield from out(h, own)

    def met(batches):
        found = list(rows(batches))
        if found:
            h, own = (np.concatenate(x) for x in zip(*found))
            del found
            order = np.argsort(h)
            h, own = h[order], own[order]
            start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
            several = np.minimum.reduceat(own, start) < np.maximum.reduceat(own, start) if len(h) else np.empty(0, bool)
            on = np.repeat(several, np.diff(np.append(start, len(h))))
            yield from out(h[on], own[on])

    kind = "id long, h long"
    dealt = packed.where("shard >= 0").repartitionById(shards, F.col("shard"))
    return dealt.mapInArrow(met, kind).union(packed.where("shard < 0").mapInArrow(known, kind))


# --- 2: segments -----------------------------------------------------------------


def _segments(docs: DataFrame, length: int, q: int) -> DataFrame:
    """(id, x, pos, h, at, seg) of the occurrences of shared anchors, from (id, x, t, hs); at:
    the anchor's place in the segment."""
    import pyarrow as pa

    def run(batches):
        names, kinds = ("id", "x", "pos", "h", "at"), (*[pa.int64()] * 4, pa.int32())

        def rows(held, segs):
            columns = {n: pa.array(np.concatenate(v), k, safe=False) for n, v, k in zip(names, zip(*held), kinds)}
            return pa.RecordBatch.from_pydict(columns | {"seg": pa.array(segs, pa.binary())})

        for batch in batches:
            held, segs = [], []
            wanted = np.unique(batch.column("hs").flatten().to_numpy().view(np.uint64))  # a shared anchor is one wherever it stands
            ids, keys = batch.column("id").to_numpy(), batch.column("x").to_numpy()
            for a, part, ends in _chunks(batch.column("t"), length):
                raw = part.tobytes()
                h, first, last, at, text = segments(part, length, q, ends, wanted)
                begin = np.concatenate([[-a], ends[:-1]])[text]
                held.append((ids[text], keys[text], first - begin, h.view(np.int64), at - first))
                segs += [raw[p:e] for p, e in zip(first.tolist(), (last + length).tolist())]
                if len(segs) > ROWS:
                    yield rows(held, segs)
                    held, segs = [], []
            if segs:
                yield rows(held, segs)

    return docs.select("id", "x", "t", "hs").mapInArrow(run, "id long, x long, pos long, h long, at int, seg binary")


def spread(segs: DataFrame, length: int, q: int, hot: int = HOT) -> DataFrame:
    """(h, k, off, at, key, seg, least, most) from (h, k, at, seg, least, most): what is sorted
    together has one key. Segments of hot anchors become two, of the windows with at least
    BESIDE bytes after the anchor and of the others, which have as many before it."""
    count = segs.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("h", F.lit(True).alias("hot"))
    both = segs.join(count, "h", "left")
    n, at = F.octet_length("seg"), F.col("at")
    sub = lambda lo, hi: F.substring("seg", (lo + 1).cast("int"), (hi - lo).cast("int"))
    # windows that start at `cut` or after it have at most length - q - BESIDE bytes before the anchor
    cut = F.greatest(F.lit(0), at - (length - q - BESIDE))
    key = lambda side, x: F.xxhash64("h", F.lit(side), x)
    whole = F.struct(F.lit(0).alias("off"), at.alias("at"), F.col("h").alias("key"), F.col("seg").alias("seg"))
    after = F.struct(cut.cast("int").alias("off"), (at - cut).cast("int").alias("at"), key(1, sub(at + q, at + q + BESIDE)).alias("key"), sub(cut, n).alias("seg"))
    before = F.struct(F.lit(0).alias("off"), at.alias("at"), key(2, sub(at - BESIDE, at)).alias("key"), sub(F.lit(0), F.least(n, cut - 1 + length)).alias("seg"))
    parts = F.when(F.col("hot").isNull(), F.array(whole)).otherwise(F.filter(F.array(F.when(n - cut >= length, after), F.when(cut > 0, before)), lambda x: x.isNotNull()))
    out = both.select("h", "k", "least", "most", F.explode(parts).alias("p"))
    return out.select("h", "k", F.col("p.off").alias("off"), F.col("p.at").alias("at"), F.col("p.key").alias("key"), F.col("p.seg").alias("seg"), "least", "most")


# --- 3: external induced sorting ---------------------------------------------------


def scratch() -> str | None:
    """Where a task may spill: the folders that Spark names for that."""
    return (os.environ.get("SPARK_LOCAL_DIRS") or "").split(",")[0] or None


def room(folder: str, name: str, n: int, memory: int, dtype=np.int64) -> np.ndarray:
    """An array of n values: in memory up to BASE * memory of them, else a file mapped into it."""
    if n <= BASE * memory:
        return np.zeros(n, dtype)
    return np.asarray(np.memmap(os.path.join(folder, name), dtype, "w+", shape=(n,)))


class Rows:
    """Rows of int64 values, written block by block and then read by place: held up to
    `memory` of them, in a file beyond."""

    def __init__(self, path: str, width: int, memory: int):
        self.path, self.width, self.memory, self.n = path, width, memory, 0
        self.held: list[np.ndarray] = []
        self.out = None

    def add(self, *columns: np.ndarray) -> None:
        self.put(np.stack(columns, axis=1).astype(np.int64, copy=False))

    def put(self, part: np.ndarray) -> None:
        self.n += len(part)
        if self.out is None and self.n <= self.memory:
            self.held.append(part)
            return
        if self.out is None:
            self.out = open(self.path, "wb")
            for x in self.held:
                self.out.write(np.ascontiguousarray(x).data)
            self.held = []
        self.out.write(np.ascontiguousarray(part).data)

    def done(self) -> Rows:
        if self.out is not None:
            self.out.close()
            self.at = np.asarray(np.memmap(self.path, np.int64, "r", shape=(self.n, self.width)))
        else:
            self.at = np.concatenate(self.held) if self.held else np.empty((0, self.width), np.int64)
            self.held = []
        return self

    def blocks(self, size: int):
        for a in range(0, self.n, size):
            yield np.array(self.at[a : a + size])

    def drop(self) -> None:
        self.at = None
        if self.out is not None:
            os.remove(self.path)


class Tape:
    """Rows (letter, suffix, common), those of a letter together, taken from either end."""

    def __init__(self, rows: Rows, backward: bool):
        self.rows, self.backward, self.lo, self.hi = rows, backward, 0, rows.n

    def letter(self) -> int | None:
        return None if self.lo >= self.hi else int(self.rows.at[self.hi - 1 if self.backward else self.lo, 0])

    def extent(self, letter: int, most: int) -> int:
        """How many of the next rows have the letter, up to `most`."""
        at, n = self.rows.at, min(most, self.hi - self.lo)
        here = lambda k: at[self.hi - 1 - k if self.backward else self.lo + k, 0] == letter
        if not n or not here(0):
            return 0
        low, step = 0, 1
        while low + step < n and here(low + step):
            low, step = low + step, 2 * step
        high = min(n, low + step)  # low has the letter, high has not or is the end
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if here(mid) else (low, mid)
        return low + 1

    def take(self, letter: int, most: int) -> np.ndarray:
        """Up to `most` of the next rows, if they have the letter, in reading order. Backward, a
        row's common value is with the row read before it, and with none for a letter's first."""
        n = self.extent(letter, most)
        if not n:
            return np.empty((0, 3), np.int64)
        if not self.backward:
            part = np.array(self.rows.at[self.lo : self.lo + n])
            self.lo += n
            return part
        part = self.rows.at[self.hi - n : self.hi][::-1].copy()
        above = self.rows.at[self.hi] if self.hi < self.rows.n else None
        part[1:, 2] = part[:-1, 2].copy()
        part[0, 2] = above[2] if above is not None and above[0] == letter else 0
        self.hi -= n
        return part


class DiskQueue:
    """An external priority queue of (letter, suffix, common), ordered by (letter, arrival).

    Arrivals are held by letter up to `memory` of them, then written as a run in the order of
    letters. A letter's rows come from the runs, oldest first, and then from what is held,
    so that the order of arrival, which is the order of rank, needs no comparison."""

    def __init__(self, folder: str, name: str, backward: bool, memory: int):
        self.folder, self.name, self.sign, self.memory = folder, name, -1 if backward else 1, memory
        self.runs: list[tuple[Rows, Tape]] = []
        self.own: dict[int, list[np.ndarray]] = {}
        self.held, self.made = 0, 0

    def push(self, letter: int, suffix: np.ndarray, common: np.ndarray) -> None:
        self.own.setdefault(letter, []).append(np.stack([np.full(len(suffix), self.sign * letter), suffix, common], axis=1))
        self.held += len(suffix)
        if self.held > self.memory:
            rows = Rows(os.path.join(self.folder, f"{self.name}-{self.made}"), 3, 0)
            for c in sorted(self.own, key=lambda c: self.sign * c):
                for part in self.own[c]:
                    rows.put(part)
            self.runs.append((rows.done(), Tape(rows, False)))
            self.own, self.held, self.made = {}, 0, self.made + 1

    def letter(self) -> int | None:
        """The next letter in order."""
        heads = [x for _, tape in self.runs if (x := tape.letter()) is not None] + [self.sign * c for c in self.own]
        return self.sign * min(heads) if heads else None

    def take(self, letter: int, most: int) -> np.ndarray:
        for rows, tape in self.runs:
            part = tape.take(self.sign * letter, most)
            if len(part):
                if tape.letter() is None:
                    self.runs.remove((rows, tape))
                    rows.drop()
                part[:, 0] = letter
                return part
        parts = self.own.get(letter)
        if not parts:
            return np.empty((0, 3), np.int64)
        n, k = 0, 0
        while k < len(parts) and (not k or n + len(parts[k]) <= most):
            n += len(parts[k])
            k += 1
        out = np.concatenate(parts[:k])
        if k < len(parts):
            self.own[letter] = parts[k:]
        else:
            del self.own[letter]
        self.held -= n
        out[:, 0] = letter
        return out


def _range_min(common: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Minimum of common[start + 1 : stop + 1] for stops in order, each start below its stop."""
    edges = np.empty(2 * len(start), np.int64)
    edges[0::2], edges[1::2] = start + 1, stop + 1
    padded = np.append(common, common[-1:])
    return np.minimum.reduceat(padded, edges)[0::2]


#: What is letter in four places of a text.
LETTERS = np.uint64(0xFFFEFFFEFFFEFFFE)


class External:
    """The order of the suffixes of a text on disk, to `depth` letters.

    The text is a file of letters, where zeros separate parts and at least depth + 8 of
    them end it; suffixes that start with a zero are left out. It is kept as
    2 * letter + type, type 1 for S-suffixes (smaller than the next) and for zeros.
    With `whole` unset, the suffixes with fewer than `depth` letters before their zero are
    left out too, but for those right of a part's last asked one up to the next starred
    suffix: that, or the zero, is what the part's suffixes are induced from."""

    def __init__(self, folder: str, letters: np.ndarray, depth: int, memory: int, level: int = 0, whole: bool = True):
        self.folder, self.depth, self.memory, self.level, self.n = folder, depth, memory, level, len(letters)
        # common prefixes are carried where they are asked for; in the string of names the order is enough
        self.carry = level == 0
        self.most = 0
        self.t = room(folder, f"text-{level}", self.n, memory, np.int64 if level else np.uint16)
        # where induction starts, of starred suffixes and zeros, and (until that is known) which suffixes aren't asked for
        self.start = None if whole else room(folder, f"start-{level}", self.n, memory, bool)
        after, kind, zero = 0, 1, self.n
        for a in range((self.n - 1) // memory * memory, -1, -memory):  # types come from the right
            x = np.append(np.array(letters[a : a + memory], np.int64), after)
            self.most = max(self.most, int(x.max()))
            differ = np.flatnonzero(x[:-1] != x[1:])
            up = np.full(len(x) - 1, bool(kind))
            if len(differ):
                up[: differ[-1] + 1] = np.repeat(x[differ] < x[differ + 1], np.diff(np.concatenate([[-1], differ])))
            up |= x[:-1] == 0
            self.t[a : a + memory] = 2 * x[:-1] + up
            if not whole:
                at = np.arange(a, a + len(up))
                end = np.minimum.accumulate(np.where(x[:-1] == 0, at, zero)[::-1])[::-1]
                self.start[a : a + memory] = end < at + depth
                zero = int(end[0])
            after, kind = int(x[0]), int(up[0])

    def name(self, what: str) -> str:
        self.files = getattr(self, "files", 0) + 1
        return f"{what}-{self.level}-{self.files}"

    def rows(self, what: str, width: int) -> Rows:
        return Rows(os.path.join(self.folder, self.name(what)), width, 2 * self.memory)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of pairs of suffixes, up to the depth: four letters at a time, then one by one."""
        out, on, k = np.zeros(len(a), np.int64), np.arange(len(a)), 0
        if self.t.dtype == np.uint16:
            four = np.ndarray(self.n - 3, np.uint64, self.t, 0, (2,))  # the letters from each place on
            apart = []
            while len(on) and k + 4 <= self.depth:
                same = ((four[a[on] + k] ^ four[b[on] + k]) & LETTERS) == 0
                apart.append(on[~same])
                on = on[same]
                out[on] += 4
                k += 4
            for n, rest in enumerate(apart):
                self._common_on(a, b, out, rest, 4 * n, 4 * n + 4)
        self._common_on(a, b, out, on, k, self.depth)
        return out

    def _common_on(self, a, b, out, on, k: int, end: int) -> None:
        while k < end and len(on):
            on = on[self.t[a[on] + k] >> 1 == self.t[b[on] + k] >> 1]
            out[on] += 1
            k += 1

    # starred suffixes: S after L

    def stars(self) -> Rows:
        """(place, place where its substring ends: the next starred suffix or zero), in order."""
        rows, open_, before, late = self.rows("stars", 2), np.empty(0, np.int64), 1, False
        for a in range(0, self.n, self.memory):
            x = np.array(self.t[a : a + self.memory], np.int64)
            s = (x & 1).astype(bool)
            star = s & ~np.concatenate([[bool(before & 1)], s[:-1]]) & (x > 1)
            before = int(x[-1])
            event = np.flatnonzero(star | (x <= 1)) + a
            if self.start is not None:  # none after a starred suffix that isn't asked for itself
                past = np.append(late, self.start[event] & star[event - a])
                self.start[a : a + self.memory] = False
                self.start[event[~past[:-1]]] = True
                late = past[-1]
            mine = np.concatenate([np.ones(len(open_), bool), star[event - a]])
            event = np.concatenate([open_, event])
            done = np.flatnonzero(mine[:-1])
            rows.add(event[done], event[done + 1])
            open_ = event[-1:] if len(event) and mine[-1] else np.empty(0, np.int64)
        return rows.done()

    def keys(self, part: np.ndarray, k: int) -> np.ndarray:
        """The letters and types of substrings from their k-th on, as many as a number holds."""
        bits = max(2, (2 * self.most + 1).bit_length())
        out = np.zeros(len(part), np.int64)
        for j in range(k, k + 62 // bits):
            at = part[:, 0] + j
            inside = (at <= part[:, 1]) & (j < self.depth)
            out = (out << bits) | np.where(inside, self.t[np.minimum(at, self.n - 1)], 0)
        return out

    def step(self) -> int:
        return 62 // max(2, (2 * self.most + 1).bit_length())

    def sort_stars(self, rows: Rows, k: int, out) -> None:
        """Give out(places, new) in the order of substrings, where new marks the first of equal ones."""
        if rows.n <= 2 * self.memory:
            if rows.n:
                out(*self.sort_block(np.array(rows.at), k))
            rows.drop()
            return
        if k >= self.depth:
            for i, part in enumerate(rows.blocks(self.memory)):
                new = np.zeros(len(part), bool)
                new[:1] = not i
                out(part[:, 0], new)
            rows.drop()
            return
        every = max(1, rows.n // 4096)
        sample = np.concatenate([self.keys(part[::every], k) for part in rows.blocks(self.memory)])
        cuts = np.quantile(sample, np.linspace(0, 1, 2 + 2 * rows.n // self.memory)[1:-1], method="lower")
        cuts = np.unique(np.concatenate([cuts, cuts + 1]))  # a frequent key is a part of its own
        parts = [self.rows("part", 2) for _ in range(len(cuts) + 1)]
        low, high = [None] * len(parts), [None] * len(parts)
        for part in rows.blocks(self.memory):
            key = self.keys(part, k)
            to = np.searchsorted(cuts, key, side="right")
            for i in np.unique(to).tolist():
                on = to == i
                parts[i].add(*part[on].T)
                least, most = int(key[on].min()), int(key[on].max())
                low[i] = least if low[i] is None else min(low[i], least)
                high[i] = most if high[i] is None else max(high[i], most)
        rows.drop()
        for part, a, b in zip(parts, low, high):
            self.sort_stars(part.done(), k + self.step() if a == b else k, out)

    def sort_block(self, part: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        v = self.keys(part, k)
        order = np.argsort(v)
        part, v = part[order], v[order]
        new = np.concatenate([[True], v[1:] != v[:-1]])
        for k in range(k + self.step(), self.depth, self.step()):
            tied = np.concatenate([~new[1:], [False]]) | ~new
            # only ties whose substrings go on are looked at further
            group = np.cumsum(new)
            tied = np.flatnonzero(tied)
            if not len(tied) or not (part[tied, 0] + k <= part[tied, 1]).any():
                break
            v = self.keys(part[tied], k)
            order = np.lexsort((v, group[tied]))
            part[tied], v = part[tied][order], v[order]
            new[tied[1:]] |= (v[1:] != v[:-1]) & (group[tied[1:]] == group[tied[:-1]])
        return part[:, 0], new

    def seeds(self) -> Rows:
        """(letter, place, common) of the starred suffixes in order."""
        rows = self.stars()
        place = self.rows("place", 2)
        for part in rows.blocks(self.memory):  # for each name and the zero after a part's last one
            ends = self.t[part[:, 1]] <= 1
            after = np.flatnonzero(ends) + 1
            place.add(np.insert(part[:, 0], after, -1), np.zeros(len(part) + len(after), np.int64))
        place.done()
        n, count = rows.n, 0
        names = room(self.folder, self.name("names"), self.n, self.memory)  # by place
        order = self.rows("order", 1)

        def out(places, new):
            nonlocal count
            names[places] = count + np.cumsum(new)
            count += int(new.sum())
            order.add(places)

        self.sort_stars(rows, 0, out)
        order.done()
        if count < n:  # equal substrings: what follows them decides
            word = room(self.folder, self.name("word"), place.n + self.depth + 8, self.memory)
            word[place.n :] = 0
            at = 0
            for part in place.blocks(self.memory):
                on = part[:, 0] >= 0
                own = np.zeros(len(part), np.int64)
                own[on] = names[part[on, 0]]
                word[at : at + len(part)] = own
                at += len(part)
            order.drop()
            order = self.rows("order", 1)
            # each name stands for two letters at least
            for part in sorted_names(self.folder, word, self.depth // 2 + 1, self.memory, self.level + 1):
                order.add(place.at[part, 0])
            order.done()
        seeds, last = self.rows("seeds", 3), np.empty(0, np.int64)
        for part in order.blocks(self.memory):
            s = part[:, 0] if self.start is None else part[self.start[part[:, 0]], 0]
            value = np.zeros(len(s), np.int64)
            if self.carry:
                both = np.concatenate([last, s])
                value[len(s) - len(both) + 1 :] = self.common(both[1:], both[:-1])
                last = both[-1:]
            seeds.add(self.t[s] >> 1, s, value)
        order.drop()
        place.drop()
        return seeds.done()

    # induction

    def induce(self, backward: bool, seeds: Rows, zeros: bool) -> Rows:
        """One scan: what precedes the suffixes that are read, of type S if backward, else L.
        A letter's induced suffixes are read before its seeds, the suffixes of the other type."""
        queue, tape = DiskQueue(self.folder, f"queue-{self.level}-{int(backward)}", backward, 2 * self.memory), Tape(seeds, backward)
        out = self.rows("induced", 3)
        least: dict[int, int] = {}  # smallest common value since a letter's last arrival

        def read(part: np.ndarray) -> None:
            comm = part[:, 2]
            prev = part[:, 1] - 1
            x = self.t[np.maximum(prev, 0)]
            x[prev < 0] = 1
            send = np.flatnonzero((x > 1) & ((x & 1) == backward))
            here = {}
            if len(send):
                letters = x[send] >> 1  # short numbers at the first level, which sort quickly
                by = np.argsort(letters, kind="stable")
                send, letters = send[by], letters[by]
                head = np.minimum.accumulate(comm) if self.carry else comm
                for own in np.split(send, np.flatnonzero(np.diff(letters)) + 1):
                    c = int(x[own[0]]) >> 1
                    new = np.zeros(len(own), np.int64)
                    if self.carry:
                        new[0] = min(least[c], int(head[own[0]])) + 1 if c in least else 0
                        if len(own) > 1:
                            new[1:] = _range_min(comm, own[:-1], own[1:]) + 1
                        here[c] = int(own[-1])
                    queue.push(c, prev[own], np.minimum(new, self.depth))
            if self.carry:
                low = int(comm.min())
                for c in least:
                    least[c] = min(least[c], low)
                for c, at in here.items():
                    least[c] = int(comm[at + 1 :].min()) if at + 1 < len(comm) else self.depth

        if zeros:  # zeros end every part: what precedes one starts the scan
            for a in range(0, self.n, self.memory):
                z = np.flatnonzero(self.t[a : a + self.memory] <= 1) + a
                z = z if self.start is None else z[self.start[z]]
                if len(z):
                    read(np.stack([np.zeros_like(z), z, np.zeros_like(z)], axis=1))
        while True:
            heads = [c for c in (queue.letter(), tape.letter()) if c is not None]
            if not heads:
                break
            c, last = max(heads) if backward else min(heads), None
            while len(part := queue.take(c, self.memory)):  # what these induce under the same letter comes after them
                out.put(part)
                last = part[-1:, 1]
                read(part)
            first = True
            while len(part := tape.take(c, self.memory)):
                if first:  # the seam between the letter's two types, or between letters
                    part[0, 2] = self.common(part[:1, 1], last)[0] if self.carry and last is not None else 0
                    first = False
                read(part)
        return out.done()

    def order(self):
        """Blocks (suffixes, common), where common[i] is with the suffix before in all."""
        seeds = self.seeds()
        l_of = self.induce(False, seeds, True)
        seeds.drop()
        s_of = self.induce(True, l_of, False)
        low, high = Tape(l_of, False), Tape(s_of, True)
        last = np.empty(0, np.int64)
        while True:
            heads = [c for c in (low.letter(), high.letter()) if c is not None]
            if not heads:
                break
            c = min(heads)
            for tape in (low, high):
                first = True
                while len(part := tape.take(c, self.memory)):
                    if first and self.carry:
                        part[0, 2] = self.common(part[:1, 1], last)[0] if len(last) else 0
                    first, last = False, part[-1:, 1]
                    yield part[:, 1], part[:, 2]
        l_of.drop()
        s_of.drop()


def sorted_names(folder: str, word: np.ndarray, depth: int, memory: int, level: int):
    """Blocks of the places of a string of names in the order of its suffixes, without its zeros."""
    if len(word) > BASE * memory:
        yield from (s for s, _ in External(folder, word, depth, memory, level).order())
        return
    rank, width = np.array(word), 1
    while width < depth:  # by doubling
        far = np.concatenate([rank[width:], np.zeros(width, np.int64)])
        key = rank * (int(rank.max()) + 1) + far
        new = np.unique(key, return_inverse=True)[1]
        rank, width = np.where(rank > 0, new + 1, 0), 2 * width
    order = np.argsort(rank)
    yield order[np.searchsorted(rank[order], 0, side="right") :]


def suffix_array(t: np.ndarray, depth: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, common) of a text of letters 1 to 256 that ends in depth + 8 zeros; zeros
    separate its parts. Suffixes that start with a zero are left out. Order and common
    prefixes are exact up to `depth` letters, common prefixes are cut there."""
    with tempfile.TemporaryDirectory(prefix="edgeloom-", dir=scratch()) as folder:
        found = list(External(folder, t, depth, memory).order())
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([s for s, _ in found]), np.concatenate([c for _, c in found])


class Sides:
    """What documents hold the bytes beside an anchor: every window holds BESIDE of them on one side.

    A side of a segment whose bytes one document has alone has no repeated window. Equal hashes
    share a place in a table of fixed size, which only keeps more."""

    def __init__(self, length: int, q: int):
        self.length, self.q = length, q
        self.known = length - q + 1 >= 2 * BESIDE >= 16  # else windows may hold less, and everything is kept
        self.least, self.most = np.full(SLOTS, np.iinfo(np.int64).max), np.full(SLOTS, np.iinfo(np.int64).min)

    def cut(self, at: np.ndarray) -> np.ndarray:
        """The first window that holds BESIDE bytes after the anchor; those before it hold as many before it."""
        return np.maximum(0, at - (self.length - self.q - BESIDE))

    def add(self, text: np.ndarray, start, size, key, at, most, least) -> np.ndarray:
        """Rows (slot of the bytes after, slot of those before), -1 for a side without windows, of segments of a text
        that goes on for 8 bytes at least."""
        word, cut = np.ndarray(len(text) - 7, np.uint64, text, 0, (1,)), self.cut(at)
        out = np.full((len(start), 2), -1, np.int64)
        if not self.known:
            return out
        for side, (on, place) in enumerate(((size - cut >= self.length, start + at + self.q), (cut > 0, start + at - BESIDE))):
            h = key[on].view(np.uint64) + np.uint64(side)
            for k in (0, BESIDE - 8):
                h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) + word[place[on] + k]
            slot = ((h ^ h >> np.uint64(32)) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(33)).astype(np.int64) % SLOTS
            np.minimum.at(self.least, slot, least[on])
            np.maximum.at(self.most, slot, most[on])
            out[on, side] = slot
        return out

    def kept(self, size, at, slots) -> tuple[np.ndarray, np.ndarray]:
        """[lo, hi) of each segment that several documents may have, of no bytes if none."""
        if not self.known:
            return np.zeros_like(size), size
        cut = self.cut(at)
        after, before = ((x >= 0) & (self.least[x] < self.most[x]) for x in slots.T)
        lo, hi = np.where(before, 0, cut), np.where(after, size, np.minimum(size, cut - 1 + self.length))
        return lo, np.where(after | before, hi, lo)


def smallest_documents(segs, length: int, q: int = Q, memory: int = MEMORY):
    """For segments in blocks (columns of ints: what is sorted together, the anchor's place, any
    others, a segment's largest and smallest document; and the list of their bytes): blocks
    (columns of the segments, first window, last window, smallest document) of runs of
    windows with one smallest document, in order, of windows that may be repeated."""
    with tempfile.TemporaryDirectory(prefix="edgeloom-", dir=scratch()) as folder:
        given, n, sides = None, 0, Sides(length, q)
        with open(os.path.join(folder, "bytes"), "wb") as f:
            for columns, raw in segs:
                size = np.array([len(x) for x in raw], np.int64)
                start = np.cumsum(size) - size
                x = np.frombuffer(b"".join([*raw, bytes(8)]), np.uint8)
                key, at, *_, most, least = columns = [c.astype(np.int64, copy=False) for c in columns]
                given = given or Rows(os.path.join(folder, "given"), 4 + len(columns), 2 * memory)
                given.add(n + start, size, *sides.add(x, start, size, key, at, most, least).T, *columns)
                f.write(x[:-8].data)
                n += len(x) - 8
        if given is None:
            return
        given.done()
        raw = np.memmap(os.path.join(folder, "bytes"), np.uint8, "r", shape=(n,)) if n else np.empty(0, np.uint8)
        step = max(1, memory // 64)
        info, n = Rows(os.path.join(folder, "info"), given.width - 1, 2 * memory), 0
        with open(os.path.join(folder, "letters"), "wb") as f:
            for part in given.blocks(step):
                lo, hi = sides.kept(part[:, 1], part[:, 5], part[:, 2:4])
                on = hi > lo
                part, lo, size = part[on], lo[on], (hi - lo)[on]
                end = np.cumsum(size + 1)
                begin = end - size - 1
                info.add(n + begin, size, lo, *part[:, 4:].T)
                x = np.zeros(int(size.sum()) + len(size), np.uint16)
                inside = np.ones(len(x), bool)
                inside[end - 1] = False
                x[inside] = raw[np.arange(len(x))[inside] + np.repeat(part[:, 0] + lo - begin, size)].astype(np.uint16) + 1
                f.write(x.data)
                n += len(x)
            f.write(bytes(2 * (length + 8)))
        given.drop()
        info.done()
        if not info.n:
            return
        n += length + 8
        text = External(folder, np.memmap(os.path.join(folder, "letters"), np.uint16, "r", shape=(n,)), length, memory, whole=False)
        # a window's document, by its place; other places have none
        none = np.iinfo(np.int64).max
        docs_at = room(folder, "docs", n, memory)
        docs_at[n - length - 8 :] = none
        for a in range(0, info.n, step):
            part = np.array(info.at[a : a + step])
            count = np.stack([part[:, 1] - length + 1, np.full(len(part), length)], axis=1).ravel()
            docs_at[part[0, 0] : part[-1, 0] + part[-1, 1] + 1] = np.repeat(np.stack([part[:, -1], np.full(len(part), none)], axis=1).ravel(), count)
        # windows by groups of equal ones, then each group's smallest document
        group = room(folder, "group", n, memory)
        low, count = Rows(os.path.join(folder, "low"), 1, 2 * memory), 0
        held = none
        for s, common in text.order():
            new = common < length
            if not count:
                new[0] = True
            group[s] = count + np.cumsum(new) - 1
            docs = docs_at[s]
            first = np.flatnonzero(new)
            edges = first if len(first) and first[0] == 0 else np.concatenate([[0], first]).astype(np.int64)
            least = np.minimum.reduceat(docs, edges)
            if not new[0]:  # goes on with the group of the block before
                held, least = min(held, int(least[0])), least[1:]
            if len(least):
                if count:
                    low.add(np.array([held]))
                low.add(least[:-1])
                held = int(least[-1])
            count += len(first)
        if count:
            low.add(np.array([held]))
        low.done()
        for a in range(0, info.n, step):
            part = np.array(info.at[a : a + step])
            at = int(part[0, 0])
            value = low.at[group[at : int(part[-1, 0] + part[-1, 1])], 0] if low.n else np.empty(0, np.int64)
            place = np.repeat(part[:, 0] - at, part[:, 1] - length + 1)
            n_own = part[:, 1] - length + 1
            seg = np.repeat(np.arange(len(part)), n_own)
            inside = np.arange(len(seg)) - np.repeat(np.cumsum(n_own) - n_own, n_own)
            value = value[place + inside]
            begin = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (seg[1:] != seg[:-1])]))
            stop = np.append(begin[1:], len(seg)) - 1
            lo = part[seg[begin], 2]
            yield part[seg[begin], 3:], lo + inside[begin], lo + inside[stop], value[begin]


# --- 4: spans -----------------------------------------------------------------------


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, x, t): identifier, a key of the text, and the text; null is empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    own = F.col(doc_id).cast("long")
    return docs.select(own.alias("doc_id"), F.coalesce(own, F.lit(NULL_ID)).alias("id"), F.xxhash64(t).alias("x"), t.alias("t"))


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """common.written, without the shuffle files that led to the table: each shuffle here is as large as the text."""
    with shuffles_dropped(df.sparkSession):
        return written_table(df, name, codec)


def _counted(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, q: int = Q, per_shard: int = PER_SHARD, hot: int = HOT) -> DataFrame:
    """(id, x, spans): for documents with bytes to remove, by identifier and text key, their
    [start, end) byte spans, in order and apart."""
    import pyarrow as pa

    spark = docs.sparkSession
    ship(spark)
    every = _keyed(docs, doc_id, text).where(F.octet_length("t") >= length)
    # a whole text that a smaller document has too goes by itself, and stands for nothing else
    whole = every.select("id", "x", F.octet_length("t").cast("long").alias("n"), F.sha2("t", 256).alias("same"))
    first = whole.groupBy("same").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    copies = written(whole.join(first.select("same", "least"), "same").where("id > least").select("id", "x", "n").distinct(), "copies")
    rows = every.join(_counted(copies.select("id", "x"), BROADCAST_IDS), ["id", "x"], "left_anti")
    size = rows.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    shards = 1 + int(2 * size / (length - q + 2) / per_shard)
    anchors = written(_anchor_rows(rows, length, q, shards), "anchors")
    with batch_rows(spark, 8):  # a row holds many anchors
        shared = written(_shared(anchors, shards), "shared")
    drop(anchors)
    held = shared.groupBy("id").agg(F.collect_set("h").alias("hs"))  # of one document's anchors
    some = rows.join(_counted(shared.select("id").distinct(), BROADCAST_IDS), "id", "left_semi")
    occ = written(_segments(some.join(held, "id"), length, q).withColumn("k", F.xxhash64("seg")), "occurrences", "zstd")
    drop(shared)
    distinct = written(occ.groupBy("h", "k", "seg").agg(F.min("at").alias("at"), F.min("id").alias("least"), F.max("id").alias("most")), "distinct", "zstd")
    sorting = spread(distinct, length, q, hot)
    size = distinct.agg(F.sum(F.octet_length("seg")).alias("n")).first()["n"] or 0
    parts = 1 + int(size // SEGMENT_BYTES)

    def run(batches):
        names = ("key", "at", "h", "k", "off", "most", "least")
        blocks = (([batch.column(c).to_numpy() for c in names], batch.column("seg").to_pylist()) for batch in batches if batch.num_rows)
        for columns, a, b, least in smallest_documents(blocks, length, q):
            on = least < columns[:, 5]  # else it removes nothing
            _, _, h, k, off, _, _ = columns[on].T
            yield pa.RecordBatch.from_pydict({"h": h, "k": k, "a": a[on] + off, "b": b[on] + off, "least": least[on]})

    runs = written(sorting.repartition(parts, "key").mapInArrow(run, "h long, k long, a long, b long, least long"), "runs")
    drop(distinct)
    # a span is one number: its start, and 31 bits of its size (texts have at most 2^31 bytes)
    span = (F.col("pos") + F.col("a")) * F.lit(1 << 31) + (F.col("b") - F.col("a") + length)
    covered = occ.select("id", "x", "pos", "h", "k").join(runs, ["h", "k"]).where("least < id").select("id", "x", span.alias("span"))
    # one document's spans, merged; as many as its own text can hold
    spans = covered.groupBy("id", "x").agg(F.collect_set("span").alias("all"))

    def merged(batches):
        for batch in batches:
            found = batch.column("all").flatten().to_numpy()
            size = np.diff(batch.column("all").offsets.to_numpy())
            doc = np.repeat(np.arange(len(size)), size)
            by = np.lexsort((found, doc))
            found, doc = found[by], doc[by]
            s, e = found >> 31, (found >> 31) + (found & (2**31 - 1))
            far = np.maximum.accumulate(e + (doc << 32)) if len(e) else e  # the end of what came before in the document
            new = np.append(True, s[1:] + (doc[1:] << 32) > far[:-1])[: len(s)]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(s))[: len(first)] - 1
            own = pa.StructArray.from_arrays([pa.array(s[first]), pa.array(far[last] - (doc[last] << 32))], ["s", "e"])
            places = np.searchsorted(doc[first], np.arange(len(size) + 1))
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "x": batch.column("x"), "spans": pa.ListArray.from_arrays(pa.array(places, pa.int32()), own)})

    kind = "id long, x long, spans array<struct<s:long,e:long>>"
    gone = copies.select("id", "x", F.array(F.struct(F.lit(0).cast("long").alias("s"), F.col("n").alias("e"))).alias("spans"))
    out = written(spans.mapInArrow(merged, kind).unionByName(gone), "spans")
    for table in (occ, runs, copies):
        drop(table)
    return out


def remove(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    import pyarrow as pa

    rows = _keyed(docs, doc_id, text)
    # of most rows nothing goes: which do is known by their keys alone, and only those meet their spans
    keys = _counted(spans.select("id", "x", F.lit(True).alias("hit")), BROADCAST_IDS)
    marked = rows.join(keys, ["id", "x"], "left")
    whole = marked.where("hit is null").select("doc_id", F.octet_length("t").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(F.col("t").cast("binary"), 256).alias("kept_sha256"))

    def cut(batches):
        for batch in batches:
            out = []
            for t, s in zip(batch.column("t").to_pylist(), batch.column("spans").to_pylist()):
                b, at, kept = t.encode("utf-8", "replace"), 0, []
                for x in s:
                    kept.append(b[at : x["s"]])
                    at = x["e"]
                kept = b"".join([*kept, b[at:]])
                out.append((len(b), len(b) - len(kept), len(s), hashlib.sha256(kept).hexdigest()))
            n_bytes, n_removed, n_spans, sha = zip(*out) if out else ((),) * 4
            longs = {n: pa.array(v, pa.int64()) for n, v in (("n_bytes", n_bytes), ("n_removed", n_removed), ("n_spans", n_spans))}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | longs | {"kept_sha256": pa.array(sha, pa.string())})

    hit = marked.where("hit").join(spans, ["id", "x"])
    return whole.unionByName(hit.select("doc_id", "t", "spans").mapInArrow(cut, whole.schema))


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents")
    return remove(docs, repeated_spans(docs))
