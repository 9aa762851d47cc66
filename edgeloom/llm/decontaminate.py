"""Benchmark decontamination (3): q-gram lemma filtering with banded verification.

Both sides are normalised (lower case, runs of white space as one space, so that
layout changes don't hide a leak) to code points. A benchmark item is cut into
windows of `window` characters, each half overlapping the next, a short item into
one window. A window within k edits of a passage shares at least
`length + 1 - q * (k + 1)` of its q-grams with it (q-gram lemma), on diagonals that
differ by k at most; so hits are counted in bands of 2(k + 1) diagonals that overlap
by half, and only bands that meet the bound are verified, by an alignment of the whole
window within the band. The filter loses no passage that is within the budget of a window.

Where no such window is found, an item's short ones are tried: `SHORT` characters at a
stride of `STRIDE` and from each word that begins a run of `WORDS` words (the run itself
where it is shorter). So every verbatim excerpt of 13 whole words, and every one of
SHORT + STRIDE - 1 = 61 characters, is found; a less exact one where a short window of it
is within 3 edits (fewer for shorter runs). Excerpts below both limits may be missed.

The benchmark is the stated query set: it is read in blocks of `block_chars`
characters, each shipped to one scan of the documents. Documents of any length are
scanned in overlapping blocks.

Defined cases: null or empty documents and items match nothing; an item shorter than
`least` characters (normalised) is matched exactly, as a whole that begins and ends at the
border of a word; repeated items report each its own match; items with a null id are
reported together under a null item_id; rows with a repeated or null id are scanned like
others; empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, ship

Q, WINDOW, EDITS, LEAST = 8, 96, 0.07, 40
#: Short windows: their characters, the steps between them, and the words that hold one wherever they begin.
SHORT, STRIDE, WORDS = 50, 12, 13
BLOCK_CHARS = 4_000_000
#: Characters of a document that are scanned at a time.
SCAN = 1_000_000


def normal(text: str | None) -> np.ndarray:
    """Code points of the normalised text."""
    t = " ".join((text or "").lower().split())
    return np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q characters from each position on."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(q):
        h *= np.uint64(0x100000001B3)
        h += codes[j : j + n]
    return mix(h)


class Windows:
    """Windows of benchmark items, and an index of the items' q-grams."""

    def __init__(self, items: list[tuple[int, str]], q: int, window: int, edits: float, least: int,
                 short: int = SHORT, stride: int = STRIDE, words: int = WORDS):
        self.q = q
        self.texts, self.item = [], []
        #: items below the limit by length and code points; their windows are numbered from -1 down
        self.small: dict[int, dict[bytes, list[int]]] = {}
        self.small_item: list = []
        text, at, size, brief, self.first_window = [], [], [], [], [0]
        for item, own in items:
            c = normal(own)
            if len(c) < max(least, q):
                if len(c):
                    self.small.setdefault(len(c), {}).setdefault(c.tobytes(), []).append(-1 - len(self.small_item))
                    self.small_item.append(item)
                continue
            width = min(window, len(c))
            spans = dict.fromkeys((s, width) for s in [*range(0, len(c) - width, max(1, width // 2)), len(c) - width])
            n = len(spans)
            spans.update(dict.fromkeys(short_spans(c, short, stride, words)))
            text += [len(self.texts)] * len(spans)
            at += [s for s, _ in spans]
            size += [m for _, m in spans]
            brief += [i >= n for i in range(len(spans))]
            self.texts.append(c)
            self.item.append(item)
            self.first_window.append(len(text))
        self.text, self.at, self.size = (np.array(x, np.int64) for x in (text, at, size))
        self.brief = np.array(brief, bool)
        # the budget is what still leaves the lemma a bound of at least one gram
        self.k = np.minimum((self.size * edits).astype(np.int64), np.maximum(0, self.size // q - 1))
        self.need = self.size + 1 - q * (self.k + 1)
        starts = np.array(self.first_window[:-1], np.int64)
        self.most_k = np.maximum.reduceat(self.k, starts) if len(starts) else self.k
        self.least_need = np.minimum.reduceat(self.need, starts) if len(starts) else self.need
        self.longest = max(map(len, self.texts), default=0)
        g = [grams(c, q) for c in self.texts]
        hashes = np.concatenate(g) if g else np.empty(0, np.uint64)
        own = np.repeat(np.arange(len(g)), [len(x) for x in g]) if g else np.empty(0, np.int64)
        pos = np.concatenate([np.arange(len(x)) for x in g]) if g else np.empty(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.own, self.pos = own[order].astype(np.int64), pos[order].astype(np.int64)
        self.keys, self.first = np.unique(hashes[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(hashes)))
        bits = max(16, int(np.ceil(np.log2(max(1, len(self.keys)) * 16))))
        self.shift = np.uint64(64 - bits)
        self.map = np.zeros(1 << bits, bool)
        self.map[(self.keys >> self.shift).astype(np.int64)] = True

        self.small_keys = {m: np.sort(keyed(np.stack([np.frombuffer(c, np.uint32) for c in own]))) for m, own in self.small.items()}

    def owner(self, v: int):
        """The id of a window's item."""
        return self.small_item[-1 - v] if v < 0 else self.item[self.text[v]]

    def codes(self, v: int) -> np.ndarray:
        return self.texts[self.text[v]][self.at[v] : self.at[v] + self.size[v]]


BASE = 0x100000001B3


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def keyed(rows: np.ndarray) -> np.ndarray:
    """Hash of each row of code points, as `exact` has it."""
    return (rows.astype(np.uint64) * powers(rows.shape[1], BASE)).sum(1, dtype=np.uint64)


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalnum() for i in range(0x110000)])


def exact(codes: np.ndarray, w: Windows) -> list[tuple[int, int, int, int]]:
    """Items below the limit that a text holds as a whole, not inside a word, wherever they stand."""
    out: list[tuple[int, int, int, int]] = []
    reach = max(w.small)
    for start in range(0, len(codes), SCAN):
        # with a character before, and as many behind as an item and its border need
        base = max(0, start - 1)
        part = codes[base : start + SCAN + reach + 1]
        n = len(part)
        word = _letters()[part]
        # a place inside a word: letters or digits on both its sides
        inside = np.zeros(n + 1, bool)
        inside[1:n] = word[1:] & word[:-1]
        own = np.arange(start - base, min(n, start - base + SCAN))
        own = own[~inside[own]]
        sums = np.append(np.uint64(0), np.cumsum(part.astype(np.uint64) * powers(n, BASE), dtype=np.uint64))
        back = powers(n, pow(BASE, -1, 1 << 64))
        for m, items in w.small.items():
            at = own[: np.searchsorted(own, n - m, "right")]
            at = at[~inside[at + m]]
            h = (sums[at + m] - sums[at]) * back[at]
            keys = w.small_keys[m]
            for s in at[keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h].tolist():
                out += [(v, base + s, base + s + m, 0) for v in items.get(part[s : s + m].tobytes(), ())]
    return out


def short_spans(c: np.ndarray, short: int, stride: int, words: int) -> list[tuple[int, int]]:
    """(start, length) of the short windows of an item: one at each multiple of `stride`,
    one at the end, and one at the start of each run of `words` words, no longer than the run."""
    out = [(s, short) for s in [*range(0, len(c) - short, stride), len(c) - short]] if len(c) >= short else []
    gaps = np.flatnonzero(c == 32)
    first, end = np.append(0, gaps + 1), np.append(gaps, len(c))
    return out + [(s, min(short, e - s)) for s, e in zip(first.tolist(), end[words - 1 :].tolist())]


def banded(p: np.ndarray, t: np.ndarray, lo: int, width: int, k: int) -> tuple[int, int]:
    """Least edits of p against a substring of t on diagonals lo to lo + width, at most
    k + 1, and the place in t where it ends. Cells off the text cost too much to use."""
    far = np.int32(len(p) + k + 1)
    pad = max(0, -lo)
    strip = np.full(len(p) + width + 1, np.uint32(0xFFFFFFFF))
    own = t[max(0, lo) : max(0, lo + len(strip))]
    strip[pad : pad + len(own)] = own[: len(strip) - pad]
    row = np.zeros(width + 1, np.int32)
    steps = np.arange(width + 1, dtype=np.int32)
    for i, c in enumerate(p):
        new = row + (strip[i : i + width + 1] != c)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum(np.minimum.accumulate(new - steps) + steps, far)
        if row.min() > k:
            return k + 1, 0
    d = int(row.argmin())
    return int(row[d]), lo + len(p) + d


def matches(text: str | None, w: Windows) -> list[tuple[int, int, int, int]]:
    """(window, start, end, edits) of the passages of a text, in normalised characters."""
    out: list[tuple[int, int, int, int]] = []
    codes = normal(text)
    if w.small:
        out += exact(codes, w)
    if not len(w.keys):
        return out
    margin = 2 * int(w.size.max())
    for start in range(0, max(1, len(codes)), SCAN):
        part = codes[start : start + SCAN + margin]
        h = grams(part, w.q)
        at = np.flatnonzero(w.map[(h >> w.shift).astype(np.int64)])
        if not len(at):
            continue
        found = np.minimum(np.searchsorted(w.keys, h[at]), len(w.keys) - 1)
        ok = w.keys[found] == h[at]
        at, found = at[ok], found[ok]
        n = w.count[found]
        hits = int(n.sum())
        if not hits:
            continue
        entry = np.repeat(w.first[found] - np.cumsum(n) + n, n) + np.arange(hits)
        own, pos = w.own[entry], w.pos[entry]
        # halves of k + 1 diagonals; a band is two halves, so bands overlap by one
        half = (np.repeat(at, n) - pos + w.longest) // (w.most_k[own] + 1)
        stride = len(part) + 2 * w.longest
        key = own * stride + half
        order = np.argsort(key, kind="stable")
        key, pos = key[order], pos[order]
        band, first = np.unique(key, return_index=True)
        counts = np.diff(np.append(first, hits))
        nxt = np.minimum(np.searchsorted(band, band + 1), len(band) - 1)
        counts = counts + np.where(band[nxt] == band + 1, counts[nxt], 0)
        # an item has no fewer hits in a band than any of its windows
        full = np.flatnonzero(counts >= w.least_need[band // stride])
        whole: set[int] = set()
        for brief in (False, True):
            for b, i, m in zip(band[full].tolist(), first[full].tolist(), counts[full].tolist()):
                x = b // stride
                if brief and x in whole:
                    continue
                mine = np.arange(w.first_window[x], w.first_window[x + 1])
                mine = mine[w.brief[mine] == brief]
                p = np.sort(pos[i : i + m])
                shared = np.searchsorted(p, w.at[mine] + w.size[mine] - w.q, "right") - np.searchsorted(p, w.at[mine])
                most = int(w.most_k[x])
                for v in mine[shared >= w.need[mine]].tolist():
                    k, size = int(w.k[v]), int(w.size[v])
                    # the passage may begin on up to k diagonals below the first that a shared gram is on
                    lo = (b % stride) * (most + 1) - w.longest + int(w.at[v]) - most
                    d, end = banded(w.codes(v), part, lo, 3 * most + 2, k)
                    if d <= k:
                        out.append((v, start + end - size, start + end, d))
                        if not brief:
                            whole.add(x)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
          q: int = Q, window: int = WINDOW, edits: float = EDITS, least: int = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document and item whose passage it holds: doc_id, item_id,
    n_windows (of the item's, found), first_start, last_end (in the normalised text),
    edits (the least of a window). Documents without a leak have no row."""
    import pyarrow as pa

    spark = docs.sparkSession
    ship(spark)
    schema = "doc_id long, item_id long, n_windows long, first_start long, last_end long, edits long"

    names = [x.split()[0] for x in schema.split(", ")]

    def scan(windows: Windows):
        def run(batches):
            for batch in batches:
                rows = []
                for i, t in zip(batch.column("i").to_pylist(), batch.column("t")):
                    if not (t := t.as_py()):
                        continue
                    by: dict[int, list] = {}
                    for v, s, e, d in matches(t, windows):
                        by.setdefault(windows.owner(v), []).append((v, s, e, d))
                    for item, m in sorted(by.items(), key=lambda x: (x[0] is not None, x[0] or 0)):
                        rows.append((i, item, len({x[0] for x in m}), min(max(0, x[1]) for x in m), max(x[2] for x in m), min(x[3] for x in m)))
                yield pa.RecordBatch.from_pydict({n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(names)})

        return run

    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t"))
    out = None
    for items in _blocks(benchmark, item_id, item_text, block_chars):
        got = rows.mapInArrow(scan(Windows(items, q, window, edits, least)), schema)
        out = got if out is None else out.unionByName(got)
    return out if out is not None else spark.createDataFrame([], schema)


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, chars: int):
    """Items of at most so many characters together, read one after another."""
    block, size = [], 0
    rows = benchmark.select(F.col(item_id).cast("long"), F.col(item_text)).where(F.col(item_text).isNotNull())
    for i, t in rows.toLocalIterator():
        block.append((i, t))
        size += len(t)
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
