"""Best-fit packing (7): minimum bin slack over piece lengths.

Documents become token ids and an end id; only those longer than a sequence are cut.
Which pieces share a sequence depends on their lengths alone, so packing works on the
histogram of lengths, which has at most `size` entries however large the corpus is:
for each bin the longest length left is fixed, and a subset-sum dynamic program over
the available lengths, held as the bits of one integer, finds the fullest feasible
combination. The combination is removed as often as the histogram allows, so billions
of bins take a few thousand steps. The plan is a short list of (combination, times).

Pieces then find their places without meeting: each gets its rank among the pieces of
its length from a two-level count (length and salt, then a running sum over salts, so
a length that holds a third of all pieces is spread), and a rank is a bin and offset by
arithmetic on the plan.

Defined cases: null and empty texts are one piece of the end id alone; rows repeated
are packed each for itself; an empty table gives an empty result; only the id and text
are read, so other columns don't matter; rows with a null id are packed like others.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import encoder, ship, vocabulary, with_end, written

SIZE = 2048
END = 0
#: Pieces of one length that one salt holds, about.
PER_SALT = 50_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, doc_id: str, text: str, vocab: str, size: int, end: int, ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    import pyarrow as pa

    ship(docs.sparkSession)

    def run(batches):
        enc = encoder(vocab)
        for batch in batches:
            for at, found, ends in enc.blocks(batch.column("t")):
                found, ends = with_end(found, ends, end)
                starts = np.concatenate([[0], ends[:-1]])
                n = -(-(ends - starts) // size)
                doc = np.repeat(np.arange(len(ends)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                lo = starts[doc] + piece * size
                hi = np.minimum(lo + size, ends[doc])
                raw = memoryview(found).cast("B")
                parts = [raw[4 * a : 4 * b] for a, b in zip(lo.tolist(), hi.tolist())]
                columns = {
                    "doc_id": batch.column("i").take(pa.array(at + doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(piece * size, pa.int64()),
                    "length": pa.array(hi - lo, pa.int64()), "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                }
                if ids:
                    columns["ids"] = pa.array([bytes(p) for p in parts], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")).mapInArrow(run, PIECES + (", ids binary" if ids else ""))


def fullest(counts: dict[int, int], size: int) -> list[int]:
    """Lengths, each used at most counts[length] times, that hold the longest one and sum
    to the most that fits into size. Bit s of `reach` says that a sum of s is feasible."""
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    first = lengths[0]
    room = size - first
    keep = (1 << (room + 1)) - 1
    reach, layers = 1, []
    for n in lengths:
        if n > room:
            continue
        left = min(counts[n] - (n == first), room // n)
        part = 1
        while left > 0:  # binary splitting: up to `left` copies in log steps
            take = min(part, left)
            layers.append((n, take, reach))
            reach |= (reach << (n * take)) & keep
            left -= take
            part *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out = [first]
    for n, take, before in reversed(layers):
        if not before >> total & 1:
            out += [n] * take
            total -= n * take
    assert total == 0
    return sorted(out, reverse=True)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins) until every length is used up."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        bin_ = fullest(left, size)
        use = {n: bin_.count(n) for n in set(bin_)}
        times = min(left[n] // k for n, k in use.items())
        for n, k in use.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        out.append((bin_, times))
    return out


class Places:
    """From (length, rank) to (sequence, offset) under a plan."""

    def __init__(self, bins: list[tuple[list[int], int]]):
        by: dict[int, list[tuple[int, int, int, int]]] = {}
        first, used = 0, {}
        for bin_, times in bins:
            offsets: dict[int, list[int]] = {}
            at = 0
            for n in bin_:
                offsets.setdefault(n, []).append(at)
                at += n
            for n, places in offsets.items():
                # each slot of the combination takes `times` pieces: all bins' first slot, then the second
                for offset in places:
                    by.setdefault(n, []).append((used.get(n, 0), first, offset, times))
                    used[n] = used.get(n, 0) + times
            first += times
        self.by = {n: tuple(np.array(x, np.int64) for x in zip(*rows)) for n, rows in by.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for n in np.unique(length):
            on = length == n
            start, first, offset, _ = self.by[int(n)]
            k = np.searchsorted(start, rank[on], side="right") - 1
            seq[on], off[on] = first[k] + rank[on] - start[k], offset[k]
        return seq, off


def pack(docs: DataFrame, vocab: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    import pyarrow as pa

    parts = written(pieces(docs, doc_id, text, vocab, size, end), "pieces")
    most = 1 + parts.count() // PER_SALT
    key = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(most)).cast("long")
    salted = parts.withColumn("salt", key)
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(histogram, size))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("own", F.row_number().over(own)).join(base, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("own") - 1).alias("rank"))

    def run(batches):
        for batch in batches:
            found = places.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            columns = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            yield pa.RecordBatch.from_pydict(columns | {n: pa.array(x, pa.int64()) for n, x in zip(("sequence_id", "offset"), found)})

    return ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return pack(read(spark, sf_dir, "documents"), vocabulary())
