"""Token-ID / binary output (9): sorted-string-table shards.

Documents are dealt into ranges of their identifier, sorted, tokenized and written as
one file for each range. A file is a run of data blocks, a Bloom filter, a sparse
block index and a footer:

  block   entries, each: shared key bytes, own key bytes, value bytes (varints), the
          rest of the key, the value. Keys share prefixes with the entry before, anew
          every `RESTART` entries; the block ends with the restart places and a crc32
  value   token ids as little-endian integers of the width that the header names
  filter  k probes by double hashing over a bit array
  index   for each block its last key, place, length and number of ids
  footer  places of filter and index, counts, id width, version, magic (fixed size)

A lookup asks the filter, bisects the index, then the block's restarts.

Keys order as identifiers do: a byte that says whether there is one (null first), then
the identifier big-endian with its sign bit flipped.

A shard is written under a name of its own attempt, by way of pyarrow's file systems
into the shared folder; the rows that the writing tasks return (the manifest) name the
files that count, so lost or repeated attempts leave nothing that is read.

Defined cases: null and empty texts hold the end id alone; rows repeated are entries of
their own; null identifiers come first; an empty table writes no shard; other columns
are not read; a document longer than a block is a block of its own.
"""

from __future__ import annotations

import bisect
import itertools
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import encoder, new_path, ship, vocabulary, with_end, written

MAGIC, VERSION = b"ELSST\x00\x01\n", 1
BLOCK = 1 << 16
RESTART = 16
BITS_PER_KEY = 10
END = 2
#: Bytes of text of one shard, about, and entries read from a file at a time.
PER_SHARD, READ_ROWS = 48 << 20, 1_000
FOOTER = struct.Struct("<QQQQQQHH8s")


def key_of(doc_id: int | None) -> bytes:
    return b"\x00" if doc_id is None else b"\x01" + struct.pack(">Q", (doc_id + (1 << 63)) & (2**64 - 1))


def id_of(key: bytes) -> int | None:
    return None if key == b"\x00" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(b: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        c = b[at]
        at += 1
        n |= (c & 127) << shift
        if c < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int, k: int) -> list[int]:
    import xxhash

    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (2**64 - 1), h >> 64 | 1
    return [(a + i * b) % bits for i in range(k)]


class Writer:
    """Writes one shard to a file-like object; keys must come in order."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.at = self.entries = self.ids = 0
        self.block, self.restarts, self.count, self.last, self.block_ids = bytearray(), [], 0, b"", 0
        self.index: list[tuple[bytes, int, int, int]] = []
        self.keys: list[bytes] = []

    def add(self, key: bytes, value: bytes) -> None:
        shared = 0
        if self.count % RESTART:
            most = min(len(key), len(self.last))
            while shared < most and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.restarts.append(len(self.block))
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.count += 1
        self.entries += 1
        self.last = key
        self.block_ids += len(value) // self.width
        self.keys.append(key)
        if len(self.block) >= BLOCK:
            self.flush()

    def flush(self) -> None:
        if not self.count:
            return
        tail = b"".join(struct.pack("<I", r) for r in self.restarts) + struct.pack("<I", len(self.restarts))
        body = bytes(self.block) + tail
        body += struct.pack("<I", zlib.crc32(body))
        self.out.write(body)
        self.index.append((self.last, self.at, len(body), self.block_ids))
        self.at += len(body)
        self.ids += self.block_ids
        self.block, self.restarts, self.count, self.last, self.block_ids = bytearray(), [], 0, b"", 0

    def close(self) -> None:
        self.flush()
        k = max(1, round(BITS_PER_KEY * 0.69))
        bits = max(64, BITS_PER_KEY * len(self.keys))
        table = np.zeros((bits + 7) // 8, np.uint8)
        for key in self.keys:
            for p in _probes(key, bits, k):
                table[p >> 3] |= 1 << (p & 7)
        filter_ = struct.pack("<QI", bits, k) + table.tobytes()
        index = b"".join(_varint(len(key)) + key + _varint(at) + _varint(n) + _varint(ids) for key, at, n, ids in self.index)
        self.out.write(filter_ + index)
        place = self.at
        self.out.write(FOOTER.pack(place, len(filter_), place + len(filter_), len(index), self.entries, self.ids, self.width, VERSION, MAGIC))


class Reader:
    """Reads one shard from a seekable file-like object."""

    def __init__(self, src):
        self.src = src
        size = src.seek(0, 2)
        src.seek(size - FOOTER.size)
        f_at, f_len, i_at, i_len, self.entries, self.ids, self.width, version, magic = FOOTER.unpack(src.read(FOOTER.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a shard of this format")
        src.seek(f_at)
        self.filter = src.read(f_len)
        raw = src.read(i_len) if i_at == f_at + f_len else None
        self.index, at = [], 0
        while at < len(raw):
            n, at = _read_varint(raw, at)
            key = raw[at : at + n]
            place, at = _read_varint(raw, at + n)
            size, at = _read_varint(raw, at)
            ids, at = _read_varint(raw, at)
            self.index.append((key, place, size, ids))
        self.last_keys = [x[0] for x in self.index]

    def _block(self, i: int) -> tuple[bytes, int, list[int]]:
        _, place, size, _ = self.index[i]
        self.src.seek(place)
        body = self.src.read(size)
        if zlib.crc32(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
            raise ValueError("damaged block")
        n = struct.unpack("<I", body[-8:-4])[0]
        end = len(body) - 8 - 4 * n
        return body, end, list(struct.unpack(f"<{n}I", body[end : end + 4 * n]))

    def _entries(self, body: bytes, at: int, end: int):
        key = b""
        while at < end:
            shared, at = _read_varint(body, at)
            own, at = _read_varint(body, at)
            size, at = _read_varint(body, at)
            key = key[:shared] + body[at : at + own]
            at += own
            yield key, body[at : at + size]
            at += size

    def __iter__(self):
        for i in range(len(self.index)):
            body, end, _ = self._block(i)
            yield from self._entries(body, 0, end)

    def may_hold(self, key: bytes) -> bool:
        bits, k = struct.unpack("<QI", self.filter[:12])
        return all(self.filter[12 + (p >> 3)] >> (p & 7) & 1 for p in _probes(key, bits, k))

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """Ids of every entry with the identifier, by filter, block index and restarts."""
        key, out = key_of(doc_id), []
        if not self.may_hold(key):
            return out
        for i in range(bisect.bisect_left(self.last_keys, key), len(self.index)):
            body, end, restarts = self._block(i)
            lo, hi = 0, len(restarts) - 1  # the last restart whose key is below
            while lo < hi:
                mid = (lo + hi + 1) // 2
                if next(self._entries(body, restarts[mid], end))[0] < key:
                    lo = mid
                else:
                    hi = mid - 1
            for k, value in self._entries(body, restarts[lo], end):
                if k == key:
                    out.append(self.array(value))
                elif k > key:
                    return out
            if self.last_keys[i] > key:
                break
        return out

    def array(self, value: bytes) -> np.ndarray:
        return np.frombuffer(value, f"<u{self.width}")


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


MANIFEST = "path string, first_id long, last_id long, entries long, ids long, bytes long, shard int"


def write_shards(docs: DataFrame, folder: str, vocab: str, doc_id: str = "doc_id", text: str = "text", end: int = END, per_shard: int = PER_SHARD) -> DataFrame:
    """Write docs under folder (a URI that driver and executors share); the manifest, a
    written table: path, first_id, last_id, entries, ids, bytes and shard, in order."""
    import pyarrow as pa

    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t"))
    shards = 1 + int((rows.agg(F.sum(F.octet_length("t") + 16).alias("n")).first()["n"] or 0) // per_shard)

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        enc, out, writer, first, last = encoder(vocab), None, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("i").to_pylist()
            if writer is None:
                fs, path = _fs(folder)
                fs.create_dir(path, recursive=True)
                name = f"shard-{shard:06d}-{uuid.uuid4().hex}.sst"
                out = fs.open_output_stream(f"{path}/{name}")
                writer = Writer(out, 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 else 4)
                first = own[0]
            last = own[-1]
            for at, ids, ends in enc.blocks(batch.column("t")):
                ids, ends = with_end(ids, ends, end)
                raw, width, start = ids.astype(f"<u{writer.width}").tobytes(), writer.width, 0
                for i, stop in zip(own[at:], (ends * width).tolist()):
                    writer.add(key_of(i), raw[start:stop])
                    start = stop
        if writer is not None:
            writer.close()
            size = out.tell()
            out.close()
            row = (f"{folder}/{name}", first, last, writer.entries, writer.ids, size, shard)
            fields = [x.split() for x in MANIFEST.split(", ")]
            kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
            yield pa.RecordBatch.from_pydict({n: pa.array([v], kinds[k]) for (n, k), v in zip(fields, row)})

    # equal identifiers may lie in several shards, one after the other
    dealt = rows.withColumn("h", F.xxhash64("t"))
    by = [F.col("i").asc_nulls_first(), F.col("h")]
    dealt = dealt.repartitionByRange(shards, *by).sortWithinPartitions(*by).select("i", "t")
    return written(dealt.mapInArrow(run, MANIFEST), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per entry, from the files: doc_id, start (ids of all entries before it), n_tokens, ids_crc32."""
    import pyarrow as pa

    # one row for each shard: the running sum is over as many rows as there are files
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rows = manifest.select("path", "shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    shards = max(1, manifest.count())

    def run(batches):
        for batch in batches:
            for path, at in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                fs, name = _fs(path)
                with fs.open_input_file(name) as src:
                    entries = iter(reader := Reader(src))
                    while some := list(itertools.islice(entries, READ_ROWS)):
                        found = [reader.array(value).astype("<u4") for _, value in some]
                        n = np.array([len(x) for x in found], np.int64)
                        columns = {"doc_id": [id_of(key) for key, _ in some], "start": at + np.cumsum(n) - n, "n_tokens": n, "ids_crc32": [zlib.crc32(x) for x in found]}
                        at += int(n.sum())
                        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in columns.items()})

    return rows.repartition(shards, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


@dataclass
class Table:
    """Shards opened for lookups by identifier on the driver."""

    shards: list[tuple[int | None, int | None, str]]

    @classmethod
    def open(cls, manifest: DataFrame) -> Table:
        return cls([(r["first_id"], r["last_id"], r["path"]) for r in manifest.orderBy("shard").collect()])

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        out, key = [], key_of(doc_id)
        at = bisect.bisect_left([key_of(x[1]) for x in self.shards], key)
        for first, _, path in self.shards[at:]:
            if key_of(first) > key:
                break
            fs, name = _fs(path)
            with fs.open_input_file(name) as src:
                out += Reader(src).get(doc_id)
        return out


def op9_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import read

    manifest = write_shards(read(spark, sf_dir, "documents"), new_path(spark, "sstable"), vocabulary())
    return read_shards(manifest)
