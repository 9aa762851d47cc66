"""Helpers that the training-data operators share: the shared folder, written
tables, tokenizer ids, connected components."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Texts that go to a Python worker at a time: rows are long here, and Spark's default of
#: 10,000 holds some 100 MB on both sides of each task.
ROWS_AT_A_TIME = 1_000


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when the driver found it outside
    their path (a cluster gets it by --py-files as usual), and keep Arrow batches small
    unless the session sets their size itself."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_A_TIME))


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Rows of an Arrow batch for what is executed inside: for rows that may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of what is written inside go as soon as it is, where Spark can do so (4.1); else they go when the
    driver's JVM collects what refers to them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if not spark.conf.isModifiable(key):
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def binary(column) -> np.ndarray:
    """The bytes of an Arrow column of bytes without nulls, one value after another."""
    places = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[places[0] : places[-1]]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, only
    where that is unset (tests), a temporary folder of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="edgeloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/edgeloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage and outlives executors. The codec is the session's, if
    none is named."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out._edgeloom_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table made by written() once nothing reads it any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._edgeloom_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- tokenizer -------------------------------------------------------------

#: Chunks of text whose ids a worker remembers, twice: those met lately and those before.
CACHE_CHUNKS = 500_000
#: Chunks encoded together in one text, and bytes of text that are cut into chunks at a time.
JOINED, BLOCK_BYTES = 256, 1 << 22


class ChunkEncoder:
    """Token ids of whole texts by the tokenizers library, remembering chunks.

    Spaces and newlines end every piece of the word tokenizer's pre-tokenizer and
    are dropped, so a text's ids are those of its chunks between them, in order.
    A block of texts is cut at them where it lies in its Arrow buffer, and Arrow numbers
    the block's distinct chunks; each of these goes through the library once and comes
    from a bounded dictionary later, and the ids of all texts are one gather. New chunks
    of ASCII and Latin-1 characters are encoded many at a time as lower-case pre-tokens
    joined by spaces: each pre-token ends in one id whose token ends a word, so counting
    them tells where a chunk's ids end. `exact` verifies this on a probe for the loaded
    vocabulary and falls back to whole texts where it doesn't hold; a joined text whose
    counts don't add up is encoded chunk by chunk.
    """

    _probe = "It's a  test,\néá İX 12'll\nDON'T <|x|> 中文 àb ÀÉ§÷×¼ª"
    # pre-tokens of a lower-cased chunk of characters below U+0100
    _pre = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
    _simple = re.compile(r"[!-~¡-¬®-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        # the same model without the steps that pre-tokens have behind them
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[bytes, bytes] = {}
        self.recent: dict[bytes, bytes] = {}
        self.exact = True
        self.exact = self.whole(self._probe).tolist() == self.encode([self._probe])[0].tolist()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _alone(self, raw: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace").strip(" ") for c in raw], add_special_tokens=False)
        return [np.array(enc.ids, dtype=np.uint32).tobytes() for enc in found]

    def learn(self, new: list[bytes]) -> list[bytes]:
        """Ids of chunks, each with or without a space at its end."""
        words = b"".join([c if c.endswith(b" ") else c + b" " for c in new]).decode("utf-8", "replace").lower().split(" ")[:-1]
        out: list[bytes | None] = [None] * len(new)
        quick, pre, parts = [], [], []
        for i, w in enumerate(words):
            if w.isalpha() and (w.isascii() or self._simple.fullmatch(w)):
                quick.append(i)
                pre.append(1)
                parts.append(w)
            elif self._simple.fullmatch(w) and "<|" not in w:
                found = self._pre.findall(w)
                quick.append(i)
                pre.append(len(found))
                parts += found
            elif not w:
                out[i] = b""
        upto = np.cumsum(pre)
        at = 0
        while at < len(quick):  # so many chunks at a time that their pre-tokens make a text of moderate length
            end = min(at + JOINED, len(quick))
            lo = int(upto[at - 1]) if at else 0
            ids = np.array(self.bare.encode_batch_fast([" ".join(parts[lo : upto[end - 1]])], add_special_tokens=False)[0].ids, dtype=np.uint32)
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) == upto[end - 1] - lo:
                joined, start = ids.tobytes(), 0
                for i, stop in zip(quick[at:end], (last[upto[at:end] - lo - 1] * 4).tolist()):
                    out[i] = joined[start:stop]
                    start = stop
            at = end
        left = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(left, self._alone([new[i] for i in left])):
            out[i] = x
        return out

    def _block(self, b: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, end of each text's ids) of texts that lie one after another and end at `ends`."""
        import pyarrow as pa

        if not len(b):
            return np.empty(0, np.uint32), np.zeros(len(ends), np.int64)
        b = np.where(b == 10, np.uint8(32), b)
        mark = b == 32
        mark[ends[ends > 0] - 1] = True
        cuts = np.flatnonzero(mark) + 1
        places = np.concatenate([[0], cuts]).astype(np.int32 if len(b) < 1 << 31 else np.int64)
        kind = pa.binary() if places.dtype == np.int32 else pa.large_binary()
        chunks = pa.Array.from_buffers(kind, len(cuts), [None, pa.py_buffer(places), pa.py_buffer(b)]).dictionary_encode()
        names = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.recent) > CACHE_CHUNKS:  # what isn't met again until this is so once more is forgotten
            self.known, self.recent = self.recent, {}
        raw = list(map(self.recent.get, names))
        gone = [i for i, x in enumerate(raw) if x is None]
        if gone:
            fresh = [names[i] for i in gone]
            found = list(map(self.known.get, fresh))
            new = [k for k, x in enumerate(found) if x is None]
            for k, x in zip(new, self.learn([fresh[k] for k in new]) if new else ()):
                found[k] = x
            for i, x in zip(gone, found):
                raw[i] = x
            self.recent.update(zip(fresh, found))
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) >> 2
        first, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(raw), np.uint32)
        which = chunks.indices.to_numpy()
        n = sizes[which]
        upto = np.cumsum(n)
        ids = flat[np.arange(upto[-1]) + np.repeat(first[which] - (upto - n), n)]
        return ids, np.concatenate([[0], upto])[np.searchsorted(cuts, ends, side="right")]

    def blocks(self, texts):
        """(first text, ids, end of each text's ids) for blocks of an Arrow column of texts; null is empty."""
        import pyarrow as pa

        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string()).fill_null("")
        places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        b = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(places, places[at] + BLOCK_BYTES, side="right")) - 1)
            if self.exact:
                ids, ends = self._block(b[places[at] : places[end]], places[at + 1 : end + 1] - places[at])
            else:
                found = [self.whole(t) for t in texts[at:end].to_pylist()]
                ids, ends = np.concatenate(found), np.cumsum([len(x) for x in found])
            yield at, ids, ends
            at = end

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        import pyarrow as pa

        out: list[np.ndarray] = []
        for _, ids, ends in self.blocks(pa.array(texts, pa.large_string())):
            out += np.split(ids, ends[:-1])
        return out


def with_end(ids: np.ndarray, ends: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's ids with the end id after each text, and the places where texts end then."""
    return np.insert(ids, ends, np.uint32(end)).astype("<u4", copy=False), ends + np.arange(1, len(ends) + 1)


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process and vocabulary."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- expressions -----------------------------------------------------------


def bound(value, f):
    """f(value) with value computed once, however often f's result names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


#: Elements of an array that are folded together before their results are joined to the rest.
FOLD = 256


def folded(items, state, step, kind: str):
    """The results of a fold over an array, joined: step(state, item) gives a struct (state, out),
    out an array of the type `kind`. Results are joined in two steps, so that a long array isn't
    copied for each of its items."""
    none = F.array().cast(kind)

    def grow(acc, got):
        return bound(got, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")))

    def within(acc, part):
        first = F.struct(acc["state"].alias("state"), none.alias("out"))
        return grow(acc, F.aggregate(part, first, lambda a, x: grow(a, step(a["state"], x))))

    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(items) / FOLD).cast("int") - 1, F.lit(0)))
    parts = F.transform(starts, lambda i: F.slice(items, i * FOLD + 1, F.lit(FOLD)))
    return F.aggregate(parts, F.struct(state.alias("state"), none.alias("out")), within, lambda acc: acc["out"])


# --- words and shingles ----------------------------------------------------


class WordHashes(dict):
    """Word bytes to 64-bit hashes, remembered up to a bound."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = WordHashes()
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles, A-Z lower-cased.
    Fewer than k words make one shingle, no words an empty set."""
    if not text:
        return np.empty(0, np.uint64)
    w = text.encode("utf-8", "replace").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, w), np.uint64, len(w))
    width = min(k, len(w))
    n = len(w) - width + 1
    s = np.full(n, np.uint64(width), np.uint64)
    for j in range(width):
        s = mix(s * _MIX + h[j : j + n])
    return np.unique(s)


# --- connected components --------------------------------------------------


#: Up to so many links (16 bytes each) one task finds the components; more go through rounds. The result is the same.
ONE_TASK_LINKS = 500_000


def _joined_rows(batches):
    """(node, comp) of all links (u, v), by union and find; comp is the smallest node."""
    import pyarrow as pa

    found = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if not found:
        return
    ends = np.concatenate([np.concatenate(x) for x in zip(*found)])
    nodes, at = np.unique(ends, return_inverse=True)
    over = list(range(len(nodes)))  # a node's way to its root, which is the smallest of its component
    half = len(ends) // 2
    for a, b in zip(at[:half].tolist(), at[half:].tolist()):
        while over[a] != a:
            over[a] = a = over[over[a]]
        while over[b] != b:
            over[b] = b = over[over[b]]
        if a < b:
            over[b] = a
        elif b < a:
            over[a] = b
    for i, a in enumerate(over):  # roots come before what they are the roots of
        over[i] = over[a]
    for lo in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_pydict({"node": nodes[lo : lo + 100_000], "comp": nodes[np.array(over[lo : lo + 100_000], np.int64)]})


def components(links: DataFrame, name: str = "cc", one_task: int | None = None) -> DataFrame:
    """(node, comp) for every node of links (u, v): comp is the smallest node it reaches.

    Large-star and small-star rounds (Kiveris et al. 2014) on DataFrames; each round
    is a written table, and a round's work is linear in the links. A node's
    neighbours meet only in min() aggregates and equi-joins, so a hub is no problem.
    Few links, counted first, go through one task on an executor.
    """
    edges = written(links.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").distinct(), name)
    if edges.count() <= (ONE_TASK_LINKS if one_task is None else one_task):
        out = written(edges.coalesce(1).mapInArrow(_joined_rows, "node long, comp long"), name)
        drop(edges)
        return out

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both if large else both.where("v < u")
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = (both.where("v > u") if large else near).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            out = out.union(least.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    while True:
        new = written(star(star(edges, True), False), name)
        # converged when each node has one smaller neighbour that is itself a root
        roots = new.select(F.col("v").alias("u")).distinct()
        done = new.join(roots, "u", "left_semi").isEmpty() and not new.groupBy("u").count().where("count > 1").limit(1).count()
        drop(edges)
        edges = new
        if done:
            break
    out = written(edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()), name)
    drop(edges)
    return out
