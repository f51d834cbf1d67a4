"""Shared pieces: tables in the shared folder, word hashing, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reachable

#: Bytes of text that a Python worker handles at once; larger texts are handled alone.
CHUNK_BYTES = 1_000_000
#: Bytes of an Arrow batch, of which Spark and the worker each hold several.
BATCH_BYTES = 4_000_000
#: Ids that may be broadcast (8 bytes each); beyond it the join is shuffled.
BROADCAST_IDS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see; one of our own only where none is set, as in tests."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="folioflow-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Tables that stage() has written and nobody has deleted.
_STAGED: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folioflow/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._staged = path
    _STAGED.append(path)
    return out


def delete(spark: SparkSession, *paths: str) -> None:
    """Delete tables that nothing reads any more."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables; only for those that no result reads."""
    for t in tables:
        delete(t.sparkSession, t._staged)
        _STAGED.remove(t._staged)


def discard_since(spark: SparkSession, mark: int) -> None:
    """Delete the tables staged after the first `mark` ones, once what was made of them is written."""
    delete(spark, *_STAGED[mark:])
    del _STAGED[mark:]


def staged() -> int:
    return len(_STAGED)


def ready(spark: SparkSession) -> None:
    """Keeps what passes between Spark and its Python workers small, and lets them import this package."""
    reachable(spark)
    spark.sparkContext.environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_ids(df: DataFrame, ids: DataFrame, key: str | list[str], how: str) -> DataFrame:
    """Join with a table of ids; it is broadcast only when counted and few."""
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, key, how)


def threshold(table: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value: ranges of the values are counted and narrowed, 1,024 at a time."""
    low, high, n = table.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k < 1:
        return None
    if k >= n:
        return low
    above = 0
    while low < high:
        width = (high - low) / 1024
        if width <= 0 or low + width == low:
            break
        part = F.least(F.floor((F.col(column) - low) / width), F.lit(1023))
        inside = table.where((F.col(column) >= low) & (F.col(column) <= high))
        found = inside.groupBy(part.alias("p")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy(F.desc("p")).collect()
        for r in found:
            if above + r["n"] >= k:
                if (r["low"], r["high"]) == (low, high):
                    width = 0
                low, high = r["low"], r["high"]
                break
            above += r["n"]
        if not width:
            break
    if low == high:
        return low
    return table.where((F.col(column) >= low) & (F.col(column) <= high)).select(column).orderBy(F.desc(column)).limit(k - above).agg(F.min(column)).first()[0]


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, nulls as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def chunks(sizes: Iterable[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive [start, end) runs of rows of at most `limit` bytes, or one row."""
    start = end = total = 0
    for end, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, end
            start, total = end, 0
        total += size
    if start < end + 1 and total >= 0 and (end or total or start == 0):
        yield start, end + 1


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about CHUNK_BYTES of text each, with that text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = text_bytes(batch.column(column))
        for a, b in chunks(map(len, texts)):
            yield batch.slice(a, b - a), texts[a:b]


# --- hashing of words -------------------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit integers (finaliser of a counter-based generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _S30
    x *= _M1
    x ^= x >> _S27
    x *= _M2
    x ^= x >> _S31
    return x


def _randoms(seed: int, n: int) -> np.ndarray:
    return np.random.PCG64(seed).random_raw(n) | np.uint64(1)


_BYTE = _randoms(11, 256)
_PLACE = [_randoms(12, 1024)]
_ORDER = [_randoms(13, 1024)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def _table(kept: list[np.ndarray], seed: int, n: int) -> np.ndarray:
    """Random factors for n places; a longer table begins with the shorter one."""
    if len(kept[0]) < n:
        kept[0] = _randoms(seed, 2 * n)
    return kept[0]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, and where each text's begin.

    The second array has one entry more than there are texts.
    """
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    space = _SPACE[data]
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    at = np.flatnonzero(first)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    begin = np.concatenate(([0], np.searchsorted(at, ends)))
    if not len(at):
        return np.empty(0, np.uint64), begin
    letters = data[inside]
    lead = np.flatnonzero(first[inside])
    size = np.diff(np.append(lead, len(letters)))
    place = np.arange(len(letters)) - np.repeat(lead, size)
    factors = _table(_PLACE, 12, int(size.max()))
    return mix(np.add.reduceat(_BYTE[letters] * factors[place], lead) + size.astype(np.uint64)), begin


_SHINGLE = _randoms(14, 64)


def sequence_hash(words: np.ndarray) -> int:
    """Of a whole sequence of word hashes."""
    total = np.add.reduce(words * _table(_ORDER, 13, len(words))[: len(words)])
    return int(mix(np.array([total + np.uint64(len(words))], dtype=np.uint64))[0])


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Each text's sorted distinct k-word shingle hashes; fewer words count as one shingle."""
    words, begin = word_hashes(texts)
    if len(words) >= k:
        n = len(words) - k + 1
        grams = words[:n] * _SHINGLE[0]
        for j in range(1, k):
            grams += words[j : n + j] * _SHINGLE[j]
        grams = mix(grams)
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b - a >= k:
            s = np.sort(grams[a : b - k + 1])
            keep = np.empty(len(s), dtype=bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            out.append(np.array([sequence_hash(words[a:b])], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def digest(hashes: np.ndarray) -> bytes:
    """16 bytes that name an array of hashes."""
    import hashlib

    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


# --- groups in sorted rows ---------------------------------------------------------------------


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups from rows that are sorted by the keys; only the current group is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and tuple(c[0] for c in columns) != last
        start = 0
        for at in np.flatnonzero(new).tolist():
            if at > start:
                held.append(batch.slice(start, at - start))
            if held:
                yield pa.Table.from_batches(held)
            held, start = [], at
        held.append(batch.slice(start))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of at least `rows` rows, if there are as many, that end where a group of equal keys ends."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        ends = group_starts(table, keys)
        if len(ends) > 1:
            yield table.slice(0, int(ends[-1]))
            table = table.slice(int(ends[-1]))
        held, n = table.to_batches(), table.num_rows
    if n:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Rows at which groups of equal keys begin."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        column = table.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


# --- connected components ----------------------------------------------------------------------


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that undirected edges (a, b) lead to.

    Alternating large-star and small-star steps, which end after about as many rounds as the logarithm of the
    nodes; every step is an aggregation and a join, so no node's neighbours are gathered. The least
    neighbours are written before they are joined: then both sides of a join are plain exchanges, of which
    adaptive plans split the node that has most neighbours. Tables of a round are deleted after the next
    one. Nodes without an edge don't appear.
    """

    def parents(e: DataFrame) -> DataFrame:
        return stage(e.where("u > v").distinct(), "edges")

    e = parents(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while True:
        both = e.union(e.select("v", "u").toDF("u", "v"))
        below, above = F.count_if(F.col("v") < F.col("u")), F.count_if(F.col("v") > F.col("u"))
        least = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), ((below > 1) | (below > 0) & (above > 0)).alias("open")), "least")
        if not least.where("open").limit(1).count():  # every node has one parent, and no parent has one
            break
        large = stage(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct(), "large")
        lower = stage(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        done, e = (e, least, large, lower), parents(small.union(lower.select("u", F.col("m").alias("v"))))
        discard(*done)
    star = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.union(star.select(F.col("component").alias("node"), "component").distinct())


class Forest:
    """Union-find over 0..n-1; a class's root is its smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def block_pairs(members: DataFrame, sizes: DataFrame, key: str, node: str, seed: int) -> DataFrame:
    """Deal each group's members into the pairs of its blocks.

    sizes: key, n_blocks. Adds part (names one pair of blocks), block and alone (both
    blocks are the same). Every two members of a group meet in exactly one part, and a
    part holds two blocks at most, however large the group.
    """
    b = F.pmod(F.xxhash64(F.lit(seed), F.col(node)), F.col("n_blocks"))
    other: Column = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    dealt = members.join(sizes, key).withColumn("block", b).withColumn("other", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return dealt.withColumn("part", F.xxhash64(F.col(key), low, high)).withColumn("alone", low == high).drop("other", "n_blocks")
