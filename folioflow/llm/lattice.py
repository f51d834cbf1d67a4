"""Near-duplicate vectors by lattice hashing.

Each table projects the unit vectors at random to eight dimensions, once or for several blocks,
shifts them at random and decodes them to the nearest points of the E8 lattice; the blocks' points
together name a cell. A vector is entered at its own cell and at the neighbouring cells that it lies
closest to, one block at a time; two vectors meet where one of them is at home. Projections are scaled
by the vectors' width and the least cosine, so a table finds a pair with the same probability at any
width. More vectors of one label get finer cells and more tables (LEVELS), so that the vectors that one
is compared with stay about as many and a pair escapes all tables with a probability of at most ESCAPE.
Every meeting is verified by cosine in double precision. The groups of a cell are dealt
out as pairs of blocks, so a cell of any size is verified in bounded pieces, and a pair
that meets several times is counted at its first meeting only.

Results for odd input: vectors that are null, zero or hold null or non-finite
components, and those with a null label, link with nothing; so do rows with a null id, whose
component is null; labels may be of any type that can be cast to a string; equal vectors are compared once and counted in full; rows of one id
are one vector; vectors of different lengths don't link; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Forest, block_pairs, connected_components, group_starts, mix, parallelism, ready, stage, whole_groups

#: Neighbouring cells per block that a vector is entered at, and the probability that a pair at the least
#: cosine escapes all tables, at most.
PROBES, ESCAPE = 4, 1e-7
#: (vectors of one label up to which it holds, length of the projections, blocks, share of pairs at the least
#: cosine that one table finds, measured as the least at widths of 8, 64 and 384).
LEVELS = (
    (20_000, 2.1, 1, 0.95),
    (200_000, 3.0, 1, 0.81),
    (1_000_000, 4.0, 1, 0.58),
    (10_000_000, 2.1, 2, 0.64),
    (50_000_000, 1.5, 3, 0.59),
    (float("inf"), 2.1, 3, 0.37),
)
BLOCK = 1024


def _neighbours() -> np.ndarray:
    """The 240 shortest lattice vectors."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


NEIGHBOURS = _neighbours()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of an even sum."""
    whole = np.rint(x)
    off = x - whole
    odd = np.flatnonzero(whole.sum(1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(1)
    whole[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return whole


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: of the even lattice and of its shift by a half, the closer one."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


_CELL = np.random.PCG64(51).random_raw(8) | np.uint64(1)


class Grid(NamedTuple):
    """How vectors are entered: number of tables, blocks of a table, length of a projection."""

    tables: int
    blocks: int
    length: float


def grid(most: int, least: float) -> Grid:
    """For `most` vectors of one label. Lengths are stated for pairs 0.2 apart, a cosine of 0.98."""
    _, length, blocks, found = next(x for x in LEVELS if most <= x[0])
    return Grid(math.ceil(math.log(ESCAPE) / math.log(1 - found)), blocks, length * 0.2 / math.sqrt(2 * max(1 - least, 1e-6)))


@lru_cache(maxsize=256)
def _projection(t: int, block: int, d: int) -> tuple[np.ndarray, np.ndarray]:
    """d x 8, of orthonormal columns (or rows, if d < 8), and a shift."""
    rng = np.random.default_rng((61, t, block, d))
    q = np.linalg.qr(rng.normal(size=(d, 8)))[0] if d >= 8 else np.linalg.qr(rng.normal(size=(8, d)))[0].T
    return q * math.sqrt(max(d, 8) / 8), rng.uniform(0, 2, size=8)


def _names(points: np.ndarray, block: int) -> np.ndarray:
    whole = np.rint(2 * points).astype(np.int64).view(np.uint64)
    return mix((whole * _CELL).sum(-1, dtype=np.uint64) + np.uint64(block))


def cells(unit: np.ndarray, salt: np.ndarray, g: Grid) -> np.ndarray:
    """n x tables x (1 + PROBES * blocks) cell names of unit vectors: the home cell first. salt: of the labels,
    which don't share cells."""
    n, d = unit.shape
    salt = mix(salt.view(np.uint64) + np.uint64(d))
    out = np.empty((n, g.tables, 1 + PROBES * g.blocks), dtype=np.int64)
    for t in range(g.tables):
        own = np.empty((n, g.blocks), np.uint64)
        other = np.empty((n, g.blocks, PROBES), np.uint64)
        for k in range(g.blocks):
            q, shift = _projection(t, k, d)
            x = unit @ q * g.length + shift
            home = decode(x)
            near = np.argsort(-((x - home) @ NEIGHBOURS.T), axis=1, kind="stable")[:, :PROBES]
            own[:, k], other[:, k] = _names(home, k), _names(home[:, None, :] + NEIGHBOURS[near], k)
        whole = own.sum(1, dtype=np.uint64) + (salt ^ np.uint64(t))
        probed = (whole[:, None] - own)[:, :, None] + other
        out[:, t] = mix(np.concatenate([whole[:, None], probed.reshape(n, -1)], axis=1)).view(np.int64)
    return out


def _unit(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components would leave the doubles' range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def links(unit: np.ndarray, labels: np.ndarray, salt: np.ndarray, here: int, side: np.ndarray | None, least: float, g: Grid) -> list[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (i < j) of a cell's vectors whose first common cell is `here`, by blocks of rows."""
    out = []
    for a in range(0, len(unit), 256):
        i, j = np.nonzero(unit[a : a + 256] @ unit.T >= least - 1e-9)
        i += a
        keep = (i < j) & (labels[i] == labels[j])
        if side is not None:
            keep &= side[i] != side[j]
        i, j = i[keep], j[keep]
        exact = np.einsum("ij,ij->i", unit[i], unit[j]) >= least
        i, j = i[exact], j[exact]
        if not len(i):  # as in most cells
            continue
        some, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        own, x, y = cells(unit[some], salt[some], g), at[: len(i)], at[len(i) :]
        for b in range(0, len(i), 50_000):
            p, q = x[b : b + 50_000], y[b : b + 50_000]
            first = np.zeros(len(p), dtype=np.int64)
            open_ = np.ones(len(p), dtype=bool)
            for t in range(g.tables):
                at_p = (own[q, t] == own[p, t, :1]).any(1)
                at_q = (own[p, t] == own[q, t, :1]).any(1)
                met = open_ & (at_p | at_q)
                first[met] = np.where(at_p, own[p, t, 0], own[q, t, 0])[met]
                open_ &= ~met
            mine = ~open_ & (first == here)
            out.append((some[p[mine]], some[q[mine]]))
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row."""
    spark = vectors.sparkSession
    ready(spark)
    vector = F.col(vector_col) if vectors.schema[vector_col].dataType.simpleString() in ("array<float>", "array<double>") else F.col(vector_col).cast("array<double>")
    kind = vectors.select(vector.alias("v")).schema["v"].dataType.simpleString()
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), _label(vectors, label_col).alias("label"), vector.alias("v"))
    inf = float("inf")
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("v", lambda x: x != 0)
    usable = rows.where(F.coalesce(sound, F.lit(False))).withColumn("salt", F.xxhash64("label"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            ends = np.cumsum(pc.list_value_length(batch.column("v")).to_numpy()).tolist()
            keys = [hashlib.blake2b(f"{label}\0".encode() + flat[a:b].tobytes(), digest_size=16).digest() for label, a, b in zip(batch.column("label").to_pylist(), [0, *ends], ends, strict=False)]
            yield pa.record_batch([*batch.columns, pa.array(keys, pa.binary())], names=["vec_id", "label", "v", "salt", "key"])

    named = stage(usable.mapInArrow(name, f"vec_id long, label string, v {kind}, salt long, key binary"), "vectors")
    classes = stage(named.groupBy("key").agg(F.min("vec_id").alias("node"), F.countDistinct("vec_id").alias("copies"), F.first("label").alias("label"), F.first("salt").alias("salt"), F.first("v").alias("v")), "classes")
    most = classes.groupBy("salt", F.size("v").alias("d")).count().agg(F.max("count")).first()[0]
    g = grid(most or 0, least)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole in _by_length(batch):
                for a in range(0, whole.num_rows, 2048):
                    part = whole.slice(a, 2048)
                    own = cells(_unit(part.column("v")), part.column("salt").to_numpy(), g)
                    ids = np.repeat(part.column("node").to_numpy(), own.shape[1] * own.shape[2])
                    home = np.tile(np.arange(own.shape[2]) == 0, len(own) * own.shape[1])
                    yield pa.record_batch([pa.array(own.ravel()), pa.array(ids), pa.array(home)], names=["cell", "node", "home"])

    entries = stage(classes.select("node", "salt", "v").mapInArrow(enter, "cell long, node long, home boolean"), "entries")
    sizes = entries.groupBy("cell").agg(F.count("*").alias("n"), F.max("home").alias("lived")).where("n > 1 and lived")
    sizes = sizes.select("cell", F.ceil(F.col("n") / BLOCK).cast("long").alias("n_blocks"))
    dealt = block_pairs(entries.select("cell", "node").distinct(), sizes, "cell", "node", 3)
    dealt = dealt.join(classes.select("node", "label", "salt", "copies", "v"), "node").select("part", "cell", "block", "alone", "node", "label", "salt", "copies", "v")
    dealt = dealt.repartition(parallelism(spark), "part").sortWithinPartitions("part", "cell", "node")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["part", "cell"]):
            for rows in _by_length(table.combine_chunks().to_batches()[0]):
                at = [*group_starts(rows, ["part", "cell"]).tolist(), rows.num_rows]
                unit = _unit(rows.column("v"))
                ids, salt, copies, blocks, here = (rows.column(c).to_numpy() for c in ("node", "salt", "copies", "block", "cell"))
                labels = rows.column("label").to_numpy(zero_copy_only=False)
                alone = rows.column("alone").to_numpy(zero_copy_only=False)
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for x, y in zip(at, at[1:], strict=False):
                    if y - x < 2:
                        continue
                    linked = links(unit[x:y], labels[x:y], salt[x:y], here[x], None if alone[x] else blocks[x:y], least, g)
                    if not linked:
                        continue
                    own, m, n, forest = copies[x:y], y - x, np.zeros(y - x, dtype=np.int64), Forest(y - x)
                    for p, q in linked:
                        n += (np.bincount(p, own[q], minlength=m) + np.bincount(q, own[p], minlength=m)).astype(np.int64)
                        for i, j in zip(p.tolist(), q.tolist(), strict=True):
                            forest.join(i, j)
                    hit = np.flatnonzero(n)
                    out.append((ids[x:y][hit], n[hit], ids[x:y][[forest.find(i) for i in hit.tolist()]]))
                if out:
                    yield pa.record_batch([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], names=["node", "n", "root"])

    found = stage(dealt.mapInArrow(verify, "node long, n long, root long"), "links")
    degree = found.groupBy("node").agg(F.sum("n").alias("n"))
    labels = connected_components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.select("key", "node", "copies").join(degree, "node", "left").join(labels, "node", "left")
    known = known.select("key", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    of = named.groupBy("vec_id").agg(F.min("key").alias("key")).join(known, "key").drop("key")
    out = rows.select("vec_id").join(of, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _label(vectors: DataFrame, label_col: str | None) -> Column:
    """Labels as strings; equal ones have equal strings."""
    if label_col is None:
        return F.lit("")
    kind, c = vectors.schema[label_col].dataType.simpleString(), F.col(label_col)
    if kind == "binary":
        return F.hex(c)
    return F.when(c == 0, F.lit(0).cast(kind)).otherwise(c).cast("string") if kind in ("float", "double") else c.cast("string")


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of one vector length at a time, in their order."""
    size = pc.list_value_length(batch.column("v")).to_numpy()
    for n in np.unique(size):
        yield batch if (size == n).all() else batch.take(pa.array(np.flatnonzero(size == n)))
