"""MinHash near-duplicates from two permutations, one of them circularly shifted.

Every shingle is a point of the ring of 64-bit integers. A first permutation scatters
the points; coordinate j of the signature is the least image under the second
permutation of the points shifted by j around the ring, so two permutations give all
coordinates. Documents that share a band are compared by their sketches (the last byte of every
coordinate), and those that agree in nearly as many coordinates as a pair at the threshold would are
proposed: chance meetings in bands don't grow together to large candidate groups. Exact Jaccard on
full sets decides.

Results for odd input: null or blank texts have an empty set and link with nothing;
equal texts (repeated rows included) always link; a null id names no document, so such a
row links with nothing, is kept and has a null component; rows of one id are one document;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_pairs, digest, group_starts, mix, parallelism, ready, release, shingle_sets, stage, text_chunks, whole_groups
from .verify import components

#: Documents and shingles that a block of a large candidate group holds on average, at most.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 400_000
#: How far below the threshold the share of equal coordinates may lie: a pair at a likeness of 0.85 falls below
#: 0.65 of 120 coordinates with a probability of 2e-8, one at 0.8 below 0.6 of 150 with 1e-8.
SLACK = 0.2
#: Documents of a band that a task holds on average, at most.
BLOCK_SKETCHES = 4096


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """len(sets) x n least images; the sets must not be empty."""
    points = mix(np.concatenate(sets) + np.uint64(0x9E3779B97F4A7C15))
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), n), dtype=np.uint64)
    for j in range(n):
        out[:, j] = np.minimum.reduceat(mix(points + np.uint64(j)), at)
    return out


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """One hash of each band's coordinates and of its number."""
    n = signature.shape[1] // rows
    out = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), (len(signature), n)).copy()
    for r in range(rows):
        out = mix(out ^ signature[:, r::rows][:, :n])
    return out


def alike(sketches: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """The first row of each row's class. Rows are classed together that agree in at least percent / 100 - SLACK of their coordinates and whose sizes don't
    rule a link out. Most rows of a band are like its first one; only the others are compared with all."""
    own = np.arange(len(sketches))
    need = (percent / 100 - SLACK) * sketches.shape[1]

    def like(i: int) -> np.ndarray:
        good = 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])
        good[good] = (sketches[good] == sketches[i]).sum(1) >= need
        return good

    first = like(0)
    own[first] = 0
    for i in np.flatnonzero(~first).tolist():
        met = np.unique(own[like(i)])
        if len(met) > 1:
            own[np.isin(own, met)] = met[0]
    return own


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3, percent: int = 85, n_bands: int = 24, rows: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row.

    With 24 bands of 5 rows a pair at a likeness of 0.85 escapes all bands with a
    probability of 8e-7. Bands of any size are compared in pairs of blocks, and candidate groups of any size are verified in full: a large one is
    dealt out as pairs of blocks.
    """
    spark = docs.sparkSession
    ready(spark)
    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])
        for batch, texts in text_chunks(batches):
            sets = shingle_sets(texts, shingle)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            names: list = [None] * len(sets)
            sketches: list = [None] * len(sets)
            if full:
                made = signatures([sets[i] for i in full], n_bands * rows)
                for i, own, last in zip(full, bands(made, rows).view(np.int64), made.astype(np.uint8), strict=True):
                    names[i], keys[i], sketches[i] = own, digest(sets[i]), last.tobytes()
            yield pa.record_batch([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(names, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], schema=schema)

    described = stage(rows_in.mapInArrow(describe, "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch binary"), "minhash")
    named = described.where("doc_id is not null and set_key is not null")
    classes = stage(named.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n")), "classes")
    entries = classes.select("node", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band", F.ceil(F.col("n") / BLOCK_SKETCHES).alias("n_blocks"))
    dealt = block_pairs(entries, shared, "band", "node", 9).select("part", "node")
    dealt = dealt.join(classes.select("node", "sketch", "n"), "node").repartition(parallelism(spark), "part").sortWithinPartitions("part")

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["part"]):
            ids, sizes = table.column("node").to_numpy(), table.column("n").to_numpy()
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
            at = np.append(group_starts(table, ["part"]), len(ids))
            two = at[:-1][np.diff(at) == 2]
            near = (sketches[two] == sketches[two + 1]).sum(1) >= (percent / 100 - SLACK) * sketches.shape[1]
            near &= 100 * np.minimum(sizes[two], sizes[two + 1]) >= percent * np.maximum(sizes[two], sizes[two + 1])
            a, b = [ids[two[near]]], [ids[two[near] + 1]]
            for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if y - x > 2:
                    root = alike(sketches[x:y], sizes[x:y], percent)
                    own = np.flatnonzero(root != np.arange(y - x))
                    a.append(ids[x:y][own])
                    b.append(ids[x:y][root[own]])
            yield pa.record_batch([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], names=["a", "b"])

    proposed = dealt.mapInArrow(propose, "a long, b long")
    sizes = named.groupBy(F.col("doc_id").alias("node")).agg(F.max("n_shingles").alias("n"))
    labels = components(proposed, rows_in, sizes, lambda texts: shingle_sets(texts, shingle), percent, BLOCK_DOCS, BLOCK_SHINGLES)
    same = described.where("doc_id is not null and set_key is not null").groupBy("doc_id").agg(F.min("set_key").alias("set_key"))
    found = classes.select("set_key", "node").join(labels, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    release(spark)
    of = same.join(found, "set_key").select("doc_id", "component")
    out = described.select("doc_id", "n_shingles").join(of, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
