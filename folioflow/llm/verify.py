"""Exact verification of proposed near-duplicates in groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, connected_components, grouped, parallelism, stage, with_ids


def jaccard_links(sets: list[np.ndarray], side: np.ndarray | None, percent: int) -> Forest:
    """Classes of sets with 100 * intersection >= percent * union.

    side: compare only sets of different sides, of which there are two. An inverted index of one side counts
    intersections; of few sets, those are compared whose sizes don't rule a link out.
    """
    forest, m = Forest(len(sets)), len(sets)
    size = np.array([len(s) for s in sets])

    def near(shared: np.ndarray, a: int, b: np.ndarray) -> np.ndarray:
        return 100 * shared >= percent * (size[a] + size[b] - shared)

    if m <= 24:
        for i in range(m):
            for j in range(i):
                if side is not None and side[i] == side[j] or forest.find(i) == forest.find(j):
                    continue
                if 100 * min(size[i], size[j]) < percent * max(size[i], size[j]):
                    continue
                if near(np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True))]), i, np.array([j]))[0]:
                    forest.join(i, j)
        return forest
    indexed = np.arange(m) if side is None else np.flatnonzero(side == side.min())
    owner = np.repeat(indexed, size[indexed])
    every = np.concatenate([sets[i] for i in indexed.tolist()])
    order = np.argsort(every, kind="stable")
    owner, every = owner[order], every[order]
    for i in range(m) if side is None else np.flatnonzero(side != side.min()).tolist():
        low = np.searchsorted(every, sets[i], "left")
        times = np.searchsorted(every, sets[i], "right") - low
        at = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
        shared = np.bincount(owner[at], minlength=m)
        if side is None:
            shared[i:] = 0
        others = np.flatnonzero(shared)
        for j in others[near(shared[others], i, others)].tolist():
            forest.join(i, j)
    return forest


def components(proposed: DataFrame, texts: DataFrame, sizes: DataFrame, to_sets: Callable[[list[bytes]], list[np.ndarray]], percent: int, block_docs: int, block_size: int) -> DataFrame:
    """(node, component) of the links among proposed pairs (a, b).

    texts: doc_id, text. sizes: node, n (elements of its set). Proposed pairs are first merged to candidate
    groups. The first document of a group is then compared with all others, which are dealt out in blocks
    of about block_docs documents or block_size elements: those that link with it need no more, since they are in its class.
    Only the rest, which many a group has none of, is compared with every member, in pairs of blocks. So a large
    group of copies costs as much as its members, and no part is larger than two blocks. Only links that
    join classes leave a task.
    """
    spark = texts.sparkSession
    members = stage(connected_components(proposed), "candidates")
    own = with_ids(texts.where("doc_id is not null"), members.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        """component and how many blocks its rows make."""
        weighed = rows.join(sizes, "node").groupBy("component").agg(F.count("*").alias("docs"), F.sum("n").alias("elements"))
        n = F.greatest(F.ceil(F.col("docs") / block_docs), F.ceil(F.col("elements") / block_size), F.lit(1)).cast("long")
        return stage(weighed.select("component", n.alias(name)), name)

    def block(name: str, seed: int):
        return F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(name))

    def verified(dealt: DataFrame) -> DataFrame:
        """Links (a, b) of dealt rows (part, side, node): between the sides of a part."""

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
            for group in grouped(batches, ["part"]):
                ids = group.column("doc_id").to_numpy()
                sets: list[np.ndarray] = []
                for t in group.column("text"):
                    sets += to_sets([(t.as_py() or "").encode()])
                forest = jaccard_links(sets, group.column("side").to_numpy(), percent)
                found = [(ids[i], ids[r]) for i in range(len(ids)) if (r := forest.find(i)) != i and ids[i] != ids[r]]
                if found:
                    a, b = zip(*found, strict=True)
                    yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

        rows = dealt.withColumnRenamed("node", "doc_id").join(own, "doc_id").select("part", "side", "doc_id", "text")
        return rows.repartition(parallelism(spark), "part").sortWithinPartitions("part", "side", "doc_id").mapInArrow(verify, "a long, b long")

    # a component's number is its first member
    followers = members.where("node <> component")
    at = followers.join(blocks(followers, "n_blocks"), "component").withColumn("part", F.xxhash64("component", block("n_blocks", 7)))
    first = at.select("part", F.col("component").alias("node")).distinct().select("part", F.lit(0).alias("side"), "node")
    near = stage(verified(first.unionByName(at.select("part", F.lit(1).alias("side"), "node"))), "near")
    rest = stage(followers.join(near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_anti"), "rest")
    if not rest.limit(1).count():
        return stage(connected_components(near), "labels")
    some = stage(members.join(rest.select("component").distinct(), "component", "left_semi"), "open")
    n = blocks(rest, "n_rest").join(blocks(some, "n_all"), "component")
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)) for c in ("n_all", "n_rest")]
    left = rest.join(n, "component").withColumn("x", block("n_rest", 8)).withColumn("y", every[0])
    right = some.join(n, "component").withColumn("y", block("n_all", 9)).withColumn("x", every[1])
    dealt = [t.select(F.xxhash64("component", "x", "y").alias("part"), F.lit(side).alias("side"), "node") for side, t in enumerate((left, right))]
    return stage(connected_components(near.unionByName(verified(dealt[0].unionByName(dealt[1])))), "labels")
