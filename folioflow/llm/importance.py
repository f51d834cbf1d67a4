"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Texts are cut into tokens (runs of letters and digits, runs of marks). Their features are
hashed single tokens and pairs, where a pair of equal tokens and a token in capitals each
are a feature of their own. Two generative models hold the features' frequencies: one of
the target text (labelled as good), one of the raw text (all documents). A document's
weight is the log ratio of its probabilities under the two, tempered by its length; adding Gumbel noise and
keeping the k largest draws k documents without replacement in proportion to the weights.

Results for odd input: null and empty texts have weight 0; a null id gets noise from its
text alone and is kept or not like any other row; repeated rows have equal keys, so rows that tie
at the last place are kept together; extra columns are ignored; an empty table gives an
empty result; without a target text all weights are 0 and all documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _LOWER, mix, ready, stage, text_chunks, threshold, with_ids

#: Buckets of single tokens and of pairs; more are for pairs of equal tokens and capitals.
BUCKETS = 1 << 15
_SIZE = 2 * BUCKETS + 2
#: Share of the good documents' weights that may lie below the weights that are counted for k.
LOSS = 0.002
#: How far below those weights a document may lie and still count for k: noise moves keys by about as much.
SLACK = 8.0
#: Features that a weight counts: a longer text weighs as much as LENGTH features of its average, else the
#: sampling noise of the models, which adds up over a long text, would outweigh what it says.
LENGTH = 64
_CLASS = np.ones(256, dtype=np.uint8)
_CLASS[:128] = 2
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_CLASS[[0, *range(9, 14), 32]] = 0
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[65:91] = 1
_LETTER = np.zeros(256, dtype=np.int64)
_LETTER[[*range(65, 91), *range(97, 123)]] = 1
_BYTES = np.random.PCG64(41).random_raw(256) | np.uint64(1)
_PLACES = np.random.PCG64(42).random_raw(64) | np.uint64(1)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the texts one after the other, and where each text's begin (and the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    kind = _CLASS[data]
    inside = kind > 0
    first = inside.copy()
    first[1:] &= kind[1:] != kind[:-1]
    at = np.flatnonzero(first)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    begin = np.concatenate(([0], np.searchsorted(at, ends)))
    if not len(at):
        return np.empty(0, np.int64), begin
    letters = data[inside]
    lead = np.flatnonzero(first[inside])
    size = np.diff(np.append(lead, len(letters)))
    place = (np.arange(len(letters)) - np.repeat(lead, size)) & 63
    words = mix(np.add.reduceat(_BYTES[_LOWER[letters]] * _PLACES[place], lead))
    capital = (np.add.reduceat(_UPPER[letters], lead) == np.add.reduceat(_LETTER[letters], lead)) & (kind[at] == 1) & (size > 1) & (np.add.reduceat(_UPPER[letters], lead) > 1)
    single = (words & np.uint64(BUCKETS - 1)).astype(np.int64)
    single[capital] = 2 * BUCKETS
    pairs = (mix(words[:-1] * np.uint64(3) + words[1:]) & np.uint64(BUCKETS - 1)).astype(np.int64) + BUCKETS
    pairs[words[1:] == words[:-1]] = 2 * BUCKETS + 1
    within = np.ones(len(words), dtype=bool)
    within[np.unique(np.maximum(begin[1:] - 1, 0))] = False  # the last token of a text has no pair
    both = np.empty((len(words), 2), dtype=np.int64)
    both[:, 0] = single
    both[:-1, 1] = pairs
    use = np.ones((len(words), 2), dtype=bool)
    use[:, 1] = within
    use[-1, 1] = False
    before = np.concatenate(([0], np.cumsum(use.sum(1))))
    return both[use], before[begin]


def counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each feature occurs in all texts; every task sends one row of _SIZE sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE, dtype=np.int64)
        for _, texts in text_chunks(batches):
            total += np.bincount(features(texts)[0], minlength=_SIZE)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["f", "n"])

    out = np.zeros(_SIZE, dtype=np.int64)
    for f, n in docs.select(F.col(text_col).alias("text")).mapInArrow(count, "f int, n long").groupBy("f").agg(F.sum("n")).collect():  # _SIZE rows at most
        out[f] = n
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Of the two models' smoothed frequencies; singles and pairs are normalised apart."""
    if not target.sum() or not raw.sum():
        return np.zeros(_SIZE)
    out = np.zeros(_SIZE)
    for part in (np.r_[0:BUCKETS, 2 * BUCKETS], np.r_[BUCKETS : 2 * BUCKETS, 2 * BUCKETS + 1]):
        t, r = target[part].astype(float), raw[part].astype(float)
        q = (r + 1) / (r.sum() + len(part))
        p = (t + len(part) * q) / (t.sum() + len(part))  # the raw model is the target's prior
        out[part] = np.log(p) - np.log(q)
    return out


def weighted(docs: DataFrame, ratio: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, log_weight, gumbel_key."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            found, begin = features(texts)
            own = [float(sent.value[found[a:b]].mean()) * min(b - a, LENGTH) if b > a else 0.0 for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(own, pa.float64()), batch.column("noise")], names=["doc_id", "log_weight", "noise"])

    h = F.coalesce(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(0))
    h = F.when(F.col(id_col).isNull(), F.xxhash64(F.lit(seed), F.col(text_col))).otherwise(h)
    uniform = (F.pmod(h, F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (-F.log(-F.log(uniform))).alias("noise"))
    out = rows.mapInArrow(score, "doc_id long, log_weight double, noise double")
    return out.select("doc_id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("gumbel_key"))


def resample(docs: DataFrame, good: DataFrame, loss: float = LOSS, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, log_weight, gumbel_key, kept: k documents are drawn.

    good: ids (id_col) of the documents labelled as good. Half of them, by a hash, are the target text;
    k is how many documents weigh as much as all but a share `loss` of the other half do, less SLACK.
    """
    ready(docs.sparkSession)
    held = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(id_col)), F.lit(2)) == 1
    target = with_ids(docs, good.where(~held), id_col, "left_semi")
    ratio = log_ratio(counts(target, text_col), counts(docs, text_col))
    table = stage(weighted(docs, ratio, seed, id_col, text_col), "weights")
    known = table.join(good.where(held).select(F.col(id_col).cast("long").alias("doc_id")), "doc_id", "left_semi")
    lowest = known.agg(F.percentile_approx("log_weight", loss, 10_000)).first()[0]
    k = table.count() if lowest is None else table.where(F.col("log_weight") >= F.lit(lowest - SLACK)).count()
    least = threshold(table, "gumbel_key", k)
    return table.withColumn("kept", F.lit(False) if least is None else F.col("gumbel_key") >= F.lit(least))


def good_ids(labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """doc_id of the documents labelled as good."""
    return labels.where((F.col(label_col) == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
