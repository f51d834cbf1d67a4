"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features say which hashed n-grams occur in it. Each is scaled by the log ratio of
its smoothed frequency in toxic and other training texts; logistic regression with an L2
penalty is fitted on the scaled features, so the scores are probabilities.

Results for odd input: null and empty texts have no feature and get the score of the intercept;
rows with a null id or label are scored but not learned from; a document labelled twice
counts as toxic if one label says so; repeated rows are scored each; extra columns are
ignored; an empty table gives an empty result; with labels of one kind or none the
score is that kind's share (0 with none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, ready, stage, text_chunks

BITS, SIZES = 20, (3, 4, 5, 6)
#: Training documents of each label at most (expected; taken by a hash of the id).
TRAIN_TOXIC, TRAIN_OTHER = 3_000, 5_000
#: Buckets that the model is fitted on: those whose ratios are surest.
KEEP = 20_000
_PLACE = np.random.PCG64(31).random_raw(max(SIZES)) | np.uint64(1)


def features(text: str) -> np.ndarray:
    """Sorted distinct n-gram buckets of a text, padded with a space at both ends."""
    if not text:
        return np.empty(0, dtype=np.int32)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    points[points < 33] = 32
    spread = mix(points + np.uint64(1))
    found, h = [], spread * _PLACE[0]
    for n in range(2, max(SIZES) + 1):
        if len(spread) < n:
            break
        h = h[: len(spread) - n + 1] + spread[n - 1 :] * _PLACE[n - 1]
        if n in SIZES:
            found.append((((h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)).astype(np.int32))
    return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.int32)


class Model:
    """score = sigmoid(intercept + sum of the weights of the features)."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights.astype(np.float32), intercept

    def score(self, text: str) -> float:
        z = self.intercept + float(self.weights[features(text)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def ratios(counted: DataFrame, n_toxic: int, n_other: int, keep: int = KEEP) -> DataFrame:
    """f, ratio: log-count ratios of the `keep` buckets whose ratios are surest, at ties those with the smaller number.

    counted: f, toxic, other: how many training texts of each label have the bucket.
    """
    toxic, other = F.col("toxic") + 1, F.col("other") + 1
    ratio = F.log(toxic / (n_toxic + 2)) - F.log(other / (n_other + 2))
    rated = counted.where("toxic + other >= 3").select("f", ratio.alias("ratio"), (F.abs(ratio) / F.sqrt(1 / toxic + 1 / other)).alias("sure"))
    return rated.where("sure > 0").orderBy(F.desc("sure"), "f").limit(keep).select("f", "ratio")


def train(every: np.ndarray, ends: np.ndarray, y: np.ndarray, ratio: np.ndarray, share: float, penalty: float = 3e-3, rounds: int = 80) -> tuple[np.ndarray, float]:
    """Logistic regression on ratio-scaled features: the buckets' weights, scaled as well, and the intercept.

    every: the texts' buckets (places in ratio) one after the other; ends: where each text's end; share:
    of toxic documents among all labelled. Texts are gone through in runs, so that little is held at once.
    """
    d, n = len(ratio), len(y)
    begin = np.concatenate(([0], ends[:-1]))
    runs = [(a, min(a + 500, n)) for a in range(0, n, 500)]
    weights, intercept, sample = np.zeros(d), 0.0, y.mean()
    m, v = np.zeros(d), np.zeros(d)
    mb = vb = 0.0
    for t in range(1, rounds + 1):
        scaled, g, gb = weights * ratio, np.zeros(d), 0.0
        for a, b in runs:
            own = every[begin[a] : ends[b - 1]]
            of = np.repeat(np.arange(b - a), ends[a:b] - begin[a:b])
            z = np.bincount(of, scaled[own], minlength=b - a) + intercept
            miss = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[a:b]
            g += np.bincount(own, miss[of], minlength=d)
            gb += float(miss.sum())
        g, gb = g * ratio / n + penalty * weights, gb / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.02 / (1 + t / 60)
        weights -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        intercept -= rate * (mb / (1 - 0.9**t)) / (vb / (1 - 0.99**t) + 1e-12) ** 0.5
    intercept += np.log(share / (1 - share)) - np.log(sample / (1 - sample))
    return weights * ratio, float(intercept)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", toxic: int = TRAIN_TOXIC, other: int = TRAIN_OTHER) -> Model:
    """A model from labelled texts, of 2^BITS weights. Only the training texts' buckets with a ratio reach the driver."""
    ready(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    n = {r[0]: r[1] for r in rows.groupBy("y").count().collect()}
    total = sum(n.values())
    if len(n) < 2:
        return Model(np.zeros(1 << BITS), -500.0 if not n.get(1) else 500.0)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    rows = rows.where(place < F.when(F.col("y") == 1, int((1 << 20) * min(1, toxic / n[1]))).otherwise(int((1 << 20) * min(1, other / n[0]))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), dtype=np.int32)
        texts_of = [0, 0]
        for batch, texts in text_chunks(batches):
            for y, t in zip(batch.column("y").to_pylist(), texts, strict=True):
                seen[y, features(t.decode())] += 1
                texts_of[y] += 1
        used = np.flatnonzero(seen.any(0))
        every = np.concatenate((used, [1 << BITS]))  # one more bucket counts the texts themselves
        columns = [np.concatenate((seen[y, used], [texts_of[y]])) for y in (1, 0)]
        yield pa.record_batch([pa.array(every, pa.int32()), *(pa.array(c, pa.int64()) for c in columns)], names=["f", "toxic", "other"])

    counted = stage(rows.mapInArrow(count, "f int, toxic long, other long").groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "buckets")
    texts_of = counted.where(F.col("f") == 1 << BITS).first()
    if texts_of is None or not texts_of["toxic"] or not texts_of["other"]:
        return Model(np.zeros(1 << BITS), float(np.log(n[1] / n[0])))
    kept = ratios(counted.where(F.col("f") < 1 << BITS), texts_of["toxic"], texts_of["other"]).toArrow()  # KEEP rows at most
    if not kept.num_rows:
        return Model(np.zeros(1 << BITS), float(np.log(n[1] / n[0])))
    kept = kept.sort_by("f")
    chosen, ratio = kept.column("f").to_numpy(), kept.column("ratio").to_numpy()
    place_of = np.full(1 << BITS, -1, dtype=np.int32)
    place_of[chosen] = np.arange(len(chosen))
    sent = labelled.sparkSession.sparkContext.broadcast(place_of)
    kind = np.uint16 if len(chosen) <= 1 << 16 else np.int32  # the driver holds the training texts' places

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            own = [sent.value[features(t.decode())] for t in texts]
            own = [x[x >= 0] for x in own]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column("y"), pa.array([len(x) for x in own], pa.int64()), pa.array([x.astype(kind).tobytes() for x in own], pa.binary())], names=["doc_id", "y", "n", "f"])

    got = rows.mapInArrow(describe, "doc_id long, y int, n long, f binary").toArrow().sort_by("doc_id")  # the training texts' chosen buckets
    every = np.frombuffer(b"".join(x.as_py() for x in got.column("f")), dtype=kind)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[chosen], intercept = train(every, np.cumsum(got.column("n").to_numpy()), got.column("y").to_numpy().astype(np.float64), ratio, n[1] / total)
    return Model(weights, intercept)


def predict(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text."""
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            found = [sent.value.score(t.decode()) for t in texts]
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64()), pa.array([int(x >= 0.5) for x in found], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
