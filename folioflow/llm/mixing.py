"""Mixing to target weights with soft memberships.

A naive Bayes classifier, fitted on a labelled table, gives each document a posterior over the
domains. Projected-gradient least squares then finds a nonnegative rate for each document so that
the expected tokens of each domain, summed over the documents at their rates, meet the targets.

A document's gradient depends on nothing but its own tokens and posterior and on the
domains' current misses, so a step is one aggregation of as many sums as there are
domains, and any task can replay the few steps to find a document's rate.

Results for odd input: null and empty texts have no tokens, the prior as posterior, and one copy;
rows with a null id or domain are not learned from; repeated rows are rated each; extra
columns are ignored; an empty table gives an empty result; with nothing to learn from,
all rates are 1; the weight of a domain without documents goes to the other named ones; domains
that no weight names keep the tokens that they have.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, stage, text_chunks, word_hashes

BUCKETS = 1 << 15
#: Domains with weights of their own, those with most labelled documents; all others are pooled by a hash of
#: their names into so many domains, so models, posteriors and targets are bounded whatever the number of names.
OWN_DOMAINS, POOLS = 96, 32
#: Labelled documents that the classifier is fitted on at most (expected; taken by a hash of the id).
TRAIN_DOCS = 20_000
#: Projected-gradient steps end when the largest miss, or its change, is below TOLERANCE of the largest target;
#: a warning says so if STEPS did not suffice.
STEPS, TOLERANCE = 60, 1e-6
#: Words from which on a text is summed up by bucket.
LONG = 4_096


class Classifier:
    def __init__(self, domains: list[str], prior: np.ndarray, table: np.ndarray, pool: str | None = None):
        """pool: what the names of pooled domains begin with."""
        self.domains, self.prior, self.table, self.pool = domains, prior, table, pool

    def weights(self, given: dict[str, float]) -> np.ndarray:
        """Weights of the domains; a pool's is the sum of its members'."""
        out = dict.fromkeys(self.domains, 0.0)
        for name, w in given.items():
            at = name if name in out or self.pool is None else f"{self.pool}{zlib.crc32(name.encode()) % POOLS}"
            if at in out:
                out[at] += max(0.0, w)
        return np.array([out[x] for x in self.domains])

    def posteriors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the texts (n) and their posteriors (n x domains)."""
        words, begin = word_hashes(texts)
        at = (words & np.uint64(BUCKETS - 1)).astype(np.int64)
        out = np.tile(np.log(self.prior), (len(texts), 1))
        for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
            if b - a > LONG:  # its words' rows would take a multiple of its size; those of its buckets are bounded
                n = np.bincount(at[a:b], minlength=BUCKETS)
                used = np.flatnonzero(n)
                out[i] += n[used].astype(np.float64) @ self.table[used].astype(np.float64)
            elif b > a:
                out[i] += self.table[at[a:b]].sum(0, dtype=np.float64)
        out = np.exp(out - out.max(1, keepdims=True))
        return np.diff(begin), out / out.sum(1, keepdims=True)


def fit(labelled: DataFrame, domain_col: str, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS) -> Classifier:
    """Naive Bayes on hashed words; BUCKETS weights per domain, of which OWN_DOMAINS + POOLS are told apart."""
    ready(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(domain_col).cast("string").alias("domain")).where("doc_id is not null and domain is not null")
    named = rows.groupBy("domain").count().orderBy(F.desc("count"), "domain").limit(OWN_DOMAINS + 1).collect()
    pool = None
    if len(named) > OWN_DOMAINS:
        own = [r[0] for r in named[:OWN_DOMAINS]]
        pool = "pool "
        while any(x.startswith(pool) for x in own):
            pool += "- "
        pooled = F.concat(F.lit(pool), (F.crc32(F.col("domain").cast("binary")) % POOLS).cast("string"))
        rows = rows.withColumn("domain", F.when(F.col("domain").isin(own), F.col("domain")).otherwise(pooled))
        named = rows.groupBy("domain").count().collect()
    shares = {r[0]: r[1] for r in named}
    n = sum(shares.values())
    if n > train_docs:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * train_docs / n))

    domains = sorted(shares)
    number = {x: k for k, x in enumerate(domains)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch, texts in text_chunks(batches):
            words, begin = word_hashes(texts)
            at = (words & np.uint64(BUCKETS - 1)).astype(np.int32)
            for domain, a, b in zip(batch.column("domain").to_pylist(), begin[:-1].tolist(), begin[1:].tolist(), strict=True):
                own = total.setdefault(number[domain], np.zeros(BUCKETS, dtype=np.int32))
                own += np.bincount(at[a:b], minlength=BUCKETS).astype(np.int32)
        for k, own in total.items():
            used = np.flatnonzero(own)
            yield pa.record_batch([pa.array(np.full(len(used), k), pa.int32()), pa.array(used, pa.int32()), pa.array(own[used], pa.int64())], names=["domain", "f", "n"])

    c = np.zeros((BUCKETS, len(domains)))
    got = rows.mapInArrow(count, "domain int, f int, n long").groupBy("domain", "f").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows per domain at most
    c[got.column("f").to_numpy(), got.column("domain").to_numpy()] = got.column("n").to_numpy()
    prior = np.array([shares[d] for d in domains], dtype=np.float64)
    table = np.log((c + 0.1) / (c.sum(0) + 0.1 * BUCKETS)) if domains else c
    return Classifier(domains, prior / max(prior.sum(), 1), table.astype(np.float32), pool)


def rates(tokens: np.ndarray, posteriors: np.ndarray, steps: np.ndarray, least: float = 0.0) -> np.ndarray:
    """Replays the steps: each moves a rate against its domains' misses and projects it to >= least."""
    out = np.ones(len(posteriors))
    for step in steps:
        out = np.maximum(least, out - posteriors @ step)
    return np.where((tokens > 0) & (np.abs(out - 1) > 1e-6), out, 1.0)


def moments(described: DataFrame, d: int) -> np.ndarray:
    """Inverse of the domains' second moments, weighted by tokens."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for t, p in _columns(batches, d):
            total += (p * t[:, None]).T @ p
        yield pa.record_batch([pa.array(np.arange(d * d), pa.int32()), pa.array(total.ravel())], names=["k", "x"])

    second = np.zeros(d * d)
    for k, x in described.mapInArrow(add, "k int, x double").groupBy("k").agg(F.sum("x")).collect():  # domains^2 sums
        second[k] = x
    second = second.reshape(d, d)
    return np.linalg.inv(second + np.eye(d) * max(1e-12, 1e-9 * np.trace(second)))


def solve(described: DataFrame, targets: np.ndarray, inverse: np.ndarray, least: float = 0.0, steps: int = STEPS) -> np.ndarray:
    """Steps (n x domains) of projected gradient on 1/2 |expected - targets|^2.

    Rates are measured in the metric of their tokens, and the misses are scaled by the inverse of the domains'
    second moments, so the step size is 1 in the directions that matter.
    """
    d = len(targets)
    taken, last = np.empty((0, d)), None
    limit = TOLERANCE * max(1.0, np.abs(targets).max())
    for _ in range(steps):

        def expected(batches: Iterator[pa.RecordBatch], taken: np.ndarray = taken) -> Iterator[pa.RecordBatch]:
            total = np.zeros(d)
            for t, p in _columns(batches, d):
                total += (t * rates(t, p, taken, least)) @ p
            yield pa.record_batch([pa.array(np.arange(d), pa.int32()), pa.array(total)], names=["k", "x"])

        now = np.zeros(d)
        for k, x in described.mapInArrow(expected, "k int, x double").groupBy("k").agg(F.sum("x")).collect():  # one sum per domain
            now[k] = x
        miss = now - targets
        if np.abs(miss).max() <= limit or last is not None and np.abs(miss - last).max() <= limit:
            break
        taken, last = np.vstack([taken, inverse @ miss]), miss
    else:
        warnings.warn(f"targets are missed by up to {np.abs(miss).max():.3g} tokens after {steps} steps", stacklevel=2)
    return taken


def _columns(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column("n_tokens").to_numpy().astype(np.float64), batch.column("p").flatten().to_numpy().reshape(-1, d)


class Mixer:
    """A fitted classifier and the steps that give every document its rate."""

    def __init__(self, classifier: Classifier, steps: np.ndarray, seed: int, least: float = 0.0):
        self.classifier, self.steps, self.seed, self.least = classifier, steps, seed, least

    def rate(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, posteriors and rates."""
        t, p = self.classifier.posteriors(texts)
        return t, p, rates(t, p, self.steps, self.least)


def targets_of(totals: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Token targets in proportion to the weights: the least ones that no domain's own tokens exceed,
    so that meeting them repeats documents instead of dropping them. Where a weight is 0, the target is
    what the domain has."""
    named = (weights > 0) & (totals > 0)
    if not named.any():
        return totals
    weights = np.where(named, weights, 0) / weights[named].sum()
    return np.where(named, weights * (totals[named] / weights[named]).max(), totals)


def mix(docs: DataFrame, classifier: Classifier, weights: dict[str, float] | None, power: float = 0.7, seed: int = 0, text_col: str = "text", least: float = 0.0) -> Mixer:
    """Fits the rates, which are `least` at least; with 1 no document is dropped, and where memberships are too soft to
    meet the targets so, they are missed by as little as possible. weights: of the domains, those not named are left as they are; None takes the
    domains' own shares to the given power."""
    d = len(classifier.domains)
    if not d:
        return Mixer(Classifier(["all"], np.ones(1), np.zeros((BUCKETS, 1), np.float32)), np.empty((0, 1)), seed)
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches):
            t, p = sent.value.posteriors(texts)
            yield pa.record_batch([pa.array(t, pa.int64()), pa.array(list(p), pa.list_(pa.float64()))], names=["n_tokens", "p"])

    described = stage(docs.select(F.col(text_col).alias("text")).mapInArrow(describe, "n_tokens long, p array<double>"), "posteriors")
    sums = described.select(F.posexplode("p").alias("k", "x"), "n_tokens").groupBy("k").agg(F.sum(F.col("x") * F.col("n_tokens"))).collect()
    totals = np.zeros(d)
    for k, x in sums:
        totals[k] = x
    if not totals.sum():
        return Mixer(classifier, np.empty((0, d)), seed)
    if weights is None:
        wanted = (totals / totals.sum()) ** power
    else:
        wanted = classifier.weights(weights)
    inverse = moments(described, d)
    targets = targets_of(totals, wanted)
    if (wanted > 0).all() and (lowest := (inverse @ targets).min()) > 0:
        # unconstrained rates are the posteriors times these numbers, so none falls below 1 once the targets are
        # raised in proportion until the least of them is 1
        targets = targets / min(1.0, lowest)
    return Mixer(classifier, solve(described, targets, inverse, least), seed, least)


def rated(docs: DataFrame, mixer: Mixer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, posteriors (a map from domain to its share), rate, copies: the rate rounded up or down at
    random by its fraction, by a hash of the id."""
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(mixer)
    domains = pa.array(mixer.classifier.domains, pa.string())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            t, p, r = sent.value.rate(texts)
            copies = np.floor(r + batch.column("u").to_numpy()).astype(np.int64)
            n, d = p.shape
            shares = pa.MapArray.from_arrays(pa.array(np.arange(n + 1) * d, pa.int32()), domains.take(pa.array(np.tile(np.arange(d), n))), pa.array(p.ravel()))
            yield pa.record_batch([batch.column("doc_id"), pa.array(t, pa.int64()), shares, pa.array(r), pa.array(copies)], names=["doc_id", "n_tokens", "posteriors", "rate", "copies"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), _uniform(mixer.seed, id_col, text_col).alias("u"))
    return rows.mapInArrow(score, "doc_id long, n_tokens long, posteriors map<string,double>, rate double, copies long")


def _uniform(seed: int, id_col: str, text_col: str):
    h = F.when(F.col(id_col).isNull(), F.xxhash64(F.lit(seed), F.col(text_col))).otherwise(F.xxhash64(F.lit(seed), F.col(id_col)))
    return F.pmod(h, F.lit(1 << 52)) / float(1 << 52)


def apply(docs: DataFrame, mixer: Mixer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' own columns, each row as often as its copies say."""
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(mixer)
    names = docs.columns

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, text_col):
            r = sent.value.rate(texts)[2]
            copies = np.floor(r + batch.column(len(names)).to_numpy()).astype(np.int64)
            at = np.repeat(np.arange(len(texts)), copies)
            for a in range(0, len(at), 512):
                yield batch.select(list(range(len(names)))).take(pa.array(at[a : a + 512]))

    clash = "mix_u"
    while clash in names:
        clash += "_"
    return docs.withColumn(clash, _uniform(mixer.seed, id_col, text_col)).mapInArrow(repeat, docs.schema)
