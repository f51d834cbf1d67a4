"""SpotSigs document fingerprints: chains of content words that follow common-word anchors.

Every common word (an antecedent) starts a chain of the next content words, taken
`distance` apart; the hashes of the chains are a text's signature set. The fingerprint
is that set as text: sorted hexadecimal hashes, comma-joined. Likeness is the Jaccard
coefficient of two sets. Sets are partitioned by their length, and sets of partitions that aren't
neighbours are not compared; the comparison of others ends where the threshold is out of reach.

Results for odd input: a null or blank text has an empty fingerprint; a text with words but
no chain has one signature, of its whole word sequence; two empty fingerprints have likeness 1; repeated
rows and ids are ordered by text; a null id sorts first; extra columns are ignored; an
empty table gives an empty result; the only row of a table is its own next row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, digest, parallelism, ready, sequence_hash, stage, text_chunks, word_hashes
from .verify import components

# Common words of four languages that start chains.
ANTECEDENTS = (
    "a an and are as at be been but by can do for from had has have he her his i if in is it its not of on or she that the their "
    "they this to was we were will with you your "
    "der die das den dem des ein eine einer eines und oder ist sind war nicht zu von mit auf für im in am als auch bei nach aus "
    "le la les un une des du de et ou est sont dans par pour sur avec que qui pas au aux ce se il elle en "
    "el los las una unos unas y o es son del al por para con que no se su lo en como más"
).split()
CHAIN, DISTANCE = 2, 1
#: Documents and signatures that a block of a large candidate group holds on average, at most.
BLOCK_DOCS, BLOCK_SIGNATURES = 256, 400_000
#: Signatures that are compared before the bound is looked at again.
RUN = 512
_MARKS = b".,!?:;|&%$#*()[]\"'"


def _common() -> np.ndarray:
    words = [w.encode() for w in dict.fromkeys(ANTECEDENTS)]
    hashes, _ = word_hashes(words)
    return np.sort(hashes)


_COMMON = _common()
_CHAIN = np.random.PCG64(21).random_raw(16) | np.uint64(1)
_TO_SPACE = bytes.maketrans(_MARKS, b" " * len(_MARKS))


def signature_sets(texts: list[bytes], chain: int = CHAIN, distance: int = DISTANCE) -> list[np.ndarray]:
    """Each text's sorted distinct chain hashes (48 bits)."""
    words, begin = word_hashes([t.translate(_TO_SPACE) for t in texts])
    if not len(words):
        return [np.empty(0, np.uint64) for _ in texts]
    common = _COMMON[np.minimum(np.searchsorted(_COMMON, words), len(_COMMON) - 1)] == words
    content = np.flatnonzero(~common)
    before = np.concatenate(([0], np.cumsum(~common)))  # content words before each place
    anchors = np.flatnonzero(common)
    text_of = np.searchsorted(begin, anchors, side="right") - 1
    first = before[anchors]
    last = first + (chain - 1) * distance
    whole = last < before[begin[text_of + 1]]  # the chain ends in the anchor's text
    anchors, first, text_of = anchors[whole], first[whole], text_of[whole]
    hashes = words[anchors] * _CHAIN[0]
    for c in range(chain):
        hashes = (hashes ^ (hashes >> np.uint64(29))) * _CHAIN[1] + words[content[first + c * distance]] * _CHAIN[2 + c]
    hashes = (hashes ^ (hashes >> np.uint64(32))) * _CHAIN[-1] >> np.uint64(16)
    at = np.searchsorted(text_of, np.arange(len(texts) + 1))
    out = []
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        if b > a:
            out.append(np.unique(hashes[a:b]))
        elif begin[i + 1] > begin[i]:
            out.append(np.array([sequence_hash(words[begin[i] : begin[i + 1]]) >> 16], dtype=np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def fingerprint(signatures: np.ndarray) -> str:
    if not len(signatures):
        return ""
    joined = signatures.astype(">u8").tobytes().hex()
    return ",".join([joined[k + 4 : k + 16] for k in range(0, len(joined), 16)])


def partition(n: int, least: float) -> int:
    """Number of the length partition of sets of n signatures: sets at a likeness of `least` or more lie in the same
    partition or in neighbouring ones."""
    return int(math.log(n) / -math.log(least) + 1e-9) if n else -1


def likeness(a: np.ndarray, b: np.ndarray, least: float | None = None) -> float:
    """Jaccard coefficient of two sets in ascending order; 0 if it is below `least`, by default the smallest
    one above 0 that sets of their sizes can have.

    Sets of partitions that aren't neighbours, or of sizes too far apart, are not compared; others are gone
    through in runs of their hashes, until what may still be shared can't reach the threshold.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    if least is None:
        least = 1 / (n + m)
    if abs(partition(n, least) - partition(m, least)) > 1 or min(n, m) < least * max(n, m):
        return 0.0
    need = least * (n + m) / (1 + least) - 1e-9  # shared signatures at the threshold
    both = x = y = 0
    while x < n and y < m:
        if both + min(n - x, m - y) < need:
            return 0.0
        top = min(a[min(x + RUN, n) - 1], b[min(y + RUN, m) - 1])
        u, v = int(np.searchsorted(a, top, "right")), int(np.searchsorted(b, top, "right"))
        both += len(np.intersect1d(a[x:u], b[y:v], assume_unique=True))
        x, y = u, v
    return both / (n + m - both) if both >= need else 0.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _described(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """Rows of _FIELDS for texts and those that follow them."""
    raw = [t.encode() for t in texts]
    after = [edited(t, f).encode() for t, f in zip(texts, following, strict=True)]
    own, new = signature_sets(raw), signature_sets(after)
    then = [*own[1:], *signature_sets([following[-1].encode()])]  # texts follow one another
    return pa.record_batch([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in after]),
        pa.array([fingerprint(x) for x in own]), pa.array([fingerprint(x) for x in new]),
        pa.array([likeness(x, y) for x, y in zip(own, new, strict=True)], pa.float64()), pa.array([likeness(x, y) for x, y in zip(own, then, strict=True)], pa.float64()),
    ], schema=_SCHEMA)


def stability(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edits, and how alike they stay.

    The table is dealt out by ranges of the id and sorted within each; a text needs the one after it, so
    only each range's last text waits for the next range's first one.
    """
    spark = docs.sparkSession
    ready(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = parallelism(spark)
    lowest = rows.agg(F.min("doc_id")).first()[0]
    quantiles = rows.where("doc_id is not null").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n) if n > 1 and lowest is not None else []
    bounds = sorted({x for x in quantiles if x > lowest})
    # a range's number is the bounds that its ids reach; bounds are ids, so no range is empty. They are fixed here,
    # so that both walks below see the same ranges
    span = F.size(F.filter(F.lit(bounds).cast("array<double>"), lambda x: x <= F.col("doc_id"))) if bounds else F.lit(0)
    rows = rows.select("doc_id", "text", F.when(F.col("doc_id").isNull(), 0).otherwise(span).cast("int").alias("range"))
    dealt = rows.repartitionByRange(n, "range").sortWithinPartitions("range", "doc_id", "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Described rows of all texts but the last of each range."""
        held: tuple[int, int | None, str] | None = None
        for batch in batches:
            spans, ids, texts = (batch.column(c).to_pylist() for c in ("range", "doc_id", "text"))
            if not ids:
                continue
            if held is not None:
                spans, ids, texts = [held[0], *spans], [held[1], *ids], [held[2], *texts]
            cuts = [0, *[k for k in range(1, len(spans)) if spans[k] != spans[k - 1]], len(spans)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if y - x > 1:
                    for a, b in chunks(map(len, texts[x : y - 1])):
                        yield _described(ids[x + a : x + b], texts[x + a : x + b], texts[x + a + 1 : x + b + 1])
            held = spans[-1], ids[-1], texts[-1]

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last text of each range, and its first one under the number of the range before."""
        names = ["range", "doc_id", "tail", "head"]
        types = (pa.int32(), pa.int64(), pa.string(), pa.string())

        def rows(*found: tuple) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

        last: tuple | None = None
        for batch in batches:
            spans = batch.column("range").to_numpy()
            if not len(spans):
                continue
            lead = [0, *(np.flatnonzero(spans[1:] != spans[:-1]) + 1).tolist(), len(spans)]
            for x, y in zip(lead, lead[1:], strict=False):
                if last is None or last[0] != spans[x]:
                    if last is not None:
                        yield rows(last)
                    yield rows(((int(spans[x]) - 1) % (len(bounds) + 1), None, None, batch.column("text")[x].as_py()))
                last = (int(spans[x]), batch.column("doc_id")[y - 1].as_py(), batch.column("text")[y - 1].as_py(), None)
        if last is not None:
            yield rows(last)

    # two rows for each range
    edges = dealt.mapInArrow(ends, "range int, doc_id long, tail string, head string")
    edges = edges.groupBy("range").agg(F.max("doc_id").alias("doc_id"), F.max("tail").alias("tail"), F.max("head").alias("following"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t, f in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tail", "following")), strict=True):
                yield _described([i], [t], [f])

    return dealt.mapInArrow(walk, _FIELDS).unionByName(edges.mapInArrow(finish, _FIELDS))


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, component_id, kept: texts whose signature sets have a Jaccard coefficient of `percent` or more link.

    Sets are partitioned by their length (ratio 100 / percent, so linked sets lie in the same or the next
    partition); within a partition only sets that share one of their rarest signatures are proposed, which
    every linked pair does (prefix filter). Equal sets are one node. Empty sets and null ids link with
    nothing.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            sets = signature_sets(texts)
            keys = [digest(x) if len(x) else None for x in sets]
            yield pa.record_batch([batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array([x.tolist() for x in sets], pa.list_(pa.int64()))], names=["doc_id", "key", "signatures"])

    described = stage(rows.mapInArrow(describe, "doc_id long, key binary, signatures array<long>"), "sets")
    named = described.where("doc_id is not null and key is not null")
    classes = stage(named.groupBy("key").agg(F.min("doc_id").alias("node"), F.first("signatures").alias("signatures")), "classes")
    spread = classes.select("node", F.size("signatures").alias("n"), F.explode("signatures").alias("s"))
    rarity = spread.groupBy("s").agg(F.count("*").alias("df"))
    ranked = spread.join(rarity, "s").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("r"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    slot = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9)
    entries = ranked.select("node", F.explode(F.slice("r", F.lit(1), prefix.cast("int"))).alias("x"), F.array(slot, slot + 1).alias("slots")).select("node", "x.s", F.explode("slots").alias("slot"))
    leads = entries.groupBy("slot", "s").agg(F.min("node").alias("lead"), F.max("node").alias("most")).where("lead < most").select("slot", "s", "lead")
    proposed = entries.join(leads, ["slot", "s"]).where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b"))
    sizes = named.groupBy(F.col("doc_id").alias("node")).agg(F.max(F.size("signatures")).alias("n"))
    labels = components(proposed, rows, sizes, signature_sets, percent, BLOCK_DOCS, BLOCK_SIGNATURES)
    found = classes.select("key", "node").join(labels, "node", "left").select("key", F.coalesce("component", "node").alias("component"))
    of = named.groupBy("doc_id").agg(F.min("key").alias("key")).join(found, "key").select("doc_id", "component")
    component = F.coalesce("component", "doc_id")
    out = described.select("doc_id").join(of, "doc_id", "left")
    return out.select("doc_id", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
