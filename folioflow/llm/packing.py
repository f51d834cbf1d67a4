"""Pattern packing of documents into sequences by non-negative least squares.

Documents become pieces of at most `capacity` tokens. All planning works on the
histogram of piece lengths, which has `capacity` bins however many documents there
are: patterns of a few lengths that fill a sequence are enumerated, their repeat counts are
fitted to the histogram by non-negative least squares and rounded down, and best fit
packs what remains. The k-th piece of a length then takes the k-th place that the plan
has for that length.

Results for odd input: null or empty texts are the closing id alone; repeated rows are packed
each for itself; null ids are packed as well; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, stage, text_chunks

CAPACITY, CLOSING_ID = 4096, 1
#: Words whose ids a Python worker remembers.
REMEMBERED = 300_000
_MARKS = ".,!?:;|&%$#*"
#: White space for str.split, but not for the tokenizer.
_CONTROL = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _ends_plainly(body: str) -> bool:
    """Whether marks after it are parts of their own: a last letter whose normal form, in lower case, ends in a combining mark takes them in."""
    return body[-1].isalpha() and len(unicodedata.normalize("NFC", body[-1].lower())) == 1


class Encoder:
    """Ids of whole texts; parts between white space are independent, so each is encoded once."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model, self.letters, self.known = self.tokenizer.model, _byte_letters(), {}

    def part(self, part: str) -> list[int]:
        """Ids of a part without white space: a letters-only part goes straight to the model."""
        body = part.rstrip(_MARKS)
        if body and body != part and _ends_plainly(body):
            return self.part(body) + self.part(part[len(body) :])
        if part.isalpha() and max(part) < "Ā":
            return [t.id for t in self.model.tokenize(part.lower().encode().decode("latin-1").translate(self.letters))]
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        if _CONTROL.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        known, ids = self.known, []
        for part in text.split():
            found = known.get(part)
            if found is None:
                body = part.rstrip(_MARKS)
                if body and body != part and _ends_plainly(body):
                    tail = part[len(body) :]
                    if (head := known.get(body)) is None:
                        head = self._keep(body)
                    if (end := known.get(tail)) is None:
                        end = self._keep(tail)
                    ids += head
                    ids += end
                    continue
                found = self._keep(part)
            ids += found
        return ids

    def _keep(self, part: str) -> list[int]:
        found = self.part(part)
        if len(self.known) < REMEMBERED and len(part) < 64:
            self.known[part] = found
        return found


_ENCODERS: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    if file not in _ENCODERS:
        _ENCODERS[file] = Encoder(file)
    return _ENCODERS[file]


def pieces(docs: DataFrame, file: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the tokenized documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch, texts in text_chunks(batches):
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.array([*encoder(file).encode(text.decode()), CLOSING_ID], dtype="<u4")
                rows += [(doc, k, a, len(own := ids[a : a + capacity]), zlib.crc32(own.tobytes())) for k, a in enumerate(range(0, len(ids), capacity))]
            columns = zip(*rows, strict=True)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Least squares of a x = b over x >= 0, by accelerated projected gradient on sparse columns.

    a: one row of lengths' bins per pattern (n x parts); a pattern counts each of its bins once.
    """
    n, parts = a.shape
    x = np.zeros(n)
    y, t = x.copy(), 1.0
    # the largest eigenvalue, from a few power steps
    v = np.ones(n)
    for _ in range(12):
        u = np.bincount(a.ravel(), np.repeat(v, parts), minlength=len(b))
        w = u[a].sum(1)
        step = np.linalg.norm(w) or 1.0
        v = w / step
    for _ in range(rounds):
        u = np.bincount(a.ravel(), np.repeat(y, parts), minlength=len(b)) - b
        new = np.maximum(0, y - u[a].sum(1) / (1.05 * step))
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / s * (new - x)
        x, t = new, s
    return x


def _patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int, parts: int) -> np.ndarray:
    """Ascending tuples of `parts` lengths that fill the capacity or come closest to it.

    For each choice of the longer parts the last is the largest length that still fits; with
    three parts and more the inner ones are taken from at most 64 common lengths.
    """
    common = np.sort(lengths[np.argsort(-counts, kind="stable")[:64]])
    heads = lengths[:, None]
    for _ in range(parts - 2):
        heads = np.concatenate([np.repeat(heads, len(common), axis=0), np.tile(common, len(heads))[:, None]], axis=1)
    room = capacity - heads.sum(1)
    heads, room = heads[room >= lengths[0]], room[room >= lengths[0]]
    last = lengths[np.searchsorted(lengths, room, side="right") - 1]
    full = np.sort(np.concatenate([heads, last[:, None]], axis=1), axis=1)
    full = full[full.sum(1) >= capacity - max(1, capacity // 256)]
    return np.unique(full, axis=0) if len(full) else np.empty((0, parts), dtype=np.int64)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences); uses the histogram up exactly."""
    left = {int(k): int(v) for k, v in histogram.items() if v}
    out: list[tuple[tuple[int, ...], int]] = []
    if capacity in left:
        out.append(((capacity,), left.pop(capacity)))
    for parts in (2, 3):
        lengths = np.array(sorted(left), dtype=np.int64)
        if not len(lengths):
            break
        counts = np.array([left[k] for k in lengths.tolist()], dtype=float)
        patterns = _patterns(lengths, counts, capacity, parts)
        if not len(patterns):
            continue
        fitted = nnls(np.searchsorted(lengths, patterns), counts)
        for k in np.argsort(-fitted, kind="stable").tolist():
            times = int(fitted[k] + 1e-6)
            if not times:
                break
            pattern = tuple(patterns[k].tolist())
            times = min(times, *(left.get(x, 0) // pattern.count(x) for x in pattern))
            if times > 0:
                out.append((pattern, times))
                for x in pattern:
                    left[x] -= times
        left = {k: v for k, v in left.items() if v}
    out += best_fit(left, capacity)
    return out


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first; each sequence takes the longest that still fits, equal sequences at once."""
    left, out = dict(left), []
    lengths = sorted(left)
    while lengths:
        pattern, room, used = [], capacity, {}
        while True:
            at = bisect.bisect_right(lengths, room) - 1
            while at >= 0 and left[lengths[at]] <= used.get(lengths[at], 0):
                at -= 1
            if at < 0:
                break
            x = lengths[at]
            pattern.append(x)
            used[x] = used.get(x, 0) + 1
            room -= x
        times = min(left[x] // n for x, n in used.items())
        out.append((tuple(pattern), times))
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
                lengths.remove(x)
    return out


def places(spark, made: list[tuple[tuple[int, ...], int]]) -> DataFrame:
    """length, first, last, sequence, offset: ranks [first, last) of a length take the sequences from
    `sequence` on, at `offset`. Its rows follow the number of distinct lengths, not of documents."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in made:
        offset = 0
        for x in pattern:
            first = taken.get(x, 0)
            rows.append((x, first, first + times, sequence, offset))
            taken[x] = first + times
            offset += x
        sequence += times
    return spark.createDataFrame(rows, "length long, first long, last long, sequence long, offset long")


#: Pieces of one length that a task numbers on average, at most.
NUMBERED = 500_000


def ranks(cut: DataFrame, salts: int = 64) -> DataFrame:
    """Adds rank: 0, 1, ... within each length. A length's rows are dealt over `salts` parts, whose
    counts give each part its first rank, so one common length isn't one task's work."""
    from pyspark.sql import Window

    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("length", "salt", before.alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("own", F.row_number().over(order) - 1)
    return numbered.join(bases, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("own")).drop("own", "base", "salt")


def pack(docs: DataFrame, file: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    spark = docs.sparkSession
    ready(spark)
    cut = stage(pieces(docs, file, capacity, id_col, text_col), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    if not histogram:
        return cut.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    where = places(spark, plan(histogram, capacity)).withColumnRenamed("length", "l")
    ranked = ranks(cut, max(64, max(histogram.values()) // NUMBERED))
    at = (F.col("length") == F.col("l")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    out = ranked.join(F.broadcast(where), at)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")
