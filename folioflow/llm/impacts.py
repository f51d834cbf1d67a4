"""Ranked lexical search with a bit-sliced impact index.

Documents are indexed in blocks of at most BLOCK_DOCS. For each block and term the index holds the
block's slots with that term and, for each of 20 bits, a bitmap over those slots with that bit of the
documents' impacts (1,000,000,000 tf) div (1000 tf + 8 m). A search multiplies a term's bitmaps by its weight
and adds those of an item's terms by bitwise carry arithmetic on whole bitmaps: sums and carries are kept apart
until the last term is in. The top k of a block are found by descending from the most significant slice:
documents with the bit set are in, as long as they are k at most. Blocks are independent; their
candidates, k per item, are ranked by one window.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, only A-Z lower-cased.

Results for odd input: null texts and texts without a term are found by nothing and count in no statistic; every row
is a document of its own, so rows of one id are ranked side by side; null ids are ranked after all others at equal
scores; rows of one item id with equal texts count once, and different texts of one item id are one item with
all their terms; items without terms, or whose terms no document holds, have no rows; extra columns are
ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import parallelism, ready, stage, text_chunks

#: Documents and postings after which a block ends (a document is never split between blocks).
BLOCK_DOCS, BLOCK_POSTINGS = 16_384, 2_000_000
#: Bits of an impact, which is below 1,000,000.
BITS = 20
#: Items that are searched for at once in a block; more items are dealt out in groups.
GROUP_ITEMS = 256
#: Bytes of terms and item lists up to which a search's terms are broadcast; beyond it the join is shuffled.
BROADCAST_BYTES = 16_000_000
#: Bytes of one document that are cut into terms at once.
PART_BYTES = 1_000_000

_TERM = np.ones(256, dtype=bool)
_TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
#: Lower-cases A-Z and turns what is in no term into a blank.
_PLAIN = bytes((b + 32 if 65 <= b <= 90 else b) if _TERM[b] or 65 <= b <= 90 else 32 for b in range(256))
_TERM[65:91] = True


def terms(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def n_terms(texts: list[bytes]) -> np.ndarray:
    """Terms with repeats of each text, by counting where one begins."""
    inside = _TERM[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    return np.diff(np.concatenate(([0], np.cumsum(first)[ends - 1])))


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between terms."""
    at = 0
    while len(text) - at > PART_BYTES:
        part = text[at : at + PART_BYTES].translate(_PLAIN)
        cut = part.rfind(b" ") + 1
        if not cut:  # a term longer than a part: up to its end
            cut = text[at:].translate(_PLAIN).find(b" ") + 1 or len(text) - at
        yield text[at : at + cut]
        at += cut
    yield text[at:]


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(N, L): documents with a term, and all their terms."""
    ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = total = 0
        for _, texts in text_chunks(batches):
            n = n_terms(texts)
            docs, total = docs + int((n > 0).sum()), total + int(n.sum())
        yield pa.record_batch([pa.array([docs]), pa.array([total])], names=["docs", "terms"])

    r = docs.select(F.col(text_col).alias("text")).where("text <> ''").mapInArrow(count, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return r[0] or 0, r[1] or 0


# --- index ------------------------------------------------------------------------------------


def slices(values: np.ndarray, begin: np.ndarray, bits: int) -> pa.Array:
    """A binary per run values[begin[i]:begin[i+1]]: `bits` bitmaps over the run, least significant first, each in whole bytes."""
    size = np.diff(begin)
    width = (size + 7) // 8
    at = np.concatenate(([0], np.cumsum(width)))
    place = np.arange(len(values)) + np.repeat(8 * at[:-1] - begin[:-1], size)
    run = np.repeat(at[:-1] * bits, width)
    inner = np.arange(at[-1]) - np.repeat(at[:-1], width)
    step = np.repeat(width, width)
    out = np.empty(int(at[-1]) * bits, dtype=np.uint8)
    for j in range(bits):
        plane = np.zeros(8 * int(at[-1]), dtype=np.uint8)
        plane[place] = (values >> j) & 1
        out[run + j * step + inner] = np.packbits(plane, bitorder="little")
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer((at * bits).astype(np.int64)), pa.py_buffer(out)])


def runs(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """A binary per run with its values' bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer((begin * values.itemsize).astype(np.int64)), pa.py_buffer(values)])


class Block:
    """Postings of consecutive documents."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.names: dict[bytes, int] = {}
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_postings = 0

    def add(self, ids: list[int | None], texts: list[bytes]) -> None:
        """Documents that have a term, with all their postings."""
        tokens, slot, lengths = [], [], []
        for doc, text in zip(ids, texts, strict=True):
            own = terms(text) if len(text) <= PART_BYTES else None
            if own is None:
                counted: Counter = Counter()
                for part in _parts(text):
                    counted.update(terms(part))
                if counted:
                    self.found.append((self._codes([*counted]), np.full(len(counted), len(self.ids), np.int32), np.fromiter(counted.values(), np.int64, len(counted))))
                    self.n_postings += len(counted)
                    self.ids.append(doc)
                    self.lengths.append(sum(counted.values()))
            elif own:
                tokens += own
                slot.append(len(self.ids))
                lengths.append(len(own))
                self.ids.append(doc)
                self.lengths.append(len(own))
        if tokens:
            coded = pa.array(tokens, pa.large_binary()).dictionary_encode()
            key = np.repeat(np.array(slot, np.int64), lengths) * len(coded.dictionary) + coded.indices.to_numpy()
            key, tf = np.unique(key, return_counts=True)
            of = self._codes(coded.dictionary.to_pylist())
            self.found.append((of[key % len(coded.dictionary)], (key // len(coded.dictionary)).astype(np.int32), tf))
            self.n_postings += len(key)

    def _codes(self, names: list[bytes]) -> np.ndarray:
        known = self.names
        return np.fromiter((known.setdefault(w, len(known)) for w in names), np.int32, len(names))

    def rows(self, number: int, n_docs: int, n_all: int) -> Iterator[pa.RecordBatch]:
        """A row with the documents' ids, and one per term; slots ascend with the ids."""
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is None, self.ids[k] or 0))
        slot_of = np.empty(len(order), np.int64)
        slot_of[order] = np.arange(len(order))
        code, slot, tf = (np.concatenate([x[k] for x in self.found]) for k in range(3))
        self.found = []
        m = np.array([100 - 75 + (75 * n * n_docs) // n_all for n in self.lengths], dtype=np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[slot])
        key = code.astype(np.int64) * len(order) + slot_of[slot]
        by = np.argsort(key, kind="stable")
        key, impact = key[by], impact[by].astype(np.int32)
        begin = np.append(np.flatnonzero(np.diff(key // len(order), prepend=-1)), len(key))
        slots = (key % len(order)).astype(np.uint16)
        ids = [self.ids[k] for k in order]
        known = np.array([x is not None for x in ids])
        head = [np.array([x or 0 for x in ids], dtype="<i8").tobytes(), np.packbits(known, bitorder="little").tobytes()]
        yield pa.record_batch([pa.array([number]), pa.array([None], pa.string()), pa.array([len(ids)], pa.int64()), pa.array([head[0]], pa.binary()), pa.array([head[1]], pa.binary())], names=INDEX)
        names = pa.array([*self.names], pa.binary()).cast(pa.string())
        for a in range(0, len(begin) - 1, 100_000):
            own = begin[a : a + 100_001]
            part, at = slice(own[0], own[-1]), own - own[0]
            n = len(own) - 1
            columns = [pa.array(np.full(n, number)), names.slice(a, n), pa.array(np.diff(own)), runs(slots[part], at).cast(pa.binary()), slices(impact[part], at, BITS).cast(pa.binary())]
            yield pa.record_batch(columns, names=INDEX)


INDEX = ["block", "term", "n_docs", "slots", "bits"]


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, int]:
    """The index table (block, term, n_docs, slots, bits) in the shared folder, and N. A block's row without a term names its documents."""
    n_docs, n_all = statistics(docs, text_col)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, k, block = TaskContext.get().partitionId() << 32, 0, Block()
        for batch, texts in text_chunks(batches):
            ids = batch.column("doc_id").to_pylist()
            step = min(1024, block_docs)
            for a in range(0, len(ids), step):
                block.add(ids[a : a + step], texts[a : a + step])
                if len(block.ids) > block_docs - step or block.n_postings >= BLOCK_POSTINGS:
                    yield from block.rows(first + k, n_docs, n_all)
                    k, block = k + 1, Block()
        if block.ids:
            yield from block.rows(first + k, n_docs, n_all)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text <> ''")
    return stage(rows.mapInArrow(build, "block long, term string, n_docs long, slots binary, bits binary"), "impacts"), n_docs


# --- bitwise arithmetic on slices: arrays of (bits, words), least significant bit first -------------


def carry_save(total: np.ndarray, carry: np.ndarray, addend: np.ndarray, shift: int = 0) -> None:
    """Adds addend << shift to total + carry, in place; no carry runs further than one slice."""
    end = min(len(total), shift + len(addend))
    if shift == 0 and end == len(total):
        both = total ^ carry
        out = (total & carry) | (both & addend)
        np.bitwise_xor(both, addend, out=total)
    else:
        out = total & carry
        total ^= carry
        out[shift:end] |= total[shift:end] & addend[: end - shift]
        total[shift:end] ^= addend[: end - shift]
    carry[1:] = out[:-1]
    carry[0] = 0


def settle(total: np.ndarray, carry: np.ndarray) -> np.ndarray:
    """total + carry, by one ripple of carries."""
    out, c = total ^ carry, total & carry
    c[1:] = c[:-1].copy()
    c[0] = 0
    run = np.zeros_like(c[0])
    for j in range(len(out)):
        a, b = out[j].copy(), c[j]
        out[j] = a ^ b ^ run
        run = (a & b) | (run & (a ^ b))
    return out


def times(bits: np.ndarray, factor: int) -> np.ndarray:
    """The slices of factor * value."""
    total = np.zeros((len(bits) + max(factor, 1).bit_length(), bits.shape[1]), dtype=bits.dtype)
    carry = np.zeros_like(total)
    for s in range(factor.bit_length()):
        if factor >> s & 1:
            carry_save(total, carry, bits, s)
    return settle(total, carry)


def spread(bits: np.ndarray, slots: np.ndarray, n_words: int) -> np.ndarray:
    """Bitmaps over a term's slots as bitmaps over the block, in 64-bit words."""
    own = np.unpackbits(bits, axis=1, count=len(slots), bitorder="little")
    wide = np.zeros((len(bits), 64 * n_words), dtype=np.uint8)
    wide[:, slots] = own
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def top(bits: np.ndarray, k: int) -> np.ndarray:
    """Slots of the k largest values above 0, the lowest slots at a tie, by descending from the most significant slice."""
    some = np.bitwise_or.reduce(bits, axis=0)
    sure, maybe = np.zeros_like(some), some
    room = k
    for j in range(len(bits) - 1, -1, -1):
        if int(np.bitwise_count(maybe).sum()) <= room:
            break
        above = maybe & bits[j]
        n = int(np.bitwise_count(above).sum())
        if n > room:
            maybe = above
        else:
            sure, room = sure | above, room - n
            maybe = maybe & ~bits[j]
    at = lambda x: np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little"))
    return np.concatenate([at(sure), at(maybe)[:room]])


def read(bits: np.ndarray, slots: np.ndarray) -> list[int]:
    """Values at some slots."""
    words, place = slots // 64, (slots % 64).astype(np.uint64)
    out = [0] * len(slots)
    for j in range(len(bits)):
        for i, b in enumerate((bits[j][words] >> place & np.uint64(1)).tolist()):
            out[i] += b << j
    return out


# --- search -----------------------------------------------------------------------------------


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term, times) of the items' terms, repeats counted."""
    ready(items.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            rows = [(item, w, n) for item, t in zip(batch.column("item_id").to_pylist(), texts, strict=True) for w, n in Counter(terms(t)).items()]
            if rows:
                a, b, c = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.binary()).cast(pa.string()), pa.array(c, pa.int64())], names=["item_id", "term", "times"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text <> '' and item_id is not null").distinct()
    return rows.mapInArrow(cut, "item_id long, term string, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def _small(df: DataFrame, size: str) -> DataFrame:
    """Broadcast, if what it holds has been measured to be little."""
    return F.broadcast(df) if (df.agg(F.sum(F.expr(size))).first()[0] or 0) <= BROADCAST_BYTES else df


def search(table: DataFrame, n_docs: int, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", group_items: int = GROUP_ITEMS) -> DataFrame:
    """item_id, rank, doc_id, score of each item's k best documents in an index."""
    spark = items.sparkSession
    asked = stage(query_terms(items, id_col, text_col), "asked")
    groups = -(-asked.select("item_id").distinct().count() // group_items) or 1
    dealt = asked.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    # A list holds the items of one group only, so its length is bounded whatever the term.
    lists = stage(dealt.groupBy("term", "part").agg(F.collect_list(F.struct("item_id", "times")).alias("items")), "lists")
    names = asked.select("term").distinct()
    postings = table.where("term is not null")
    hits = stage(postings.join(_small(names, "length(term) + 40"), "term", "left_semi"), "hits")
    weight = F.floor(1000 * F.ln((2.0 * n_docs + 2) / (2.0 * F.sum("n_docs") + 1)))
    weighed = lists.join(hits.groupBy("term").agg(weight.cast("long").alias("weight")), "term")
    # The largest score that is possible sets the number of slices.
    largest = weighed.select(F.explode("items").alias("i"), "weight").groupBy("i.item_id").agg(F.sum(F.col("i.times") * F.col("weight")).alias("s")).agg(F.max("s")).first()[0]
    bits = ((largest or 0) << BITS).bit_length() + 1
    own = hits.join(_small(weighed, "length(term) + 16 * size(items) + 40"), "term").select("block", "part", "term", "slots", "bits", "weight", "items")
    heads = table.where("term is null").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select("block", F.col("part").cast("long").alias("part"), "term", "slots", "bits", F.lit(None).cast("long").alias("weight"), F.lit(None).cast(own.schema["items"].dataType).alias("items"))
    rows = heads.unionByName(own).repartition(parallelism(spark), "block", "part").sortWithinPartitions("block", "part", F.col("term").asc_nulls_first())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = known = None
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def best() -> Iterator[pa.RecordBatch]:
            out = []
            for item, (total, carry) in sums.items():
                final = settle(total, carry)
                slots = top(final, k)
                out += [(item, int(ids[s]) if known[s] else None, v) for s, v in zip(slots.tolist(), read(final, slots), strict=True)]
            sums.clear()
            if out:
                columns = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

        for batch in batches:
            slots, maps, lists = batch.column("slots"), batch.column("bits"), batch.column("items").to_pylist()
            for r, (term, weight) in enumerate(zip(batch.column("term").to_pylist(), batch.column("weight").to_pylist(), strict=True)):
                if term is None:
                    yield from best()
                    ids = np.frombuffer(slots[r].as_buffer(), dtype="<i8")
                    known = np.unpackbits(np.frombuffer(maps[r].as_buffer(), dtype=np.uint8), count=len(ids), bitorder="little")
                    n_words = -(-len(ids) // 64)
                    continue
                at = np.frombuffer(slots[r].as_buffer(), dtype=np.uint16)
                impact = spread(times(np.frombuffer(maps[r].as_buffer(), dtype=np.uint8).reshape(BITS, -1), weight), at, n_words)
                for i in lists[r]:
                    if i["item_id"] not in sums:
                        sums[i["item_id"]] = np.zeros((bits, n_words), "<u8"), np.zeros((bits, n_words), "<u8")
                    for s in range(i["times"].bit_length()):
                        if i["times"] >> s & 1:
                            carry_save(*sums[i["item_id"]], impact, s)
        yield from best()

    found = rows.drop("part").mapInArrow(find, "item_id long, doc_id long, score long") if n_docs else spark.createDataFrame([], "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, block_docs: int = BLOCK_DOCS, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Indexes the documents and searches for all items."""
    table, n_docs = index(docs, block_docs=block_docs)
    return search(table, n_docs, items, k, group_items=group_items)
