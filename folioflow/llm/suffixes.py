"""Exact substring dedup: maximal repeats from the interval tree of an enhanced suffix array.

The suffix array is sparse. Every string of `span` bytes contains an anchor, a k-gram that
the string's own content picks (the least hash of its k-grams), so equal strings pick the
same anchor at the same place, and a repeat of `span` bytes shows at suffixes that start at
equal anchors. Those suffixes are brought together by the anchor's hash, sorted by what
follows the anchor, and scanned with a stack over their common-prefix lengths. Each
interval of that tree is a group of occurrences with a common right extension; its
members are told apart by what precedes them (left-extension diversity), which gives the
maximal repeats in the interval and for each occurrence how far it repeats on both sides.
No more than span - k bytes on either side are needed: longer repeats hold more anchors.

Texts that are equal as a whole are represented by one of them. An anchor that a task has met before
is known to repeat, so only its first occurrence in each task goes to the place where anchors are
compared. Of anchors that occur more than FREQUENT times only the distinct contexts are brought
together, and where even those are more than HOT, the strings of `span` bytes in them are counted by
aggregation instead, so no task holds an unbounded group. All three ways give the same spans.

Results for odd input: null and empty texts have no bytes and nothing removed; texts shorter than
`span` keep all; repeated rows are copies of each other; a null id is kept in the
result and its text takes part; rows of one id may have different texts, each is judged for
itself (a row is known by its id and its text's hash); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, parallelism, ready, release, stage, text_chunks, whole_groups, with_ids

SPAN, GRAM = 200, 64
#: Occurrences from which on an anchor's equal contexts are merged first, and distinct contexts of one
#: anchor that a task may hold.
FREQUENT, HOT = 1_000, 100_000
#: Contexts that a task remembers having sent, and anchors that it remembers having met twice; what it
#: forgets costs a row more, nothing else.
SENT, MET = 100_000, 1_000_000
SLICE = 1_000_000
_FACTOR = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.PCG64(71).random_raw(256)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_PLACE_BITS = np.uint64(22)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, f in enumerate((_FACTOR, pow(_FACTOR, -1, 1 << 64))):
            _POWERS[k] = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, f, np.uint64))))
    return _POWERS[0], _POWERS[1]


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes at each place."""
    up, down = _powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)])))
    n = len(data) - k + 1
    return mix((sums[k:] - sums[:n]) * down[:n])


def anchors(texts: list[bytes], span: int = SPAN, k: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash) of each text's anchors: the leftmost least k-gram of every string of `span` bytes."""
    parts = [(i, a, t[a : a + SLICE + span - 1]) for i, t in enumerate(texts) if len(t) >= span for a in range(0, max(1, len(t) - span + 1), SLICE)]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for part in [*parts, None]:
        if held and (part is None or size + len(part[2]) > 2 * SLICE):
            out.append(_anchors(held, span, k))
            held, size = [], 0
        if part is not None:
            held.append(part)
            size += len(part[2])
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    number, place, h = (np.concatenate(x) for x in zip(*out, strict=True))
    if any(len(t) > SLICE for t in texts):
        _, keep = np.unique(np.stack([number, place]), axis=1, return_index=True)
        number, place, h = number[keep], place[keep], h[keep]
    return number, place, h


def _anchors(parts: list[tuple[int, int, bytes]], span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(p[2] for p in parts), dtype=np.uint8)
    h = gram_hashes(data, k)
    ends = np.cumsum([len(p[2]) for p in parts])
    w, low = span - k + 1, (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    n = len(key) - w + 1
    padded = np.full(-(-len(key) // w) * w, np.uint64(2**64 - 1))
    padded[: len(key)] = key
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[:n], left[w - 1 : w - 1 + n])
    for e in ends[:-1].tolist():
        least[max(0, e - span + 1) : e] = np.uint64(2**64 - 1)  # a string of two texts
    least = least[np.concatenate(([True], least[1:] != least[:-1]))]
    at = np.unique((least[least != np.uint64(2**64 - 1)] & low).astype(np.int64))
    part = np.searchsorted(ends, at, side="right")
    begin = np.concatenate(([0], ends[:-1]))
    number = np.array([p[0] for p in parts])[part]
    return number, at - begin[part] + np.array([p[1] for p in parts])[part], h[at]


# --- the enhanced suffix array ------------------------------------------------------------------


def lcp_intervals(lcp: list[int]) -> list[tuple[int, int, int]]:
    """(depth, first, last) of the intervals of a suffix array; lcp[i] is that of entries i and i + 1."""
    out, stack = [], [(0, 0)]
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            if i > first:
                out.append((d, first, i))
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return out


def maximal_repeats(text: bytes, least: int) -> list[tuple[int, list[int]]]:
    """(length, all places) of the maximal repeats of a text of moderate size: the intervals whose
    members differ in the byte before them."""
    order = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [_common(text[a:], text[b:]) for a, b in zip(order, order[1:], strict=False)]
    found = []
    for depth, a, b in lcp_intervals(lcp):
        places = order[a : b + 1]
        before = {text[p - 1 : p] if p else None for p in places}
        if depth >= least and (len(before) > 1 or None in before):
            found.append((depth, sorted(places)))
    return sorted(found)


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


def _matrix(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes padded with zeros, and their lengths."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw = column.to_pylist()
    size = np.array([len(x) for x in raw])
    out = np.zeros((len(raw), width), dtype=np.uint8)
    out[np.arange(width) < size[:, None]] = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return out, size


def _shared(a: np.ndarray, b: np.ndarray, cap: np.ndarray) -> np.ndarray:
    """Common prefix lengths of the rows of two matrices, at most cap."""
    differ = a != b
    first = differ.argmax(1)
    return np.minimum(np.where(differ.any(1), first, a.shape[1]), cap)


def _text_key(*columns: np.ndarray) -> np.ndarray:
    joined = np.ascontiguousarray(np.concatenate(columns, axis=1))
    return joined.view(f"S{joined.shape[1]}").ravel()


def _two_bytes(n: np.ndarray) -> np.ndarray:
    return n.astype(">u2").view(np.uint8).reshape(-1, 2)


def reach(anchor: np.ndarray, before: tuple[np.ndarray, np.ndarray], after: tuple[np.ndarray, np.ndarray], need: int, copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and after its anchor each occurrence shares with others, in repeats
    with before + after >= need; -1 where there are none. before: reversed, so both read outward.
    copies: how many occurrences a row stands for."""
    (left, left_n), (right, right_n) = before, after
    n = len(anchor)
    key = _text_key(anchor.astype(">u8").view(np.uint8).reshape(n, 8), right, _two_bytes(right_n), left, _two_bytes(left_n))
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
    of = np.empty(n, dtype=np.int64)
    of[order] = np.cumsum(fresh) - 1
    u = order[fresh]
    times = np.bincount(of, copies)
    a, left, left_n, right, right_n = anchor[u], left[u], left_n[u], right[u], right_n[u]
    out_l, out_r = np.full(len(u), -1), np.full(len(u), -1)
    same = (times > 1) & (left_n + right_n >= need)
    out_l[same], out_r[same] = left_n[same], right_n[same]
    lcp = _shared(right[1:], right[:-1], np.minimum(right_n[1:], right_n[:-1])) if len(u) > 1 else np.empty(0, np.int64)
    lead = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    size = np.diff(np.append(lead, len(u)))
    two = lead[size == 2]
    if len(two):
        l = _shared(left[two], left[two + 1], np.minimum(left_n[two], left_n[two + 1]))
        r = lcp[two]
        good = l + r >= need
        for k in (two[good], two[good] + 1):
            out_l[k], out_r[k] = np.maximum(out_l[k], l[good]), np.maximum(out_r[k], r[good])
    for first, m in zip(lead[size > 2].tolist(), size[size > 2].tolist(), strict=True):
        if same[first : first + m].all():
            continue
        own, own_n = left[first : first + m], left_n[first : first + m]
        for depth, lo, hi in lcp_intervals(lcp[first : first + m - 1].tolist()):
            rows = own[lo : hi + 1]
            # the length decides between a context that ends and one that goes on with zero bytes
            sort = np.argsort(_text_key(rows, _two_bytes(own_n[lo : hi + 1])), kind="stable")
            rows, rows_n = rows[sort], own_n[lo : hi + 1][sort]
            with_next = _shared(rows[1:], rows[:-1], np.minimum(rows_n[1:], rows_n[:-1]))
            best = np.zeros(len(rows), dtype=np.int64)
            best[:-1] = with_next
            best[1:] = np.maximum(best[1:], with_next)
            good = best + depth >= need
            at = first + lo + sort[good]
            out_l[at], out_r[at] = np.maximum(out_l[at], best[good]), np.maximum(out_r[at], depth)
    return out_l[of], out_r[of]


# --- over a table -------------------------------------------------------------------------------


def repeated_spans(texts: DataFrame, span: int = SPAN, k: int = GRAM, frequent: int = FREQUENT, hot: int = HOT) -> DataFrame:
    """uid, sub, start, stop: bytes of each text (uid, sub, text) that lie in strings of `span` bytes starting
    at two places or more; spans overlap. uid and sub together name a text."""
    spark, width = texts.sparkSession, span - k
    fields = "anchor long, uid long, sub long, place int"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors with state: 0 met once, 1 the first of several, 2 a further one; deal: where a row is sent."""
        met = np.empty(0, np.uint64)
        for batch, raw in text_chunks(batches):
            ids, subs = batch.column("uid").to_numpy(), batch.column("sub").to_numpy()
            number, place, h = anchors(raw, span, k)
            known = np.isin(h, met)
            _, first, of, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            state = np.where(times[of] > 1, 2, 0)
            state[first[times > 1]] = 1
            state[known] = 2
            met = np.union1d(met, h[state == 1])
            if len(met) > MET:
                met = np.empty(0, np.uint64)
            deal = np.where(state == 2, mix(h + mix(ids[number].view(np.uint64)) + place.astype(np.uint64)), h)
            yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(ids[number], pa.int64()), pa.array(subs[number], pa.int64()), pa.array(place, pa.int32()), pa.array(deal.view(np.int64)), pa.array(state, pa.int8())], names=["anchor", "uid", "sub", "place", "deal", "state"])

    dealt = texts.mapInArrow(find, f"{fields}, deal long, state byte").repartition(parallelism(spark), "deal").sortWithinPartitions("deal")

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of anchors that repeat: met again in their own task, or next to a row of another."""
        last: pa.RecordBatch | None = None
        like_before = False
        for batch in batches:
            state = batch.column("state").to_numpy()
            own = [0, 1, 2, 3]
            yield batch.filter(pa.array(state == 2)).select(own)
            batch = batch.filter(pa.array(state < 2))
            if not batch.num_rows:
                continue
            key, sure = batch.column("anchor").to_numpy(), batch.column("state").to_numpy() == 1
            same = key[1:] == key[:-1]
            first = last is not None and last.column("anchor")[0].as_py() == key[0]
            if last is not None and (like_before or first):
                yield last.select(own)
            back = np.concatenate(([first], same)) | sure
            keep = back[:-1] | same
            yield batch.slice(0, batch.num_rows - 1).filter(pa.array(keep)).select(own)
            last, like_before = batch.slice(batch.num_rows - 1), bool(back[-1])
        if last is not None and like_before:
            yield last.select(own)

    shared = stage(dealt.mapInArrow(several, fields), "anchors")
    release(spark)

    def contexts(found: DataFrame) -> DataFrame:
        """anchor, uid, sub, place, before, after of the anchors found; a text goes with its own ones."""
        by_text = found.groupBy("uid", "sub").agg(F.collect_list(F.struct("place", "anchor")).alias("found"))

        def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, raw in text_chunks(batches):
                ids, subs = batch.column("uid").to_pylist(), batch.column("sub").to_pylist()
                rows: list[list] = [[], [], [], [], [], []]
                for i, (uid, sub, t) in enumerate(zip(ids, subs, raw, strict=True)):
                    own = batch.column("found")[i].values
                    back = t[::-1]
                    for p, a in zip(own.field("place").to_pylist(), own.field("anchor").to_pylist(), strict=True):
                        begin = len(t) - p
                        for column, x in zip(rows, (a, uid, sub, p, back[begin : begin + width], t[p + k : p + k + width]), strict=True):
                            column.append(x)
                        if len(rows[0]) >= 10_000:
                            yield _context_batch(rows)
                            rows = [[], [], [], [], [], []]
                if rows[0]:
                    yield _context_batch(rows)

        return by_text.join(texts, ["uid", "sub"]).mapInArrow(around, f"{fields}, before binary, after binary")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["anchor"]):
            l, r = reach(table.column("anchor").to_numpy().view(np.uint64), _matrix(table.column("before"), width), _matrix(table.column("after"), width), width)
            hit = np.flatnonzero(l >= 0)
            place = table.column("place").to_numpy()[hit].astype(np.int64)
            ids, subs = (table.column(c).to_numpy()[hit] for c in ("uid", "sub"))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(subs, pa.int64()), pa.array(place - l[hit], pa.int64()), pa.array(place + k + r[hit], pa.int64())], names=["uid", "sub", "start", "stop"])

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition(parallelism(spark), "anchor").sortWithinPartitions("anchor")

    often = stage(shared.groupBy("anchor").count().where(F.col("count") > frequent).select("anchor"), "frequent")
    spans = together(contexts(with_ids(shared, often, "anchor", "left_anti"))).mapInArrow(scan, "uid long, sub long, start long, stop long")
    if often.limit(1).count():
        spans = stage(spans, "spans")
        release(spark)
        spans = spans.unionByName(_frequent_spans(contexts(with_ids(shared, often, "anchor", "left_semi")), span, k, hot, together))
    return stage(spans, "spans")


def _context_batch(rows: list[list]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, y) for x, y in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["anchor", "uid", "sub", "place", "before", "after"])


def _frequent_spans(around: DataFrame, span: int, k: int, hot: int, together) -> DataFrame:
    """uid, sub, start, stop like repeated_spans, by way of the distinct contexts."""
    width = span - k

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts by name; a task sends the bytes of an anchor's context that it remembers only once."""
        sent: set[tuple[int, bytes]] = set()
        for batch in batches:
            before, after = batch.column("before").to_pylist(), batch.column("after").to_pylist()
            names, b, f = [], [], []
            for anchor, x, y in zip(batch.column("anchor").to_pylist(), before, after, strict=True):
                name = hashlib.blake2b(len(x).to_bytes(2, "little") + x + y, digest_size=16).digest()
                new = (anchor, name) not in sent  # contexts of different anchors may be equal
                if new:
                    if len(sent) >= SENT:
                        sent.clear()
                    sent.add((anchor, name))
                names.append(name)
                b.append(x if new else None)
                f.append(y if new else None)
            yield pa.record_batch([*batch.columns[:4], pa.array(names, pa.binary()), pa.array(b, pa.binary()), pa.array(f, pa.binary())], names=["anchor", "uid", "sub", "place", "name", "before", "after"])

    placed = stage(around.mapInArrow(named, "anchor long, uid long, sub long, place int, name binary, before binary, after binary"), "placed")
    distinct = stage(placed.groupBy("anchor", "name").agg(F.count("*").alias("n"), F.max("before").alias("before"), F.max("after").alias("after")), "contexts")
    crowded = stage(distinct.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"), "crowded")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["anchor"]):
            l, r = reach(table.column("anchor").to_numpy().view(np.uint64), _matrix(table.column("before"), width), _matrix(table.column("after"), width), width, table.column("n").to_numpy())
            hit = np.flatnonzero(l >= 0)
            kept = table.select(["anchor", "name"]).take(pa.array(hit)).combine_chunks()
            yield from (pa.record_batch([x.column(0), x.column(1), pa.array(-l[hit][o : o + x.num_rows], pa.int64()), pa.array(k + r[hit][o : o + x.num_rows], pa.int64())], names=["anchor", "name", "start", "stop"]) for o, x in _numbered(kept))

    fields = "anchor long, name binary, start long, stop long"
    result = together(with_ids(distinct, crowded, "anchor", "left_anti")).mapInArrow(scan, fields)
    if crowded.limit(1).count():

        def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Every string of `span` bytes around the anchor by hash, with its start from the anchor."""
            for batch in batches:
                for o in range(0, batch.num_rows, 500):
                    rows: list[list] = [[], [], [], [], []]
                    part = batch.slice(o, min(500, batch.num_rows - o))
                    for anchor, name, n, b, f in zip(*(part.column(c).to_pylist() for c in ("anchor", "name", "n", "before", "after")), strict=True):
                        whole = b[::-1] + f
                        for first in range(max(0, len(b) - width), min(len(b), len(whole) - width) + 1):
                            string = hashlib.blake2b(anchor.to_bytes(8, "little", signed=True) + (len(b) - first).to_bytes(2, "little") + whole[first : first + width], digest_size=16).digest()
                            for column, x in zip(rows, (anchor, name, n, first - len(b), string), strict=True):
                                column.append(x)
                    yield pa.record_batch([pa.array(x, y) for x, y in zip(rows, (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["anchor", "name", "n", "start", "string"])

        every = stage(with_ids(distinct, crowded, "anchor", "left_semi").mapInArrow(strings, "anchor long, name binary, n long, start long, string binary"), "strings")
        again = every.groupBy("string").agg(F.sum("n").alias("n")).where("n > 1").select("string")
        found = every.join(again, "string", "left_semi").groupBy("anchor", "name").agg(F.min("start").alias("start"), (F.max("start") + span).alias("stop"))
        result = result.unionByName(found)
    out = placed.select("anchor", "name", "uid", "sub", "place").join(stage(result, "reached"), ["anchor", "name"])
    return out.select("uid", "sub", (F.col("place") + F.col("start")).alias("start"), (F.col("place") + F.col("stop")).alias("stop"))


def _numbered(table: pa.Table) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches of a table with the row that each begins at."""
    at = 0
    for batch in table.to_batches():
        yield at, batch
        at += batch.num_rows


_FIELDS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs and the rest of a text."""
    kept, done, runs, removed = [], 0, 0, 0
    for a, b in spans:
        if b <= done:
            continue
        if a > done or not runs:
            kept.append(text[done:a])
            runs += 1
        removed += b - max(a, done)
        done = b
    kept.append(text[done:])
    return removed, runs, b"".join(kept)


def remove_repeats(docs: DataFrame, span: int = SPAN, k: int = GRAM, frequent: int = FREQUENT, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per input row."""
    ready(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.col(id_col).cast("long")
    rows = docs.select(doc.alias("doc_id"), F.coalesce(doc, F.xxhash64(F.lit(1), text)).alias("uid"), F.xxhash64(text).alias("sub"), text.alias("text"))
    named = stage(rows.select("doc_id", "uid", "sub", F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("key"), F.sha2("text", 256).alias("sha")), "texts")
    long = named.where(F.col("n_bytes") >= span)
    classes = long.groupBy("key").agg(F.min("uid").alias("lead"), F.count("*").alias("n"))
    copied = stage(classes.where("n > 1"), "copied")
    followers = stage(long.join(copied, "key").where("uid <> lead").select("uid", "sub").distinct(), "followers")
    some = with_ids(rows.where(F.octet_length("text") >= span).select("uid", "sub", "text"), followers, ["uid", "sub"], "left_anti")
    twins = stage(long.groupBy("uid", "sub").count().where("count > 1").select("uid", "sub"), "twins")
    if twins.limit(1).count():  # rows of one id and text
        once = with_ids(some, twins, ["uid", "sub"], "left_semi").dropDuplicates(["uid", "sub"])
        some = with_ids(some, twins, ["uid", "sub"], "left_anti").unionByName(once)
    spans = repeated_spans(some, span, k, frequent, hot)
    release(docs.sparkSession)

    whole = named.join(copied.select("key"), "key", "left_semi")
    empty = hashlib.sha256(b"").hexdigest()
    gone = whole.select("doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(empty).alias("kept_sha256"))
    rest = named.join(copied.select("key"), "key", "left_anti")
    per = stage(spans.join(rest.select("uid", "sub"), ["uid", "sub"], "left_semi").groupBy("uid", "sub").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans")), "covered")
    clean = rest.join(per.select("uid", "sub"), ["uid", "sub"], "left_anti").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_chunks(batches):
            out = []
            for i, (doc, t) in enumerate(zip(batch.column("doc_id").to_pylist(), raw, strict=True)):
                own = batch.column("spans")[i].values
                removed, runs, kept = _cut(t, list(zip(own.field("start").to_pylist(), own.field("stop").to_pylist(), strict=True)))
                out.append((doc, len(t), removed, runs, hashlib.sha256(kept).hexdigest()))
            yield pa.record_batch([pa.array(x, y) for x, y in zip(zip(*out, strict=True), (pa.int64(),) * 4 + (pa.string(),), strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    touched = with_ids(rows, per.select("uid", "sub"), ["uid", "sub"], "left_semi").join(per, ["uid", "sub"]).mapInArrow(cut, _FIELDS)
    return gone.unionByName(clean).unionByName(touched)
