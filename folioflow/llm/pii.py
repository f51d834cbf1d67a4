"""Personal data: fixed shapes, and identifiers that bootstrapped contexts point to.

The base spans come from four shapes with checks (e-mail, IP address, card, phone). They
are the seed entities: the words around them give lexical patterns. Every token
that looks like an identifier (it holds a digit or an @ and at least five characters) is an instance
of the patterns around it. Spark scores the graph of patterns and instances in rounds: a
pattern is as good as the share of its occurrences whose instances are trusted, an instance as
good as its patterns together. Patterns of two words back off to single words, left or right; as
common words stand before everything, those have to be surer: the lower bound of the share of trusted
instances counts, and its odds have to exceed those among all instances several times. Instances of
patterns that end with a high score become spans of the kind `id`, unless they overlap a span that is there already.

Results for odd input: null and empty texts have no spans; rows with a null id are scanned like
others; discovered places belong to a text, not to an id, so rows of one id with different texts don't
mix and equal texts get the same spans; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, stage, text_chunks, with_ids

KINDS = ("email", "ip", "card", "phone", "id")
#: Rounds end when the trusted instances no longer change; ROUNDS at most. Single words need trusted instances at a
#: lower bound (of Z standard errors) whose odds are LIFT times those of all instances.
ROUNDS, TRUST, LEAST_SEEDS, LIFT, Z = 10, 0.6, 3, 3.0, 1.645

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9@]")
_NUMBER = re.compile(r"[0-9]+")
_WORD = re.compile(r"\w+")
_EDGE = ".,;:!?()[]{}<>\"'|&%$#*"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, found from the @ signs so that long words cost no more than their length."""
    done = 0
    at = text.find("@")
    while at >= 0:
        if at >= done and (m := _DOMAIN.match(text, at + 1)):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = m.end()
                yield start, done
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the four shapes, in that order."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x) <= 3 and int(x or "0") <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if 12 <= m.end() - m.start() and 12 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _hash(x: str) -> int:
    return int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little", signed=True)


def _plain(word: str) -> str:
    return _NUMBER.sub("0", word.lower())


def _before(text: str, at: int) -> list[str]:
    """The last two whole words that end before a place; a word is a run of letters, digits and underscores."""
    out: list[str] = []
    for _ in range(2):
        while at > 0 and not _in_word(text[at - 1]):
            at -= 1
        end = at
        while at > 0 and _in_word(text[at - 1]):
            at -= 1
        if at < end:
            out.insert(0, _plain(text[at:end]))
    return out


def _after(text: str, at: int) -> list[str]:
    """The first whole word that begins after a place."""
    return [_plain(m[0])] if (m := _WORD.search(text, at)) else []


def _in_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a place: two words before it; one before and one after; the single word before or after."""
    left, right = _before(text, start), _after(text, end)
    out = []
    if len(left) == 2:
        out.append(f"{left[0]} {left[1]} _")
    if left and right:
        out.append(f"{left[-1]} _ {right[0]}")
    if left:
        out.append(f"{left[-1]} _")
    if right:
        out.append(f"_ {right[0]}")
    return out


def _named(pattern: str) -> int:
    """Hash of a pattern; those of a single word are odd."""
    return _hash(pattern) | 1 if pattern.count(" ") == 1 else _hash(pattern) & ~1


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, whether it is a seed) of the seeds and of tokens that look like identifiers."""
    out = [(a, b, True) for a, _, b in base]
    if not _DIGIT.search(text):
        return out
    taken = sorted((a, b) for a, _, b in base)
    k = 0
    for a, b in _token_spans(text):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k < len(taken) and taken[k][0] < b:
            continue
        out.append((a, b, False))
    return out


def _token_spans(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DIGIT.finditer(text):
        if m.start() < done:
            continue
        a, b = m.start(), m.end()
        while a > done and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        done = b
        token = text[a:b]
        a, b = a + len(token) - len(token.lstrip(_EDGE)), b - (len(token) - len(token.rstrip(_EDGE)))
        if b - a >= 5:
            yield a, b


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def _key(text_col: str):
    """16 bytes that name a text."""
    return F.unhex(F.md5(F.col(text_col)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (names the text), base (array of start, kind, end), found (array of start, stop, seed, instance, patterns)."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())])
        place = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("seed", pa.bool_()), ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])
        for batch, texts in text_chunks(batches):
            bases, founds = [], []
            for t in texts:
                text = t.decode()
                base = base_spans(text)
                bases.append([{"start": a, "kind": k, "stop": b} for a, k, b in base])
                founds.append([{"start": a, "stop": b, "seed": s, "instance": _hash(text[a:b]), "patterns": [_named(p) for p in patterns(text, a, b)]} for a, b, s in candidates(text, base)])
            yield pa.record_batch([batch.column("doc_id"), batch.column("key"), pa.array(bases, pa.list_(span)), pa.array(founds, pa.list_(place))], names=["doc_id", "key", "base", "found"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(text_col).alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(walk, "doc_id long, key binary, base array<struct<start:int,kind:int,stop:int>>, found array<struct<start:int,stop:int,seed:boolean,instance:long,patterns:array<long>>>")


def graph(scanned: DataFrame) -> DataFrame:
    """pattern, instance, n (their common places), seed: the edges of the graph."""
    places = scanned.select(F.explode("found").alias("f")).select("f.*")
    return places.select(F.explode("patterns").alias("pattern"), "instance", "seed").groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed"))


def good_patterns(edges: DataFrame, trusted: DataFrame, base: float, trust: float = TRUST, least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """pattern, p: patterns that enough trusted instances (instance, score) support. base: share of seeds among all instances."""
    score = F.coalesce("score", F.lit(0.0))
    known = edges.join(trusted, "instance", "left")
    of = known.groupBy("pattern").agg((F.sum(F.col("n") * score) / F.sum("n")).alias("p"), F.count_if(score >= trust).alias("support"), F.count("*").alias("m"), F.sum(score).alias("k"))
    share, m = F.col("k") / F.col("m"), F.col("m")
    lower = (share + Z * Z / (2 * m) - Z * F.sqrt(F.greatest(share * (1 - share), F.lit(0.0)) / m + Z * Z / (4 * m * m))) / (1 + Z * Z / m)
    odds = LIFT * base / (1 - base) if base < 1 else float("inf")
    sure = (lower >= trust) & (lower >= odds * (1 - lower))
    single = F.col("pattern").bitwiseAND(F.lit(1)) == 1
    return of.where((F.col("support") >= least_seeds) & (F.col("p") >= trust) & (~single | sure)).select("pattern", "p")


def discover(scanned: DataFrame, rounds: int = ROUNDS, trust: float = TRUST, least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """key, extra (sorted array of start, stop): places in a text that trusted patterns point to."""
    edges = stage(graph(scanned), "patterns")
    seeds = edges.where("seed").groupBy("instance").agg(F.lit(1.0).alias("score"))
    every, own = edges.groupBy("instance").agg(F.max("seed").alias("seed")).agg(F.count("*"), F.count_if("seed")).first()
    base = own / every if every else 0.0
    trusted, before = stage(seeds, "trusted"), None
    for _ in range(rounds):
        good = good_patterns(edges, trusted, base, trust, least_seeds)
        doubt = F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-9))))
        pulled = edges.where("not seed").join(good, "pattern").groupBy("instance").agg((1 - F.exp(doubt)).alias("score"))
        trusted = stage(seeds.union(pulled).groupBy("instance").agg(F.max("score").alias("score")), "trusted")
        now = tuple(trusted.agg(F.count("*"), F.bit_xor(F.xxhash64("instance", F.round("score", 9)))).first())
        if now == before:
            break
        before = now
    fine = trusted.where(F.col("score") >= trust).select("instance")
    places = scanned.select("key", F.explode("found").alias("f")).select("key", "f.*")
    spread = places.where("not seed").select("key", "start", "stop", "instance", F.explode("patterns").alias("pattern"))
    pointed = with_ids(spread, stage(good.select("pattern"), "good"), "pattern", "left_semi")
    return with_ids(pointed, fine, "instance", "left_semi").groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("extra"))


def hidden_recall(docs: DataFrame, part: int = 5, id_col: str = "doc_id", text_col: str = "text") -> dict[str, int]:
    """Hides every `part`-th seed entity (by a hash) from the discovery and counts what the patterns find of them.

    hidden: places of hidden seeds; again: those that were found; others: places that were found beside them, which
    hold no seed. Places are counted once per different text.
    """
    ready(docs.sparkSession)
    own = "named_struct('start', x.start, 'stop', x.stop, 'seed', x.seed and not {h}, 'instance', x.instance, 'patterns', x.patterns)".format(h=(h := f"pmod(xxhash64(x.instance), {part}) = 0"))
    scanned = stage(scan(docs, id_col, text_col).dropDuplicates(["key"]), "scanned")
    places = scanned.select("key", F.explode("found").alias("x")).select("key", "x.start", "x.stop", F.expr(f"x.seed and {h}").alias("hidden"))
    found = discover(scanned.withColumn("found", F.expr(f"transform(found, x -> {own})"))).select("key", F.explode("extra").alias("e")).select("key", "e.start", "e.stop", F.lit(True).alias("found"))
    r = places.join(found, ["key", "start", "stop"], "left").agg(F.count_if("hidden"), F.count_if(F.col("hidden") & F.col("found")), F.count_if(~F.col("hidden") & F.col("found"))).first()
    return dict(zip(("hidden", "again", "others"), r, strict=True))


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, extra: base spans and discovered places of every document."""
    ready(docs.sparkSession)
    scanned = stage(scan(docs, id_col, text_col), "scanned")
    extra = stage(discover(scanned), "extra")
    return scanned.select("doc_id", "key", "base").join(extra, "key", "left").select("doc_id", "base", "extra")


def digests(extracted: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, base_sha256 and spans, from extract()'s rows."""
    def text(spans: str):
        return F.concat_ws(",", F.expr(f"transform({spans}, x -> concat(element_at(array({', '.join(repr(k) for k in KINDS)}), x.kind + 1), ':', x.start, ':', x.stop))"))

    more = F.expr("transform(coalesce(extra, array()), x -> named_struct('start', x.start, 'kind', 4, 'stop', x.stop))")
    rows = extracted.withColumn("every", F.array_sort(F.concat("base", more)))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {k})) as long)").alias(f"n_{KINDS[k]}") for k in range(4)]
    return rows.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("every").alias("spans"), F.size(F.coalesce("extra", F.array())).cast("long").alias("n_id"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """The documents' own columns with every span's text replaced by its kind in brackets.

    Only rows with discovered places are joined with them; the others find their base spans on the way.
    """
    ready(docs.sparkSession)
    scanned = stage(scan(docs, id_col, text_col), "scanned")
    extra = stage(discover(scanned), "extra")
    names, schema = docs.columns, docs.schema
    clash = "pii_extra"
    while clash in names:
        clash += "_"

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, text_col):
            places = batch.column(len(names)).to_pylist()
            nulls = batch.column(text_col).is_null().to_pylist()
            new, size = [], []
            for t, more, null in zip(texts, places, nulls, strict=True):
                text = t.decode()
                spans = sorted([(a, k, b) for a, k, b in base_spans(text)] + [(x["start"], 4, x["stop"]) for x in more or ()])
                out, done = [], 0
                for a, k, b in spans:
                    if b <= done:
                        continue
                    out.append(text[done : max(a, done)])
                    out.append(f"[{KINDS[k].upper()}]" if a >= done else "")
                    done = b
                out.append(text[done:])
                new.append(None if null else "".join(out))
                size.append(None if null else len(new[-1]))
            columns = {n: batch.column(k) for k, n in enumerate(names)}
            columns[text_col] = pa.array(new, pa.string())
            if count_col in columns:
                columns[count_col] = pa.array(size, columns[count_col].type)
            yield pa.record_batch(list(columns.values()), names=names)

    nothing = F.lit(None).cast("array<struct<start:int,stop:int>>")
    name = clash + "_key"
    while name in names:
        name += "_"
    keyed, places = docs.withColumn(name, _key(text_col)), extra.select(F.col("key").alias(name), F.col("extra").alias(clash))
    rest = with_ids(keyed, places.select(name), name, "left_anti").withColumn(clash, nothing).select(*names, clash)
    hit = with_ids(keyed, places.select(name), name, "left_semi").join(places, name).select(*names, clash)
    return rest.mapInArrow(cover, schema).unionByName(hit.mapInArrow(cover, schema))
