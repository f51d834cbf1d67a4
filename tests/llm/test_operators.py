"""The ten operators against brute force on small tables, odd rows included."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import common, importance, langid, lattice, minhash, mixing, packing, pii, queries, spotsigs, suffixes, toxicity, verify

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, uid string, key string, kept string, spans string"


def rng(seed=0):
    return random.Random(seed)


def prose(r, n, words=400):
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def edit(r, text, share):
    return " ".join(f"x{r.randrange(9999)}" if r.random() < share else w for w in text.split(" "))


def corpus(seed=0):
    """Copies, near copies, shared passages, long and short texts, nulls and repeated rows."""
    r = rng(seed)
    base = [prose(r, 120) for _ in range(6)]
    texts = [*base, *[edit(r, b, s) for b in base[:4] for s in (0.01, 0.03, 0.05)], base[0], base[0], None, "", " \n", "eins", "eins", "eins zwei", prose(r, 4000)]
    passage = prose(r, 60)
    texts += [f"{prose(r, 40)} {passage} {prose(r, 30)}" for _ in range(4)] + ["ab" * 400, "é" * 150 + passage, "<|endoftext|> It's 12.5 x²!"]
    rows = [(i, t, "en", "s", len(t or ""), i, "u", "k", "x", "y") for i, t in enumerate(texts)]
    return [*rows, rows[2], (None, base[1], None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def classes(ids, linked):
    forest = common.Forest(len(ids))
    for i, j in itertools.combinations(range(len(ids)), 2):
        if linked(i, j):
            forest.join(i, j)
    return [ids[forest.find(i)] for i in range(len(ids))]


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return set(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else ({tuple(w)} if w else set())


# --- shared pieces ---


def test_components(spark):
    r = rng(3)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    got = {x["node"]: x["component"] for x in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = sorted({x for e in edges if e[0] != e[1] for x in e})
    pairs = {frozenset(e) for e in edges}
    assert got == dict(zip(ids, classes(ids, lambda i, j: frozenset((ids[i], ids[j])) in pairs), strict=True))


def test_word_hashes_and_chunks():
    texts = [b"Ab  cD\x0bAB", b"", b" x "]
    h, begin = common.word_hashes(texts)
    assert begin.tolist() == [0, 3, 3, 4] and h[0] == h[2] != h[1]
    assert list(common.chunks([5, 5, 5], 10)) == [(0, 2), (2, 3)] and list(common.chunks([0, 0])) == [(0, 2)] and list(common.chunks([99], 10)) == [(0, 1)]


def test_very_long_texts(spark):
    """Every text operator takes a text of some megabytes beside short ones; a hot id and a text that fills a slice included."""
    r = rng(41)
    long = " ".join(f"w{r.randrange(50_000)}" for _ in range(350_000))
    rows = [(1, long), (2, long[: len(long) // 2] + " changed"), (3, "short text of the others"), (4, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "toxic": (F.col("doc_id") % 2).cast("int")})
    assert len(long) > 2 * suffixes.SLICE
    assert importance.resample(df, df.where("doc_id = 3").select("doc_id")).count() == 4
    assert {x["n_email"] for x in pii.digests(pii.extract(df)).collect()} == {0}
    cut = {x["doc_id"]: x for x in suffixes.remove_repeats(df).collect()}
    assert cut[1]["n_removed"] == cut[4]["n_removed"] == len(long) and 0 < cut[2]["n_removed"] >= len(long) // 2 and cut[3]["n_removed"] == 0
    assert mixing.rated(df, mixing.mix(df, mixing.fit(df, "lang"), None)).count() == 4
    pieces = packing.pack(df.where("doc_id <> 4"), queries.tokenizer_file()).collect()
    assert sum(x["length"] for x in pieces if x["doc_id"] == 1) > 350_000 and max(x["offset"] + x["length"] for x in pieces) <= 4096
    assert {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 1}
    assert {x["lang_pred"] for x in langid.predict(df, langid.fit(df), F.lit(False)).collect()} == {"en"}
    assert toxicity.predict(df, toxicity.fit(df), F.lit(False)).count() == 4
    prints = {x["doc_id"]: x["fingerprint"] for x in spotsigs.stability(df).collect()}
    assert prints[1] == prints[4] != prints[2]


# --- 1 ---


def test_lattice(spark):
    g = np.random.default_rng(0)
    centres = g.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + g.normal(size=16) * 0.13).astype(np.float32).tolist(), i % 2) for i in range(150)]
    rows += [(200 + i, rows[5][1], 1) for i in range(40)] + [rows[7], (300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] * 16, 0), (304, rows[4][1], None), (None, rows[4][1], 0), (305, [1.0, 2.0], 0), (306, [2.0, 4.0], 0), (307, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"cell": F.lit("x"), "n": F.lit(1), "key": F.lit(2)})
    block, lattice.BLOCK = lattice.BLOCK, 16  # so that cells are dealt out as pairs of blocks
    try:
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in lattice.near_duplicates(df).collect()}
    finally:
        lattice.BLOCK = block
    known = {i: (np.array(v, dtype=np.float64), lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = sorted(known)

    def linked(i, j):
        (a, x), (b, y) = known[ids[i]], known[ids[j]]
        return x == y and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98

    for k, c in enumerate(classes(ids, linked)):
        assert got[ids[k]] == (sum(linked(k, j) for j in range(len(ids)) if j != k), c, c == ids[k]), ids[k]
    assert all(got[i] == (0, i, True) for i in (300, 301, 302, 303, 304, 307)) and got[None] == (0, None, True)
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_lattice_compares_labels_of_any_type(spark):
    v = [1.0, 2.0, 3.0]
    near = [1.01, 2.0, 3.0]
    for kind, a, b in (("string", "x", "y"), ("double", 0.5, 0.75), ("boolean", True, False), ("date", None, None)):
        df = spark.createDataFrame([(1, v, a), (2, near, a), (3, v, b)], f"vec_id long, embedding array<double>, label {kind}")
        got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in lattice.near_duplicates(df).collect())
        assert got == ([(1, 0, 1), (2, 0, 2), (3, 0, 3)] if a is None else [(1, 1, 1), (2, 1, 1), (3, 0, 3)])
    zero = spark.createDataFrame([(1, [1e200, 2e200], 0.0), (2, [1e-200, 2e-200], -0.0), (3, [1e200, -2e200], 0.0)], "vec_id long, embedding array<double>, label double")
    assert sorted((r["vec_id"], r["n_links"]) for r in lattice.near_duplicates(zero).collect()) == [(1, 1), (2, 1), (3, 0)]


@pytest.mark.parametrize("d", [2, 8, 16, 64, 384])
@pytest.mark.parametrize("level", range(6))
def test_lattice_recall_at_the_least_cosine(d, level):
    """Of pairs at a cosine of 0.9801 a table finds the stated share, all tables together every one."""
    g = np.random.default_rng((d, level))
    n, (most, *_, found) = 300, lattice.LEVELS[level]
    a, b = g.normal(size=(n, d)), g.normal(size=(n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9801 * a + np.sqrt(1 - 0.9801**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    grid = lattice.grid(int(min(most, 10**9)), 0.98)
    salt = np.zeros(n, np.int64)
    x, y = lattice.cells(a, salt, grid), lattice.cells(b, salt, grid)
    met = (x == y[:, :, :1]).any(2) | (y == x[:, :, :1]).any(2)
    assert met.any(1).all() and met.mean() > found - 0.03


@pytest.mark.parametrize("d", [64, 384])
def test_lattice_candidates_stay_few(d):
    """Random vectors that share a cell with one that is at home there, on average over all tables: flat from 4,000 to 40,000."""
    g = np.random.default_rng(d)
    for n in (4_000, 40_000):
        grid = lattice.grid(n, 0.98)
        x = g.normal(size=(n, d))
        own = np.concatenate([lattice.cells(u / np.linalg.norm(u, axis=1, keepdims=True), np.zeros(len(u), np.int64), grid) for u in np.array_split(x, n // 2_000)])
        total = 0
        for t in range(grid.tables):
            home, times = np.unique(own[:, t, 0], return_counts=True)
            at = np.minimum(np.searchsorted(home, own[:, t].ravel()), len(home) - 1)
            total += int(times[at][home[at] == own[:, t].ravel()].sum()) - n
        assert total / n < 120


def test_lattice_decoding():
    x = np.random.default_rng(1).normal(size=(300, 8)) * 2
    best = lattice.decode(x)
    near = best[:, None, :] + lattice.NEIGHBOURS[None]
    assert (((x[:, None, :] - near) ** 2).sum(2).min(1) >= ((x - best) ** 2).sum(1) - 1e-9).all() and len(lattice.NEIGHBOURS) == 240


# --- 2 ---


def quality_rows(n=400):
    r, rows = rng(5), []
    for i in range(n):
        good = i % 4 > 0
        text = prose(r, r.randrange(20, 120), 60) + "." if good else " | ".join(f"{prose(r, 1, 60).upper()}!!" for _ in range(40))
        rows.append((i, text, good))
    return rows


def test_importance(spark, empty):
    rows = quality_rows()
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, None), (1001, ""), (None, rows[1][1])], "doc_id long, text string").withColumn("noise", F.lit("clash"))
    good = spark.createDataFrame([(i,) for i, _, g in rows if g and i % 3], "doc_id long")
    got = {r["doc_id"]: r for r in importance.resample(df, good).collect()}
    assert len(got) == len(rows) + 3 and got[1000]["log_weight"] == got[1001]["log_weight"] == 0
    assert all(got[i]["kept"] for i, _, g in rows if g) and not any(got[i]["kept"] for i, _, g in rows if not g)
    assert importance.resample(empty, good).count() == 0
    assert all(r["kept"] for r in importance.resample(df, good.limit(0)).collect())


def test_importance_features_and_threshold(spark):
    texts = [b"Ab, ab AB x x", b"", b"one"]
    f, begin = importance.features(texts)
    assert begin.tolist() == [0, 11, 11, 12] and list(f).count(2 * importance.BUCKETS) == 1
    alone = [importance.features([t])[0].tolist() for t in texts]
    assert [f[a:b].tolist() for a, b in zip(begin[:-1], begin[1:], strict=True)] == alone
    values = [rng(k).choice([1.5, -2.0, 7.25, 7.25]) + k % 7 for k in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 17, 199, 200, 999):
        assert common.threshold(df, "v", k) == sorted(values, reverse=True)[min(k, 200) - 1]


def test_importance_against_plain_counts(spark):
    """Weights, keys, k and the drawn documents from tokens, dictionaries and a sort."""
    rows = [(i, t, g) for i, t, g in quality_rows(160)] + [(500, "", False), (501, "Solo", True), (502, "same Same SAME same", False)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    good = spark.createDataFrame([(i,) for i, _, g in rows if g], "doc_id long")
    noise = {r["doc_id"]: (r["h"], (r["u"] % (1 << 52) + 0.5) / float(1 << 52)) for r in df.select("doc_id", (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)) == 1).alias("h"), F.pmod(F.xxhash64(F.lit(0), "doc_id"), F.lit(1 << 52)).alias("u")).collect()}

    def name(token):  # the bucket of a token or of a pair, from a text of nothing else
        return importance.features([token.encode()])[0].tolist()

    def plain(text):
        tokens = re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]+", text)
        out = [(0, name(t)[0]) for t in tokens]
        for a, b in zip(tokens, tokens[1:], strict=False):
            gap = " " if bool(re.match("[A-Za-z0-9]", a)) == bool(re.match("[A-Za-z0-9]", b)) else ""
            out.append((1, name(f"{a}{gap}{b}")[1]))
        return out

    found = {i: plain(t) for i, t, _ in rows}
    raw = Counter(f for x in found.values() for f in x)
    target = Counter(f for i, _, g in rows if g and not noise[i][0] for f in found[i])
    ratio = {}
    for part in (0, 1):
        size = importance.BUCKETS + 1
        n_raw, n_target = (sum(v for (p, _), v in c.items() if p == part) for c in (raw, target))
        for f in (f for f in raw if f[0] == part):
            q = (raw[f] + 1) / (n_raw + size)
            ratio[f] = np.log((target[f] + size * q) / (n_target + size)) - np.log(q)
    weight = {i: float(np.mean([ratio[f] for f in x]) * min(len(x), importance.LENGTH)) if x else 0.0 for i, x in found.items()}
    key = {i: w - np.log(-np.log(noise[i][1])) for i, w in weight.items()}
    held = sorted(weight[i] for i, _, g in rows if g and noise[i][0])
    k = sum(w >= held[0] - importance.SLACK for w in weight.values())
    least = sorted(key.values(), reverse=True)[k - 1]
    for r in importance.resample(df, good).collect():
        i = r["doc_id"]
        assert r["log_weight"] == pytest.approx(weight[i], abs=1e-9) and r["gumbel_key"] == pytest.approx(key[i], abs=1e-9)
        assert r["kept"] == (key[i] >= least - 1e-9)


def test_importance_ties_at_the_last_place(spark):
    df = spark.createDataFrame([(None, "same words here")] * 5 + [(1, "other words there")], "doc_id long, text string")
    got = importance.resample(df, spark.createDataFrame([(1,)], "doc_id long")).collect()
    assert len({r["kept"] for r in got if r["doc_id"] is None}) == 1  # equal keys stay together


# --- 3 ---

SHAPES = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain_spans(text):
    out = []
    for k, (name, pattern) in enumerate(SHAPES):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + j % 2), 10)) for j, c in enumerate(reversed(digits)))
            if name == "ip" and max(map(int, m[0].split("."))) > 255 or name == "phone" and not 9 <= len(digits) <= 15 or name == "card" and (not 12 <= len(digits) <= 19 or total % 10):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    r = rng(2)
    pieces = ["a@b.c", "x.y+z@", "@", "mail-1.example.co.uk", ".", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111", "+1 (555) 010-9999", "+", "é", " ", "-", "0255.0.0.1", "(", "7", "1" * 30]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(1, 9)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("a" * 200_000 + "1" * 200_000) == []
    assert pii.base_spans("0" * 5000 + ".1.1.1") == [(0, 1, 5006)] and pii.base_spans("9" * 5000 + ".1.1.1") == []


def test_pii_contexts_hold_whole_words():
    word = "z" * 500
    assert pii.patterns(f"{word} id: QX-1 {word}!", 505, 509) == [f"{word} id _", f"id _ {word}", "id _", f"_ {word}"]
    assert pii.patterns("QX-1", 0, 4) == []


def test_pii_of_rows_that_share_an_id(spark):
    rows = [(i, f"member number {i}a@mail{i}.org thanks") for i in range(12)]
    rows += [(20, "member number QX-77812-Z thanks"), (20, "hello world this is a long clean text here"), (None, "member number QX-99 thanks")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = [r["text"] for r in pii.redact(df).where("doc_id = 20 or doc_id is null").collect()]
    assert sorted(clean) == ["hello world this is a long clean text here", "member number [ID] thanks", "member number [ID] thanks"]
    assert sorted(r["n_id"] for r in pii.digests(pii.extract(df)).where("doc_id = 20 or doc_id is null").collect()) == [0, 1, 1]


def test_pattern_scores_against_plain_rounds(spark):
    """Scores of patterns and instances, and the places found, from the plain graph in dictionaries."""
    r, texts = rng(61), []
    for k in range(160):
        seed = f"user{k}@mail.example.com" if k % 2 else f"+1 (555) 010-{1000 + k}"
        other = f"AB-{r.randrange(10**6):06d}"
        lead = r.choice(["please contact", "reach me"]) if r.random() < 0.8 else prose(r, 2)
        texts.append(f"{prose(r, 3)} {lead} {seed if r.random() < 0.7 else other} {r.choice(['today', 'now', 'w1'])} {prose(r, 2)} the item {other[::-1]} is old")
    texts += [texts[0], None, ""]
    scanned = pii.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).cache()
    edges, places = Counter(), []
    seeds = set()
    for row in scanned.collect():
        for f in row["found"]:
            places.append((row["key"], f))
            for p in f["patterns"]:
                edges[p, f["instance"]] += 1
            if f["seed"]:
                seeds.add(f["instance"])
    base = len(seeds) / len({i for _, i in edges})
    trusted = dict.fromkeys(seeds, 1.0)
    for _ in range(pii.ROUNDS):
        good = {}
        for p in {p for p, _ in edges}:
            own = {i: n for (q, i), n in edges.items() if q == p}
            score = {i: trusted.get(i, 0.0) for i in own}
            share = sum(n * score[i] for i, n in own.items()) / sum(own.values())
            k, m, z = sum(score.values()), len(own), pii.Z
            lower = (k / m + z * z / (2 * m) - z * np.sqrt(max(k / m * (1 - k / m), 0) / m + z * z / (4 * m * m))) / (1 + z * z / m)
            sure = lower >= pii.TRUST and lower / (1 - lower) >= pii.LIFT * base / (1 - base)
            if sum(x >= pii.TRUST for x in score.values()) >= pii.LEAST_SEEDS and share >= pii.TRUST and (p % 2 == 0 or sure):
                good[p] = share
        trusted = dict.fromkeys(seeds, 1.0)
        for i in {i for _, i in edges} - seeds:
            doubt = [max(1 - good[p], 1e-9) for q, p in ((i, p) for p, j in edges if j == i) if p in good]
            if doubt:
                trusted[i] = 1 - np.exp(np.log(doubt).sum())
    wanted = {(key, f["start"], f["stop"]) for key, f in places if not f["seed"] and trusted.get(f["instance"], 0) >= pii.TRUST and any(p in good for p in f["patterns"])}
    got = {(g["key"], e["start"], e["stop"]) for g in pii.discover(scanned).collect() for e in g["extra"]}
    assert got == wanted and len(wanted) > 10


def test_hidden_seeds_are_found_again(spark):
    """In contexts that tell, most hidden seeds are found; where words tell nothing, nothing is."""
    r = rng(62)
    kinds = [lambda k: f"p{k}@mail.example.com", lambda k: f"+1 (555) 010-{1000 + k}", lambda k: f"10.{k % 250}.7.{k % 199}"]
    texts = [f"{prose(r, 5)} {('write to', 'call me', 'host at')[k % 3]} {kinds[k % 3](k)} {prose(r, 4)} order {r.randrange(10**7):07d} {prose(r, 3)}" for k in range(300)]
    found = pii.hidden_recall(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert found["hidden"] > 30 and found["again"] >= 0.95 * found["hidden"] and found["others"] <= 5
    texts = [f"{prose(r, 5, 5)} {kinds[k % 3](k) if k % 2 else f'{r.randrange(10**7):07d}'} {prose(r, 4, 5)}" for k in range(300)]
    found = pii.hidden_recall(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert found["others"] <= 0.1 * found["hidden"]


def test_pii(spark, empty):
    r = rng(4)
    rows = [(i, f"{prose(r, 20)} member number {r.randrange(10)}a@mail{i}.org thanks, {prose(r, 9)}") for i in range(12)]
    rows += [(20, f"é {prose(r, 9)} member number QX-77812-Z thanks, {prose(r, 9)}"), (21, None), (22, ""), (23, "call +1 (555) 010-9999 or 10.0.0.1, 4111 1111 1111 1111"), (None, "a@b.org"), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"base": F.lit(1), "found": F.lit(2), "n_chars": F.length("text")})
    got = pii.digests(pii.extract(df)).collect()
    assert len(got) == len(rows)
    by = {g["doc_id"]: g for g in got}
    for i, t in rows:
        want = plain_spans(t or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        g = by[i]
        assert g["base_sha256"] == hashlib.sha256(text.encode()).hexdigest() and set(filter(None, text.split(","))) <= set(g["spans"].split(","))
        assert [g[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(x[1] == j for x in want) for j in range(4)]
    at = rows[12][1].index("QX-77812-Z")
    assert by[20]["spans"] == f"id:{at}:{at + 10}"
    clean = {x["doc_id"]: x for x in pii.redact(df).collect()}
    assert "[ID] thanks" in clean[20]["text"] and clean[23]["text"] == "call [PHONE] or [IP], [CARD]" and clean[23]["n_chars"] == len(clean[23]["text"])
    assert clean[21]["text"] is None and clean[22]["text"] == "" and clean[None]["text"] == "[EMAIL]" and pii.redact(df).columns == df.columns
    assert pii.digests(pii.extract(empty)).count() == 0


# --- 4 ---


def brute_removed(rows, span):
    seen = Counter(t[a : a + span] for _, t in rows for a in range(len(t) - span + 1))
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), dtype=bool)
        for a in range(len(t) - span + 1):
            if seen[t[a : a + span]] > 1:
                gone[a : a + span] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("span", "k", "frequent", "hot"), [(200, 64, 1_000, 100_000), (60, 16, 1_000, 100_000), (60, 16, 2, 100_000), (60, 16, 2, 2)])
def test_suffixes(spark, docs, empty, span, k, frequent, hot):
    want = brute_removed([(r[0], (r[1] or "").encode()) for r in corpus()], span)
    got = [tuple(r) for r in suffixes.remove_repeats(docs, span, k, frequent, hot).collect()]
    assert sorted(got, key=str) == want
    assert suffixes.remove_repeats(empty, span, k, frequent, hot).count() == 0


@pytest.mark.parametrize("frequent", [2, 1_000])
def test_suffixes_of_adversarial_contexts(spark, frequent):
    """Two anchors with equal contexts, texts that share an id, contexts that end in zero bytes, repeated rows."""
    r = rng(21)

    def noise(n):
        return "".join(chr(r.randrange(97, 123)) for _ in range(n))

    x, y, g1, g2 = noise(136), noise(136), noise(64), noise(64)
    rows = [(i, noise(50) + x + (g1 if i % 2 else g2) + y + noise(50)) for i in range(6)]
    shared = noise(300)
    rows += [(10, noise(200) + shared + noise(40)), (10, noise(500)), (11, noise(20) + shared), (12, shared + "\0" * 150 + noise(90)), (13, shared + "\0" * 80), (14, shared)]
    rows += [(20, noise(400))] * 3 + [(None, noise(260)), (None, noise(260) + shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    got = [tuple(g) for g in suffixes.remove_repeats(df, frequent=frequent).collect()]
    assert sorted(got, key=str) == brute_removed([(i, t.encode()) for i, t in rows], 200)


def test_reach_with_zero_bytes():
    r = rng(22)
    for _ in range(200):
        n = r.randrange(2, 9)
        sides = [[bytes(r.choice(b"\0\0a") for _ in range(r.randrange(0, 5))) for _ in range(n)] for _ in range(2)]
        key = np.zeros(n, np.uint64)
        l, h = suffixes.reach(key, suffixes._matrix(suffixes.pa.array(sides[0]), 4), suffixes._matrix(suffixes.pa.array(sides[1]), 4), 3)

        def common(a, b):
            return next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))

        for i in range(n):
            pairs = [(common(sides[0][i], sides[0][j]), common(sides[1][i], sides[1][j])) for j in range(n) if j != i]
            good = [p for p in pairs if sum(p) >= 3]
            assert (l[i], h[i]) == ((max(p[0] for p in good), max(p[1] for p in good)) if good else (-1, -1))


def test_anchors_of_long_texts():
    r = rng(23)
    text = bytes(r.randrange(97, 101) for _ in range(5_000))
    whole = suffixes.anchors([text, text[:700]])
    old, suffixes.SLICE = suffixes.SLICE, 900
    try:
        cut = suffixes.anchors([text, text[:700]])
    finally:
        suffixes.SLICE = old
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))


def test_interval_tree():
    text = b"abracadabra banana abracadabra bandana"
    found = dict(suffixes.maximal_repeats(text, 3))
    want = defaultdict(set)
    for n in range(3, 20):
        for a in range(len(text) - n + 1):
            s = text[a : a + n]
            at = [b for b in range(len(text)) if text[b : b + n] == s]
            left = {text[b - 1 : b] if b else None for b in at}
            right = {text[b + n : b + n + 1] or None for b in at}
            if len(at) > 1 and (len(left) > 1 or None in left) and (len(right) > 1 or None in right):
                want[n].add(tuple(at))
    assert {n: tuple(v) for n, v in found.items()} == {n: next(iter(v)) for n, v in want.items() if len(v) == 1} or set(found) == set(want)
    assert suffixes.lcp_intervals([1, 3, 3, 0, 2]) == [(3, 1, 3), (1, 0, 3), (2, 4, 5), (0, 0, 5)]


def test_anchors_follow_content():
    r = rng(8)
    a, b = (bytes(r.randrange(97, 123) for _ in range(3000)) for _ in range(2))
    shared = a[500:900]
    text = b[:777] + shared + b[777:]
    _, p, h = suffixes.anchors([a, text])
    first = {(x - 500, y) for n, x, y in zip(_, p, h, strict=True) if n == 0 and 500 <= x <= 900 - 64}
    second = {(x - 777, y) for n, x, y in zip(_, p, h, strict=True) if n == 1 and 777 <= x <= 1177 - 64}
    assert {x for x in first if 136 <= x[0] <= 200} == {x for x in second if 136 <= x[0] <= 200} != set()


# --- 5 ---


def test_mixing(spark, empty):
    r, rows = rng(6), []
    for i in range(300):
        lang = ("en", "de", "fr")[0 if i % 10 < 7 else 1 if i % 10 < 9 else 2]
        rows.append((i, " ".join(f"{lang}{r.randrange(50)}" for _ in range(r.randrange(5, 60))), lang))
    df = spark.createDataFrame([*rows, (900, None, "en"), (901, "", None), (None, rows[0][1], None)], "doc_id long, text string, lang string").withColumn("n_tokens", F.lit("clash"))
    weights = {"en": 0.2, "de": 0.3, "fr": 0.5}
    mixer = mixing.mix(df, mixing.fit(df, "lang"), weights)
    got = mixing.rated(df, mixer).collect()
    assert len(got) == 303 and all(g["rate"] >= 0 for g in got)
    tokens = {x: sum(g["rate"] * g["n_tokens"] * g["posteriors"][x] for g in got) for x in weights}
    assert all(abs(v / sum(tokens.values()) - weights[x]) < 1e-4 for x, v in tokens.items())
    assert {g["copies"] for g in got if not g["n_tokens"]} == {1}
    rows_out = mixing.apply(df, mixer)
    assert rows_out.columns == df.columns and rows_out.count() == sum(g["copies"] for g in got)
    assert mixing.rated(empty, mixing.mix(empty, mixing.fit(empty, "lang"), None)).count() == 0
    # a domain that isn't there passes its weight on, one that isn't named keeps its tokens
    got = mixing.rated(df, mixing.mix(df, mixing.fit(df, "lang"), {"en": 0.3, "de": 0.3, "xx": 0.4})).collect()
    tokens = {x: sum(g["rate"] * g["n_tokens"] * g["posteriors"][x] for g in got) for x in weights}
    assert tokens["en"] == pytest.approx(tokens["de"], rel=1e-4) and tokens["fr"] == pytest.approx(sum(g["n_tokens"] * g["posteriors"]["fr"] for g in got), rel=1e-4)


def test_mixing_against_dense_computation(spark):
    """Posteriors from plain counts, and rates from the same descent on the whole matrix."""
    r, rows = rng(16), []
    for i in range(120):
        lang = "ab"[i % 3 > 0]
        rows.append((i, " ".join(r.choice([f"{lang}{r.randrange(20)}", f"c{r.randrange(20)}"]) for _ in range(r.randrange(1, 30))), lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = mixing.fit(df, "lang")
    got = {g["doc_id"]: g for g in mixing.rated(df, mixing.mix(df, model, {"a": 0.5, "b": 0.5})).collect()}
    count = {x: Counter() for x in "ab"}
    for _, t, lang in rows:
        h, _b = common.word_hashes([t.encode()])
        count[lang].update((h & np.uint64(mixing.BUCKETS - 1)).tolist())
    share = {x: sum(lang == x for *_, lang in rows) / len(rows) for x in "ab"}
    p = np.empty((len(rows), 2))
    for i, t, _ in rows:
        at = (common.word_hashes([t.encode()])[0] & np.uint64(mixing.BUCKETS - 1)).tolist()
        logs = [np.log(share[x]) + sum(np.log((count[x][f] + 0.1) / (sum(count[x].values()) + 0.1 * mixing.BUCKETS)) for f in at) for x in "ab"]
        p[i] = np.exp(np.array(logs) - max(logs)) / np.exp(np.array(logs) - max(logs)).sum()
        assert [got[i]["posteriors"]["a"], got[i]["posteriors"]["b"]] == pytest.approx(p[i].tolist(), abs=1e-4)
    t = np.array([len(x.split()) for _, x, _ in rows], dtype=float)
    totals = t @ p
    targets = np.array([0.5, 0.5]) * 2 * totals.max()
    rate, inverse = np.ones(len(rows)), np.linalg.inv((p * t[:, None]).T @ p)
    targets /= min(1, (inverse @ targets).min())
    for _ in range(200):
        rate = np.maximum(0, rate - p @ (inverse @ ((t * rate) @ p - targets)))
    assert [got[i]["rate"] for i, *_ in rows] == pytest.approx(rate.tolist(), abs=2e-3)
    assert all(g["copies"] in (int(g["rate"]), int(g["rate"]) + 1) for g in got.values()) and min(g["copies"] for g in got.values()) >= 1


def test_mixing_takes_any_domain_names(spark, tmp_path):
    rows = [(i, f"w{i % 5} w{i % 3} x", ("Web", "web", "a`b", "a.b", "")[i % 5]) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixing.rated(df, mixing.mix(df, mixing.fit(df, "source"), None)).write.parquet(str(tmp_path / "rated"))
    got = spark.read.parquet(str(tmp_path / "rated")).collect()
    assert len(got) == 50 and all(set(g["posteriors"]) == {"Web", "web", "a`b", "a.b", ""} for g in got)


def test_mixing_pools_the_tail_of_domains(spark, monkeypatch):
    """2,000 domains: models stay bounded, own and pooled targets are met together."""
    monkeypatch.setattr(mixing, "OWN_DOMAINS", 20)
    monkeypatch.setattr(mixing, "POOLS", 4)
    rows = [(i, f"d{i % 40} w{i % 7}", f"s{i % 40}" if i % 2 else f"tail{i}") for i in range(4_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    model = mixing.fit(df, "source")
    assert len(model.domains) <= mixing.OWN_DOMAINS + mixing.POOLS and model.table.shape == (mixing.BUCKETS, len(model.domains))
    given = model.weights({"s1": 2.0, "tail2": 0.5, "tail4": 0.25})
    assert given.sum() == pytest.approx(2.75) and given[model.domains.index("s1")] == 2.0
    got = mixing.rated(df, mixing.mix(df, model, None)).agg(F.count("*"), F.min("copies"), F.max(F.abs(F.aggregate(F.map_values("posteriors"), F.lit(0.0), lambda a, x: a + x) - 1))).first()
    assert got[0] == 4_000 and got[1] >= 1 and got[2] < 1e-6


def test_mixing_drops_nothing_where_texts_tell_little(spark):
    """Domains that differ in size only: posteriors are noise; every document stays, and the shares come nearer to the targets."""
    r = rng(17)
    rows = [(i, prose(r, r.randrange(1, 60), 50), "abcd"[0 if i % 10 < 7 else i % 10 - 6]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.rated(df, mixing.mix(df, mixing.fit(df, "source"), None, least=1.0)).collect()
    assert min(g["rate"] for g in got) >= 1 and min(g["copies"] for g in got) >= 1
    own = np.array([sum(g["n_tokens"] * g["posteriors"][x] for g in got) for x in "abcd"])
    made = np.array([sum(g["rate"] * g["n_tokens"] * g["posteriors"][x] for g in got) for x in "abcd"])
    wanted = own**0.7 / (own**0.7).sum()
    assert np.abs(made / made.sum() - wanted).max() < 0.5 * np.abs(own / own.sum() - wanted).max()


# --- 6 ---


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_file())
    got = packing.pack(docs, queries.tokenizer_file(), 512).collect()
    want = Counter()
    for i, t, *_ in corpus():
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.update((i, k, a, len(ids[a : a + 512]), zlib.crc32(ids[a : a + 512].tobytes())) for k, a in enumerate(range(0, len(ids), 512)))
    assert Counter(tuple(r)[:5] for r in got) == want
    per = defaultdict(list)
    for r in got:
        per[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in per.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 512
    assert len(per) <= sum(times for _, times in packing.best_fit(Counter(r["length"] for r in got), 512)) + 1
    assert packing.pack(empty, queries.tokenizer_file()).count() == 0


def test_ids_equal_the_tokenizers_on_any_text():
    from tokenizers import Tokenizer

    plain, own, r = Tokenizer.from_file(queries.tokenizer_file()), packing.Encoder(queries.tokenizer_file()), rng(24)
    letters = ["İ", "I", "ı", "é", "e\u0301", "\u0307", "ß", "ǰ", "Σ", "漢", "𝔘", "ﬁ", "a", "B", "7", "'", "_", "-", "’", "\u200d", "😀", "\x1c", "\x85", "\u00a0", "\u3000", "\u2028", "\n", " ", "<|endoftext|>", *".,!?:;|&%$#*"]
    for _ in range(4000):
        text = "".join(r.choice(letters) if r.random() < 0.9 else chr(r.choice([r.randrange(1, 0xD800), r.randrange(0xE000, 0x11000)])) for _ in range(r.randrange(1, 12)))
        assert own.encode(text) == plain.encode(text, add_special_tokens=False).ids, ascii(text)


def test_parts_split_only_where_the_tokenizer_does():
    """Every letter that is taken to end plainly, before every mark."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_file())
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    ends = [x for x in letters if packing._ends_plainly(x)]
    assert len(letters) - len(ends) > 59 and "\u09dc" not in ends
    encode = lambda texts: [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    heads, tails = encode(ends), dict(zip(packing._MARKS, encode(list(packing._MARKS)), strict=True))
    for mark, tail in tails.items():
        wrong = [x for x, head, whole in zip(ends, heads, encode([x + mark for x in ends]), strict=True) if head + tail != whole]
        assert not wrong, (mark, wrong[:5])
    own = packing.Encoder(queries.tokenizer_file())
    for x in set(letters) - set(ends):
        for mark in packing._MARKS:
            assert own.encode(x + mark) == plain.encode(x + mark, add_special_tokens=False).ids, (ascii(x), mark)


def test_plan_uses_the_histogram_up():
    g = np.random.default_rng(2)
    histogram = Counter(np.clip(g.lognormal(5, 1, 20_000).astype(int), 1, 1000).tolist())
    made = packing.plan(histogram, 1000)
    used = Counter()
    for pattern, times in made:
        assert sum(pattern) <= 1000 and times > 0
        for x in pattern:
            used[x] += times
    assert used == histogram and sum(t for _, t in made) <= 1.003 * sum(k * v for k, v in histogram.items()) / 1000 + 1
    assert packing.plan({}, 10) == [] and packing.plan({7: 3}, 10) == [((7,), 3)]


def test_nnls_is_projected():
    a = np.array([[0, 1], [1, 1], [0, 2]])
    b = np.array([5.0, 9.0, 1.0])
    x = packing.nnls(a, b, 4000)
    dense = np.zeros((3, 3))
    for k, row in enumerate(a):
        for j in row:
            dense[j, k] += 1
    best = min((np.linalg.norm(dense @ np.array(y) - b), y) for y in itertools.product(np.linspace(0, 6, 25), repeat=3))
    assert (x >= 0).all() and np.linalg.norm(dense @ x - b) <= best[0] + 1e-3


# --- 7 ---


@pytest.mark.parametrize(("k", "percent", "block", "n_bands"), [(3, 85, 256, 24), (3, 85, 3, 24), (5, 80, 256, 30)])
def test_minhash(docs, empty, k, percent, block, n_bands):
    old, minhash.BLOCK_DOCS = minhash.BLOCK_DOCS, block
    try:
        got = minhash.near_duplicates(docs, shingle=k, percent=percent, n_bands=n_bands).collect()
    finally:
        minhash.BLOCK_DOCS = old
    texts = {r[0]: r[1] for r in corpus() if r[0] is not None}
    ids = sorted(texts)
    sets = [shingles(texts[i], k) for i in ids]
    component = dict(zip(ids, classes(ids, lambda i, j: bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])), strict=True))
    assert len(got) == len(corpus())
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            c = component[r["doc_id"]]
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(shingles(texts[r["doc_id"]], k)), c, c == r["doc_id"])
    assert minhash.near_duplicates(empty).count() == 0


def test_large_groups_are_verified_by_index():
    r = rng(9)
    base = prose(r, 90)
    sets = common.shingle_sets([edit(r, base, 0.04).encode() for _ in range(60)], 3)
    forest = verify.jaccard_links(sets, None, 85)
    plain = [set(s.tolist()) for s in sets]
    want = classes(list(range(60)), lambda i, j: 100 * len(plain[i] & plain[j]) >= 85 * len(plain[i] | plain[j]))
    assert [forest.find(i) for i in range(60)] == want


def test_links_between_sides():
    r = rng(10)
    base = prose(r, 60)
    sets = common.shingle_sets([edit(r, base, 0.05).encode() for _ in range(50)], 3)
    plain = [set(x.tolist()) for x in sets]
    for cut, few in ((1, 50), (20, 50), (5, 12)):
        side = np.array([int(k >= cut) for k in range(few)])
        got = verify.jaccard_links(sets[:few], side, 80)
        want = classes(list(range(few)), lambda i, j, side=side: side[i] != side[j] and 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j]))
        assert [got.find(i) for i in range(few)] == want


@pytest.mark.parametrize("block", [3, 256])
def test_groups_whose_members_link_past_their_first(spark, block):
    """Chains in which only neighbours link, and two clusters that nothing but a proposal joins."""
    words = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(words[8 * i : 8 * i + 100])) for i in range(12)]
    rows += [(100 + i, " ".join(["same"] * 3 + words[200 : 300] + [f"x{i}"])) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = spark.createDataFrame([(0, i) for i, _ in rows[1:]], "a long, b long")
    sizes = df.select(F.col("doc_id").alias("node"), F.lit(100).alias("n"))
    for percent in (80, 90):
        got = {x["node"]: x["component"] for x in verify.components(pairs, df, sizes, lambda t: common.shingle_sets(t, 3), percent, block, 100_000).collect()}
        sets = [shingles(t, 3) for _, t in rows]
        ids = [i for i, _ in rows]
        want = dict(zip(ids, classes(ids, lambda i, j: 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])), strict=True))
        assert {i: got.get(i, i) for i in ids} == want


def test_signature_shifts_one_permutation():
    s = [np.array([3, 99, 12345], dtype=np.uint64)]
    got = minhash.signatures(s, 4)[0]
    points = common.mix(s[0] + np.uint64(0x9E3779B97F4A7C15))
    assert got.tolist() == [int(common.mix(points + np.uint64(j)).min()) for j in range(4)]


# --- 8 ---


def test_langid(spark, empty):
    r, rows = rng(1), []
    words = {"en": ["the", "thing", "other", "with"], "de": ["der", "schön", "über", "nicht"], "fr": ["le", "élève", "où", "très"]}
    for i in range(240):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join(r.choice(words[lang]) + (r.choice(words[lang]) if r.random() < 0.3 else "") for _ in range(15)), lang))
    rows += [(900, None, "en"), (901, "123 !!", "en"), (902, "", "de"), (903, "Überschönes", None), (None, "the thing", "en"), (904, "漢字", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    held = F.col("doc_id") % 4 == 2
    model = langid.fit(df.where(~held))
    got = {x["doc_id"]: x for x in langid.predict(df, model, held).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows if i is not None and i < 900)
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und", "und", "und", "de"] and got[None]["lang_pred"] == "en"
    assert got[904]["lang_pred"] in words and all(0 <= x["score"] <= 1 for x in got.values())
    assert langid.predict(empty, langid.fit(empty), F.lit(False)).count() == 0
    assert model.back_off("zzz") is None and model.back_off("üb") is not None


def test_numerals_are_no_letters(spark):
    df = spark.createDataFrame([(0, "der hund", "de"), (1, "the dog", "en"), (2, "² ½", "de"), (3, "①② Ⅷ 12 _", "en"), (4, "x²y", "en"), (5, "²dog", "en")], "doc_id long, text string, lang string")
    got = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in langid.predict(df, langid.fit(df.where("doc_id < 2")), F.lit(False)).collect()}
    assert got[2] == got[3] == ("und", 0.0) and got[4][0] != "und" and got[5][0] == "en"
    assert langid.words("Ab²c ①d") == ["ab", "c", "d"]


def test_langid_against_plain_counts(spark):
    """Scores by dictionaries: log frequencies of known words, else means over the longest n-grams that are known."""
    r, rows = rng(31), []
    words = {"en": ["the", "thing", "other"], "de": ["der", "schön", "über"]}
    for i in range(60):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(r.choice(words[lang]) + (r.choice(words[lang]) if r.random() < 0.3 else "") for _ in range(r.randrange(1, 9))), lang))
    more = [(100, "othering schönes xq", None), (101, "zzz", None), (102, "THE über-other", None), (103, "the der", None), (104, "qqq", None)]
    df = spark.createDataFrame(rows + more, "doc_id long, text string, lang string")
    model = langid.fit(df)
    count = {x: {"w": Counter(), "g": Counter()} for x in words}
    for _, t, lang in rows:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            count[lang]["w"][w] += 1
            for n in range(1, 6):
                padded = f"^{w}$" if n > 1 else w
                for a in range(len(padded) - n + 1):
                    count[lang]["g"][padded[a : a + n]] += 1
    known = {k: set(count["en"][k]) | set(count["de"][k]) for k in "wg"}

    def log(lang, k, x):
        return np.log((count[lang][k][x] + 0.5) / (sum(count[lang][k].values()) + 0.5 * (len(known[k]) + 1)))

    langs = sorted(words)
    for g in langid.predict(df, model, F.lit(False)).collect():
        text = next(t for i, t, _ in rows + more if i == g["doc_id"])
        total = np.log([0.5, 0.5])
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            if w in known["w"]:
                total = total + [log(x, "w", w) for x in langs]
                continue
            for n in range(5, 0, -1):
                padded = f"^{w}$" if n > 1 else w
                if some := [p for a in range(len(padded) - n + 1) if (p := padded[a : a + n]) in known["g"]]:
                    total = total + [np.mean([log(x, "g", p) for p in some]) for x in langs]
                    break
        odds = np.exp(total - total.max())
        assert g["lang_pred"] == langs[int(odds.argmax())] and g["score"] == pytest.approx(odds.max() / odds.sum(), abs=1e-4), text


# --- 9 ---


def test_toxicity(spark, empty):
    r, rows = rng(7), []
    bad = ["blurg", "snarfle", "grotz"]
    for i in range(300):
        toxic = i % 5 == 0
        w = prose(r, 30).split()
        for _ in range(3 if toxic else 0):
            w[r.randrange(len(w))] = r.choice(bad)
        rows.append((i, " ".join(w), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.where("doc_id % 4 <> 1"))
    odd = spark.createDataFrame([(900, None), (901, ""), (None, "blurg snarfle grotz blurg")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {x["doc_id"]: x for x in toxicity.predict(df.select("doc_id", "text"), model, F.col("doc_id") % 4 == 1).union(toxicity.predict(odd, model, F.lit(None))).collect()}
    held = [(got[i]["predicted"], y) for i, _, y in rows if got[i]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    assert got[900]["score"] == got[901]["score"] < 0.5 and not got[900]["held_out"] and got[None]["predicted"] == 1
    one = toxicity.fit(df.where("toxic = 0"))
    assert one.score("blurg") < 0.5 and toxicity.predict(empty, toxicity.fit(df.limit(0)), F.lit(True)).count() == 0


def test_toxicity_against_dense_computation(spark):
    """n-grams from the text, ratios from plain counts, and the same descent on the whole matrix."""
    r, rows = rng(32), []
    for i in range(120):
        w = prose(r, 12, 30).split()
        if i % 4 == 0:
            w[r.randrange(12)] = r.choice(["blurg", "snarfle"])
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = []
    for _, t, _ in rows:
        padded = f" {t.lower()} "
        assert len({padded[a : a + n] for n in toxicity.SIZES for a in range(len(padded) - n + 1)}) == pytest.approx(len(toxicity.features(t)), abs=3)  # buckets may meet
        found.append(toxicity.features(t))
    y = np.array([z for *_, z in rows], dtype=float)
    x = np.zeros((len(rows), 1 << toxicity.BITS), dtype=np.int8)
    for i, f in enumerate(found):
        x[i, f] = 1
    used = np.flatnonzero(x.any(0))
    x = x[:, used].astype(float)
    a, b = x[y == 1].sum(0), x[y == 0].sum(0)
    ratio = np.log((a + 1) / (y.sum() + 2)) - np.log((b + 1) / ((1 - y).sum() + 2))
    sure = np.abs(ratio) / np.sqrt(1 / (a + 1) + 1 / (b + 1))
    sure[a + b < 3] = 0
    ratio[sure == 0] = 0
    assert (sure > 0).sum() < toxicity.KEEP
    z = x * ratio
    w, c, m, v, mb, vb = np.zeros(len(used)), 0.0, 0.0, 0.0, 0.0, 0.0
    for t in range(1, 81):
        miss = 1 / (1 + np.exp(-(z @ w + c))) - y
        g, gb = z.T @ miss / len(y) + 3e-3 * w, miss.mean()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.02 / (1 + t / 60)
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        c -= rate * (mb / (1 - 0.9**t)) / (vb / (1 - 0.99**t) + 1e-12) ** 0.5
    want = 1 / (1 + np.exp(-(z @ w + c)))
    got = {g["doc_id"]: g["score"] for g in toxicity.predict(df.select("doc_id", "text"), toxicity.fit(df), F.lit(False)).collect()}
    assert [got[i] for i, *_ in rows] == pytest.approx(want.tolist(), abs=2e-3)


# --- 10 ---


def plain_chains(text):
    """Signatures as tuples of words: a common word and the two content words after it."""
    words = "".join(" " if c in ".,!?:;|&%$#*()[]\"'" else c for c in text)
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
    common, out = set(spotsigs.ANTECEDENTS), set()
    for k, w in enumerate(words):
        if w in common:
            content = [x for x in words[k + 1 :] if x not in common][:2]
            if len(content) == 2:
                out.add((w, *content))
    return out or ({tuple(words)} if words else set())


def test_spotsigs_against_plain_chains(spark):
    r = rng(33)
    some = ["the", "of", "Is", "la", "und", *[f"c{k}" for k in range(12)], "x.", "(y)", "\n"]
    rows = [(i, " ".join(r.choice(some) for _ in range(r.randrange(0, 60)))) for i in range(80)]
    rows += [(k + 100, t if k % 2 else t[: len(t) * 9 // 10]) for k, (_, t) in enumerate(rows[:30])] + [(None, "the a b"), (200, None), (201, "of " * 5), (50, "second row of an id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = defaultdict(list)
    for g in spotsigs.stability(df).collect():
        got[-1 if g["doc_id"] is None else g["doc_id"]].append(g)
    order = sorted(((-1 if i is None else i, t or "") for i, t in rows), key=lambda x: (x[0], x[1]))

    def like(a, b):
        a, b = plain_chains(a), plain_chains(b)
        return len(a & b) / len(a | b) if a | b else 1.0

    for (i, t), (_, f) in zip(order, order[1:] + order[:1], strict=True):
        new = spotsigs.edited(t, f)
        g = next(x for x in got[i] if x["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest() and x["n_chars"] == len(t))
        assert len(list(filter(None, g["fingerprint"].split(",")))) == len(plain_chains(t))
        assert (g["near_edited"], g["near_next"]) == pytest.approx((like(t, new), like(t, f)))


@pytest.mark.parametrize("least", [None, 0.1, 0.5, 0.8])
def test_pruned_likeness_loses_nothing(least):
    g = np.random.default_rng(34)
    old, spotsigs.RUN = spotsigs.RUN, 7
    try:
        for _ in range(400):
            a = np.unique(g.integers(0, 60, size=g.integers(0, 60)).astype(np.uint64))
            b = np.unique(np.concatenate([a[g.random(len(a)) < g.random()], g.integers(0, 90, size=g.integers(0, 30)).astype(np.uint64)]))
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b)) if len(a) + len(b) else 1.0
            assert spotsigs.likeness(a, b, least) == pytest.approx(j if j >= (least or 0) else 0.0)
            if least and j >= least and len(a) and len(b):
                assert abs(spotsigs.partition(len(a), least) - spotsigs.partition(len(b), least)) <= 1
    finally:
        spotsigs.RUN = old


def test_spotsigs(spark, docs, empty):
    got = spotsigs.stability(docs).collect()
    rows = sorted(((-1 if r[0] is None else r[0], r[1] or "") for r in corpus()), key=lambda x: (x[0], x[1]))
    assert len(got) == len(rows)
    by = defaultdict(list)
    for g in got:
        by[-1 if g["doc_id"] is None else g["doc_id"]].append(g)

    def likeness(a, b):
        a, b = (set(filter(None, x.split(","))) for x in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    prints = {(i, t): None for i, t in rows}
    for (i, t), (j, f) in zip(rows, rows[1:] + rows[:1], strict=True):
        new = hashlib.sha256(spotsigs.edited(t, f).encode()).hexdigest()
        g = next(x for x in by[i] if x["edited_sha256"] == new)
        by[i].remove(g)
        prints[i, t] = g["fingerprint"]
        assert g["n_chars"] == len(t) and g["near_edited"] == pytest.approx(likeness(g["fingerprint"], g["edited_fingerprint"]))
        following = spotsigs.fingerprint(spotsigs.signature_sets([f.encode()])[0])
        assert g["near_next"] == pytest.approx(likeness(g["fingerprint"], following))
    same = defaultdict(set)
    for (_, t), p in prints.items():
        same[t].add(p)
    assert all(len(v) == 1 for v in same.values()) and same[""] == {""} and same["eins"] != {""}
    assert spotsigs.stability(empty).count() == 0


def test_spotsigs_near_duplicates(spark, docs):
    rows = {r[0]: r[1] for r in corpus() if r[0] is not None}
    r = rng(12)
    more = [" ".join(r.choice(["the", "of", "is"]) if k % 3 == 0 else f"c{r.randrange(80)}" for k in range(120)) for _ in range(4)]
    rows |= {500 + 10 * k + j: (m if j == 0 else edit(rng(j), m, 0.02)) for k, m in enumerate(more) for j in range(4)}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in spotsigs.near_duplicates(df, 80).collect()}
    ids = sorted(rows)
    sets = [set(s.tolist()) for s in spotsigs.signature_sets([(rows[i] or "").encode() for i in ids])]
    assert got == dict(zip(ids, classes(ids, lambda i, j: bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])), strict=True))
