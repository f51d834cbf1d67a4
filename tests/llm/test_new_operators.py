"""Impact index, whitening and tokeniser rules against brute force, odd rows included."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from folioflow.llm import fertility, impacts, queries, whitening

DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, block long, score long, group string, length int, kept string"


def rows(texts, langs=("en",)):
    return [(i, t, langs[i % len(langs)], "s", 1, "t", i, i, "g", 1, "k") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- impact index -------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(docs, items, k=10):
    split = [(d, lowered(t)) for d, t in docs]
    split = [(d, w) for d, w in split if w]
    n_docs, n_all = len(split), sum(len(w) for _, w in split)
    df = Counter(x for _, w in split for x in set(w))
    out = []
    asked = {}
    for item, text in {x for x in items if x[0] is not None}:
        asked.setdefault(item, Counter()).update(lowered(text))
    for item, terms in asked.items():
        scores = []
        for d, w in split:
            m = 100 - 75 + (75 * len(w) * n_docs) // n_all
            tf = Counter(w)
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1000000000 * tf[x]) // (1000 * tf[x] + 8 * m)) for x, q in terms.items() if tf[x])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=lambda x: x[:2])


@pytest.mark.parametrize("block_docs,group_items", [(16_384, 256), (100, 2)])
def test_impacts(spark, block_docs, group_items):
    r = random.Random(1)
    texts = [" ".join(f"{r.choice('aBcé')}{r.randrange(30)}" for _ in range(r.randrange(1, 60))) for _ in range(2500)]
    texts += [None, "", " \n.,", "É É é", texts[0], texts[0], "x\x00y\x7fz", "日本 日本,日本"]
    own = [*rows(texts), (None, texts[3], *[None] * 9), rows(texts)[5]]
    items = [(1, "a1 B2 c3 a1 É"), (2, "日本 x z"), (3, None), (4, ""), (5, "nowhere"), (6, texts[0]), (6, "é é"), (7, texts[9]), (7, texts[9]), (None, "a1")]
    docs = spark.createDataFrame(own, DOCS).coalesce(2)
    asked = spark.createDataFrame([(a, b, 7) for a, b in items], "item_id long, text string, rank int")
    found = [tuple(x) for x in impacts.rank(docs, asked, block_docs=block_docs, group_items=group_items).collect()]
    found.sort(key=lambda x: x[:2])
    wanted = plain_ranks([(x[0], x[1]) for x in own], items)
    assert found == wanted


def test_impacts_of_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert impacts.rank(empty, items).columns == ["item_id", "rank", "doc_id", "score"]
    assert not impacts.rank(empty, items).count()
    assert not impacts.rank(spark.createDataFrame(rows(["a b"]), DOCS), items.limit(0)).count()


def test_very_long_documents_are_indexed_whole(spark):
    texts = ["far " + "w1 w2, " * 400_000 + "end", "w1 end", "u" * 2_500_000 + " w1", "other"]
    items = [(1, "far end"), (2, "w1"), (3, "u" * 2_500_000)]
    docs = spark.createDataFrame(rows(texts), DOCS)
    found = sorted(tuple(x) for x in impacts.rank(docs, spark.createDataFrame(items, "item_id long, text string")).collect())
    assert found == plain_ranks(list(enumerate(texts)), items)


def test_blocks_end_by_documents_and_postings():
    block = impacts.Block()
    block.add([3, 1, None], [b"a b", b"b b", b"c"])
    head, *own = list(block.rows(5, 3, 5))
    assert np.frombuffer(head.column("slots")[0].as_py(), "<i8").tolist() == [1, 3, 0]
    got = {t: (np.frombuffer(s, np.uint16).tolist(), n) for x in own for t, s, n in zip(x.column("term").to_pylist(), x.column("slots").to_pylist(), x.column("n_docs").to_pylist(), strict=True)}
    assert got == {"a": ([1], 1), "b": ([0, 1], 2), "c": ([2], 1)}


@given(st.lists(st.tuples(st.lists(st.integers(0, (1 << 20) - 1), min_size=70, max_size=70), st.integers(0, 30_000), st.integers(1, 5)), min_size=1, max_size=5), st.integers(1, 12))
def test_bitwise_sums_and_tops(terms, k):
    slots = np.arange(0, 210, 3)
    total, carry = (np.zeros((44, 4), "<u8") for _ in range(2))
    plain = np.zeros(256, dtype=np.int64)
    for values, weight, q in terms:
        cut = impacts.slices(np.array(values), np.array([0, 70]), 20)
        bits = np.frombuffer(cut[0].as_py(), np.uint8).reshape(20, -1)
        wide = impacts.spread(impacts.times(bits, weight), slots, 4)
        for s in range(q.bit_length()):
            if q >> s & 1:
                impacts.carry_save(total, carry, wide, s)
        plain[slots] += np.array(values) * weight * q
    final = impacts.settle(total, carry)
    assert impacts.read(final, np.arange(256)) == plain.tolist()
    best = impacts.top(final, k)
    wanted = [s for s in sorted(range(256), key=lambda s: (-plain[s], s)) if plain[s] > 0][:k]
    assert sorted(best.tolist()) == sorted(wanted)


# --- whitening ----------------------------------------------------------------------------------


def plain_whitening(vectors, components=16):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    d = (n * u - s).astype(object)
    v = np.array((d.T @ d) / n**3, dtype=float)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    keep = [k for k in range(len(e)) if e[k] > 1e-12 * e[0]][:components]
    own = (n * x - s).astype(object)
    return n, (own * own).sum(1).tolist(), np.abs(np.array(own / n, dtype=float) @ q[:, keep] / np.sqrt(e[keep])), e[keep] / np.trace(v)


@pytest.mark.parametrize("d,scale", [(5, 1.0), (24, 1.0), (24, 1e4), (3, 1e11)])
def test_whitening(spark, d, scale):
    r = np.random.default_rng(d)
    vectors = (r.normal(size=(300, d)) @ r.normal(size=(d, d)) * scale).tolist()
    vectors += [vectors[0]] * 40
    odd = [None, [], [None] * d, [float("nan")] + [0.0] * (d - 1), [float("inf")] + [0.0] * (d - 1), [1.0]]
    own = [(i, v, 1, 5, 0.5) for i, v in enumerate([*vectors, *odd])] + [(None, vectors[1], None, None, None)]
    table = spark.createDataFrame(own, "vec_id long, embedding array<double>, label int, n int, whitened double").repartition(3)
    found = whitening.whiten(table).collect()
    n, deviation, white, explained = plain_whitening([*vectors, vectors[1]])
    k = len(explained)
    assert k == min(d, 16) and len(found) == k * (len(vectors) + 1)
    place = {i: i for i in range(len(vectors))} | {None: len(vectors)}
    for x in found:
        at, c = place[x["vec_id"]], x["component"] - 1
        assert x["n"] == n and x["deviation"] == (deviation[at] if deviation[at] < 1 << 63 else None)
        assert abs(abs(x["whitened"]) - white[at][c]) < 1e-7
        assert abs(x["explained"] / explained[c] - 1) < 1e-9 and x["identity_error"] < 1e-6


def test_whitening_of_little(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None]):
        assert not whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), kind)).count()
    # a constant dimension and dependent ones leave fewer components
    found = whitening.whiten(spark.createDataFrame([(i, [float(i), float(-i), 3.0]) for i in range(10)], kind)).collect()
    assert {x["component"] for x in found} == {1} and all(abs(x["explained"] - 1) < 1e-12 for x in found)


# --- tokeniser rules ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def files():
    pytest.importorskip("public_tokenizers")
    return queries.vocabulary_files()


def plain_rules(text, vocabularies):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    base = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside))
    out = []
    for v in vocabularies:
        ids = [k for w in words for k in v.split([w])[0]]
        n = len(ids)
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) if n else 0.0
        out.append((n, base[1] / max(n, 1), sum(bool(v.is_byte[k]) for k in ids) / max(n, 1), entropy))
    return base, out


def prose(r, n, words=300):
    return " ".join(f"{r.choice(['the', 'running', 'houses'])}{r.randrange(words)}" for _ in range(n))


def test_fertility(spark, empty, files):
    r = random.Random(2)
    good = [prose(r, r.randrange(60, 200)) + f"\nline {k % 3}\n" for k in range(200)]
    texts = [*good, None, "", " \n ", "a b c a b c", "x\x00y 日本語 𓀀𓁀 \x85  z" * 3, "dup\ndup \n dup\n\ndup\r\ndup", good[0], "zu " * 80, "$$$ ### | " * 30, prose(r, 9_000)]
    bad = [" ".join("".join(r.choice("qxzjvk") for _ in range(6)) for _ in range(60)), " ".join(chr(0x13000 + r.randrange(900)) for _ in range(60))]
    own = [*rows([*texts, *bad]), (None, good[1], *[None] * 9)]
    found = fertility.rules(spark.createDataFrame(own, DOCS).repartition(3), *files).collect()
    vs = [fertility.Vocabulary(f, files[1]) for f in files[0]]
    assert len(found) == len(own)
    by = {x["doc_id"]: x for x in found}
    for doc, text, *_ in own:
        base, measures = plain_rules(text, vs)
        x = by[doc]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == base, text
        for k, m in enumerate(measures):
            got = (x["n_tokens"][k], x["chars_per_token"][k], x["byte_share"][k], x["token_entropy"][k])
            assert np.allclose(got, m, atol=1e-9), text
        assert x["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (x["kept"] and x["base_failed"])
    assert all(by[k]["kept"] for k in range(200))
    assert not any(by[len(texts) + k]["kept"] for k in range(2)) and by[len(texts) + 1]["outside"]
    assert by[None]["group"] == "LATIN" and by[None]["kept"]
    assert not fertility.rules(empty, *files).count()


def test_verdicts_against_plain_bands(spark, files):
    """Bands of each language and length from exact quartiles; copies count once."""
    r = random.Random(3)
    texts = [prose(r, r.randrange(55, 125)) for _ in range(400)]
    texts += [texts[0]] * 300 + [" ".join(r.choice(["aa", "zq", "xk"]) + str(r.randrange(9)) for _ in range(r.randrange(60, 120))) for _ in range(5)]
    table = fertility.measured(spark.createDataFrame(rows(texts, ("en", "de")), DOCS), *files)
    found = {x["doc_id"]: x for x in fertility.judge(table, len(files[0])).collect()}
    length = lambda x: int(math.log2(x["n_tokens"][0]))
    value = lambda x, m, k: x[m][k]
    groups, lengths = {}, {}
    for x in found.values():
        if not x["base_failed"]:
            own = tuple(value(x, m, k) for m in fertility.MEASURES for k in range(2))
            groups.setdefault((x["group"], length(x)), set()).add(own)
            lengths.setdefault(length(x), set()).add((x["group"], own))
    for x in found.values():
        own = groups.get((x["group"], length(x)), set())
        if len(own) < fertility.LEAST:
            own = [o for _, o in lengths.get(length(x), set())]
        outside = []
        for i, m in enumerate(fertility.MEASURES):
            verdicts = []
            for k in range(2):
                if len(own) < fertility.LEAST:
                    verdicts.append(False)
                    continue
                v = sorted(o[2 * i + k] for o in own)
                q = [v[math.ceil(p * len(v)) - 1] for p in (0.25, 0.5, 0.75)]
                reach = max(fertility.REACH * (q[2] - q[0]), fertility.LEAST_REACH * q[1])
                high = value(x, m, k) > q[2] + reach
                verdicts.append(high and value(x, m, k) > fertility.FREE_BYTES if m == "byte_share" else high or value(x, m, k) < q[0] - reach)
            if all(verdicts):
                outside.append(m)
        assert x["outside"] == outside
        assert x["kept"] == (not x["base_failed"] and not outside)
    assert not any(found[k]["kept"] for k in range(700, 705))


@given(st.lists(st.integers(0, 3), max_size=40), st.sampled_from([0, 1_000_000, 3_000_000]))
def test_repeated_words(codes, shift):
    windows = Counter(zip(codes, codes[1:], codes[2:], strict=False))
    inside = {i + j for i in range(len(codes) - 2) if windows[tuple(codes[i : i + 3])] > 1 for j in range(3)}
    assert fertility.repeated_words(np.array(codes, dtype=np.int64) + shift) == len(inside)


def test_scripts():
    assert fertility.script("Straße 12") == "LATIN"
    assert fertility.script("привет ab") == "CYRILLIC"
    assert fertility.script("日本 a") == "CJK"
    assert fertility.script("12 .") == "NONE"


def test_very_long_words_and_texts(spark, files):
    texts = ["a" * 300_000, "日" * 100_000, "ab cd " * 300_000]
    found = {x["doc_id"]: x for x in fertility.rules(spark.createDataFrame(rows(texts), DOCS), *files).collect()}
    assert [found[k]["n_words"] for k in range(3)] == [1, 1, 600_000] and found[2]["n_repeat_words"] == 600_000
