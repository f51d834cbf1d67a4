"""Chunking, recovery and rules against hand-written cases and properties."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.config import EngineConfig
from folioflow.functions import recovery, tokens
from folioflow.operators import chunking, rules
from folioflow.operators.chunking import Packer, chunk_text, split_sections

WORDS = st.lists(st.sampled_from(["uno", "dos.", "Tres", "cuatro,", "Cinco!", "seis"]), min_size=1, max_size=60).map(" ".join)


def words(n, w="a"):
    return " ".join([w] * n)


def test_budget_is_inclusive():
    assert len(chunk_text(words(10), EngineConfig(max_tokens=10))) == 1
    assert len(chunk_text(words(11), EngineConfig(max_tokens=10))) == 2


def test_overlap_leads_the_next_chunk():
    out = Packer(100, 10).pack([words(40, "a"), words(40, "b"), words(40, "c")])
    assert [c["tokens"] for c in out] == [80, 50]
    assert out[1]["content"].startswith(words(10, "b")) and out[1]["sections_range"] == "Hasta sección 2"


def test_overlap_is_cut_to_what_fits():
    out = Packer(100, 10).pack([words(100, "a"), words(97, "b")])
    assert [c["tokens"] for c in out] == [100, 100] and out[1]["content"].startswith(words(3, "a"))


def test_large_section_between_small_ones():
    out = Packer(20, 5).pack([words(5), "\n\n".join([words(15, "b"), words(15, "c")]), words(5, "d")])
    assert [c["index"] for c in out] == list(range(len(out))) and all(c["tokens"] <= 20 for c in out)
    assert out[0]["content"] == words(5) and out[-1]["content"] == words(5, "d")


def test_compat_restarts_indices():
    big = "\n\n".join([words(15, "b"), words(15, "c")])
    assert [c["index"] for c in Packer(20, 0, compat=True).pack([big, big])] == [0, 1, 0, 1]


def test_section_headings_keep_their_own_separator():
    text = "x\n\n# Uno\ny\n\n## Dos\nz"
    pattern = (r"\n\n#{1,3}\s+",)
    assert split_sections(text, pattern) == ["x", "# Uno\ny", "## Dos\nz"]
    assert split_sections(text, pattern, compat=True) == ["x", "# Uno\ny", "# Dos\nz"]


@settings(max_examples=40, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=8), st.integers(8, 40), st.integers(0, 6))
def test_chunks_hold_all_text_within_budget(parts, limit, overlap):
    out = Packer(limit, overlap).pack(parts)
    assert all(c["tokens"] <= limit == c["tokens"] or c["tokens"] <= limit for c in out)
    assert [c["index"] for c in out] == list(range(len(out)))
    seen = "".join("".join(c["content"].split()) for c in out)
    if overlap == 0:
        assert seen == "".join("".join(p.split()) for p in parts)


def test_spark_chunks_equal_python(spark):
    cfg = EngineConfig(max_tokens=20, overlap_tokens=4, section_patterns=(r"\n",))
    texts = ["", "a b c", "\n".join(words(9, w) for w in "abcdef"), None, words(75)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, content string")
    got = {r["id"]: [c.asDict() for c in r["chunks"]] for r in chunking.chunk(df, cfg).collect() if r["content"] is not None}
    for i, t in enumerate(texts):
        if t is not None:
            assert got[str(i)] == chunk_text(t, cfg)


def test_sentences(spark):
    got = spark.createDataFrame([("Uno. Dos? ¿Tres? 4 si. no",)], "t string").select(chunking.sentences("t")).first()[0]
    assert got == ["Uno.", "Dos?", "¿Tres?", "4 si. no"]


def test_token_tail():
    assert tokens.tail("uno dos, tres", 2) == ", tres" and tokens.tail("uno", 5) == "uno" and tokens.tail("uno", 0) == ""


RECOVERED = {
    '```json\n{"a":1}\n```': [{"a": 1}],
    '[{"a":1},{"b":2}]': [{"a": 1}, {"b": 2}],
    '{"a":1}{"b":2}': [{"a": 1}, {"b": 2}],
    'Aquí está: {"a":"}{"} fin': [{"a": "}{"}],
    '{"a":"x\\"}"}': [{"a": 'x"}'}],
    '[{"a":1},{"a":2},{"a":': [{"a": 1}, {"a": 2}],
    '{"a":1,}': [{"a": 1}],
    '} {"a":1}': [{"a": 1}],
    "[1,2]": [],
    "text": [],
    "": [],
    '{"a":1,"a":2}': [{"a": 2}],
    '{"a":NaN}': [{"a": None}],
}


def test_recovery():
    for text, want in RECOVERED.items():
        assert recovery.objects(text) == want, text
    assert recovery.objects('} {"a":1}', compat=True) in ([], [{"a": 1}])
    assert recovery.repair('{"a":"b') == '{"a":"b"}' and recovery.repair('{"a":[1,2,') == '{"a":[1,2}]'


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text(max_size=5), st.one_of(st.integers(), st.text(max_size=8), st.none()), max_size=4))
def test_recovery_is_identity_on_objects(value):
    assert recovery.objects(json.dumps(value)) == [value]


def test_phrases(spark):
    df = spark.createDataFrame([("Sin salvedades",), ("excepto por",), ("hubo incumplimiento",), ("",)], "t string")
    assert [r[0] for r in df.select(rules.opinion("t")).collect()] == ["Favorable", "Favorable con reservas", "Desfavorable", "no se menciona"]
    df = spark.createDataFrame([("fue entregado",), ("no entregado",), ("no aplica",), ("en trámite",), ("x",)], "t string")
    assert [r[0] for r in df.select(rules.report_status("t")).collect()] == ["Disponible", "No disponible", "No requerido", "Pendiente", None]


def test_goals_and_dates(spark):
    df = spark.createDataFrame([("230 km",), ("1.500 personas",), ("100%",), ("2,5 ha",), ("1,500 personas",)], "t string")
    n, u = rules.goal("t")
    assert [tuple(r) for r in df.select(n, u).collect()] == [(230.0, "km"), (1500.0, "personas"), (100.0, "%"), (2.5, "ha"), (1500.0, "personas")]
    d = spark.createDataFrame([("Q1 2025",), ("2026",), ("2025-03-14",), ("?",)], "t string").select(rules.partial_date(F.col("t")).alias("d")).select("d.granularity", "d.start").collect()
    assert [(r[0], str(r[1])) for r in d] == [("quarter", "2025-01-01"), ("year", "2026-01-01"), ("day", "2025-03-14"), (None, "None")]


@pytest.mark.parametrize("text", ["[" * 200_000, '{"a":' * 200_000, '{"a":' * 900 + "1" + "}" * 900, '```json\n' + "[{" * 100_000])
def test_deep_nesting_ends(spark, text):
    """Text nested beyond DEPTH is no JSON and raises nothing; up to it, it is read."""
    rows = spark.createDataFrame([(text,)], "value string")
    found = recovery.recovered(rows, "value", "objects").select("objects", recovery.extract_json("value").alias("x")).first()
    assert found["objects"] == ([text] if len(text) < 10_000 else []) and found["x"] is not None
    assert recovery.too_deep(text) == (len(text) > 10_000)


def test_strings_dont_nest():
    assert not recovery.too_deep('{"a": "' + "[" * 5000 + '"}') and recovery.objects('{"a": "' + "[" * 5000 + '"}') == [{"a": "[" * 5000}]


def test_one_count_for_all_white_space(spark):
    from folioflow.functions import tokens
    from folioflow.operators import chunking

    spaces = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    texts = [f"a{s}b,{s}{s}c." for s in spaces] + ["word " * 120 + "　x" * 81, "²½ Ⅷ ñ_é 日本　語"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, content string")
    for r in rows.select("i", tokens.count_tokens("content").alias("n")).collect():
        assert r["n"] == tokens.count(texts[r["i"]]), ascii(texts[r["i"]])
    for r in chunking.chunk(rows, EngineConfig(max_tokens=201, overlap_tokens=0)).collect():
        assert not r["requires_chunking"] and r["chunks"][0]["sections_range"] == chunking.WHOLE


def test_balanced_parts_in_the_jvm_equal_python(spark):
    """Random marks, escapes and strings; and whole texts of several objects, fenced or not."""
    import random

    r = random.Random(7)
    texts = ["".join(r.choice(['"', "{", "}", "\\", "a", '{"k": "v"}', " ", "\n", "é", '"}', "[", ",", '{"a": {"b": "}{"}}', '\\"']) for _ in range(r.randrange(0, 14))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    for x in rows.select("i", recovery.balanced_parts(F.col("value")).alias("p")).collect():
        assert x["p"] == list(recovery.balanced(texts[x["i"]])), texts[x["i"]]
    bits = ['{"a": 1}', '{"b": [1, {"c": "x}"}]}', "words", "```json\n", "```", "\n", '{"d": "\\""}', '{"cut": [1,', "[1, 2]", "{}", '{"n": NaN}', '{"k":1,"k":2}', "　"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(1, 6))) for _ in range(600)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    for x in recovery.recovered(rows, "value", "found").collect():
        assert x["found"] == [recovery.canonical(o) for o in recovery.objects(texts[x["i"]])], texts[x["i"]]
