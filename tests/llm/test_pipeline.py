"""The pipeline against its stages by brute force, and the registered queries."""

from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from conftest import DATA

from folioflow.llm import common, pii, queries


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)} and set(queries.QUERIES) <= set(names)


@pytest.mark.parametrize("name", ["op2_importance", "op5_mixing", "op8_langid", "op9_toxicity", "op13_fertility"])
def test_one_row_per_document(spark, name):
    assert queries.QUERIES[name](spark, f"{DATA}/sf0.001").count() == spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").count()


def test_stages(spark, tmp_path):
    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        after = {r["doc_id"] for r in rows}
        if name == "quality":
            assert after < set(before) and len(after) > 0.6 * len(before)
        elif name == "near_duplicates":
            sets = {i: set(zip(*(t.encode().lower().split()[j:] for j in range(5)), strict=False)) or {t} for i, t in before.items()}
            ids = sorted(sets)
            forest = common.Forest(len(ids))
            for i in range(len(ids)):
                for j in range(i):
                    a, b = sets[ids[i]], sets[ids[j]]
                    if len(a & b) >= 0.8 * len(a | b):
                        forest.join(i, j)
            assert after == {ids[i] for i in range(len(ids)) if forest.find(i) == i}
        elif name == "personal_data":
            assert after == set(before) and not any(pii.base_spans(r["text"]) for r in rows)
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "source_mix":
            assert after == set(before) and len(rows) > len(after)
        else:
            assert after == set(before) and all(r["offset"] + r["length"] <= 4096 for r in rows)


ODD = "doc_id long, text string, lang string, source string, n_chars long, key string, noise double, component_id long, part int, u long, pii_extra string, mix_u double"


def odd_rows():
    base = " ".join(f"w{k % 37} x{k % 11}" for k in range(60))
    long = " ".join(f"v{k * k % 9973}" for k in range(60_000))
    texts = [base, base, base + " end", None, "", "one", "mail me: a.b@example.org or 10.0.0.1", long, " ".join(f"z{k}" for k in range(90))]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None if t is None else len(t), "k", 1.0, 7, 1, 2, "p", 0.5) for i, t in enumerate(texts)]
    return [*rows, rows[6], (None, texts[8], None, None, None, None, None, None, None, None, None, None), (20, "first text of an id", "en", "s0", 19, *[None] * 7), (20, "second text of an id", "en", "s0", 20, *[None] * 7)]


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("odd")
    spark.createDataFrame(odd_rows(), ODD).repartition(3).write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(9)] + [(None, 1, 0), (5, None, None), (5, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
    return str(at)


def test_stages_take_odd_rows(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, odd_dir).collect()
        ids = Counter(r["doc_id"] for r in rows)
        if name == "packing":
            assert set(ids) == {r[0] for r in odd_rows()} and sum(r["length"] for r in rows if r["doc_id"] in (3, 4)) == 2  # the closing id alone
            continue
        assert list(rows[0].asDict()) == docs.columns
        kept = {(r["doc_id"], r["text"]) for r in rows}
        if name == "quality":
            assert {(3, None), (4, ""), (None, odd_rows()[8][1])} <= kept
        elif name == "near_duplicates":
            assert set(ids) == {None, 0, 3, 4, 5, 6, 7, 8, 20} and max(ids.values()) == 1 and sum(i == 20 for i, _ in kept) == 1 and (2, docs.where("doc_id = 2").first()["text"]) not in kept
        elif name == "personal_data":
            assert ids == Counter(r[0] for r in odd_rows()) and (6, "mail me: [EMAIL] or [IP]") in kept and (3, None) in kept and {t for i, t in kept if i == 20} == {"first text of an id", "second text of an id"}
        else:
            assert set(ids) == {r[0] for r in odd_rows()}


def test_stages_carry_maps_and_long_texts(spark, odd_dir, tmp_path):
    """Columns without an order are carried through all stages, repeated ids and very long texts included."""
    long = " ".join(f"v{k % 40_000}" for k in range(400_000))
    rows = [(1, "a b c d e f", {"x": 1}), (1, "g h i j k l", {"x": 2, "y": 3}), (2, long, None), (3, "nul \x00 byte and a word", {}), (None, None, {"z": 0})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars", "extra", "parse_json(to_json(extra)) AS v")
    docs.write.parquet(str(tmp_path / "0"))
    docs = spark.read.parquet(str(tmp_path / "0"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1], 1):
        stage(spark, docs, odd_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "v"]
        if name == "near_duplicates":
            assert sorted(r[0] or 0 for r in docs.select("doc_id").collect()) == [0, 1, 2, 3]
    assert {len(r["text"] or "") for r in docs.collect()} >= {0, len(long)} and all(r["extra"] for r in docs.where("doc_id = 1").collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, odd_dir)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {None, 1, 2, 3}


def test_stages_take_empty_tables(spark, odd_dir, tmp_path):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").limit(0)
    spark.read.parquet(f"{odd_dir}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        for sf in (odd_dir, str(tmp_path)):
            assert stage(spark, docs, sf).count() == 0


def test_run_deletes_what_it_staged(spark, odd_dir):
    mark = common.staged()
    out = corpus_pipeline.run(spark, odd_dir)
    assert out.count() > 0 and common.staged() == mark


def test_run(spark):
    assert corpus_pipeline.run(spark, f"{DATA}/sf0.001").count() > 0
