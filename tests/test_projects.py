"""Whole projects in ranges against the packer over their joined text."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow.config import EngineConfig
from folioflow.functions.running import running_sums
from folioflow.operators import chunking, layout, projects


def project(r, n_docs, long):
    docs = []
    for k in range(n_docs):
        lines = []
        for _ in range(r.randrange(1, 12)):
            words = [f"w{r.randrange(99)}" for _ in range(r.randrange(1, long))]
            lines.append(r.choice(["\n\n# Head\n", "\n\nUPPER CASE TITLE\n", "\n" + "=" * 60 + "\n", "\n\n", ". "]) + " ".join(words) + r.choice(["", ".", "\n", ". Next one"]))
        docs.append((f"INI-{k:04d}.pdf", "".join(lines)))
    return docs


@pytest.mark.parametrize("size,overlap,ranges", [(40, 0, 2), (40, 7, 2), (64, 30, 3), (40, 60, 4), (5000, 50, 16)])
def test_equals_the_packer_over_the_joined_text(spark, monkeypatch, size, overlap, ranges):
    monkeypatch.setattr(projects, "RANGE", ranges)
    r = random.Random(size + overlap)
    own = {"A": project(r, 60, 40), "B": project(r, 40, 90), "C": project(r, 1, 3), "D": [("INI-1.pdf", "")], "E": project(r, 30, 4), "F": [("INI-1.pdf", "x " * 3000), ("INI-2.pdf", "y. Z " * 50)]}
    rows = [(p, d, t, "success") for p, docs in own.items() for d, t in docs] + [("A", "IXP-9.pdf", "not taken", "error")]
    cfg = EngineConfig(max_tokens=size, overlap_tokens=overlap)
    parts = layout.corpus(spark.createDataFrame(rows, "project_name string, document_name string, content string, processing_status string").repartition(5))
    got = {}
    for x in projects.chunk_projects(parts, cfg).collect():
        got.setdefault(x["project_name"], []).append(x)
    joined = {}
    for x in sorted(parts.collect(), key=lambda x: (x["project_name"], x["part"])):
        joined[x["project_name"]] = joined.get(x["project_name"], "") + x["content"]
    assert set(got) == set(own)
    for p, text in joined.items():
        wanted = chunking.chunk_text(text, cfg)
        found = sorted(got[p], key=lambda x: x["chunk_index"])
        assert [(x["chunk_index"], x["content"], x["tokens"], x["sections_range"]) for x in found] == [(w["index"], w["content"], w["tokens"], w["sections_range"]) for w in wanted], p
        assert {x["total_chunks"] for x in found} == {len(wanted)} and found[0]["document_name"] == f"{p}_chunk_000" and found[0]["original_document"] == f"{p}_concatenated"


def test_running_sums(spark):
    rows = [("a" if i % 3 else "b", i, i % 7) for i in range(500)] + [("c", 1, 5)]
    got = running_sums(spark.createDataFrame(rows, "k string, i long, v long").repartition(6), ["k"], ["i"], ["v"]).collect()
    for x in got:
        assert x["before_v"] == sum(v for k, i, v in rows if k == x["k"] and i < x["i"])
    assert len(got) == len(rows)


def test_empty(spark):
    none = spark.createDataFrame([], "project_name string, part string, content string")
    assert projects.chunk_projects(none, EngineConfig()).count() == 0
    with pytest.raises(ValueError):
        projects.chunk_projects(none, EngineConfig(compat=True))
    assert projects.chunk_projects(none.union(spark.createDataFrame([("p", "", None)], none.schema)), EngineConfig()).select(F.count("*")).first()[0] == 1
