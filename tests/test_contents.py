"""Contents by type: whole lists in order, as rows with their places."""

import hashlib
import os
import random

import duckdb
from conftest import DATA

from folioflow.operators import results
from folioflow.plans.catalog import QUERIES

SF = f"{DATA}/sf0.001"
# Lists as single values: number and digest of each type's contents in the order of their ids.
LISTS = """WITH r AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'auditoria' WHEN 1 THEN 'productos' WHEN 2 THEN 'desembolsos' END AS prompt_type FROM documents WHERE doc_id % 10 <> 9) SELECT prompt_type, count(*) AS n, md5(string_agg('{"a":' || doc_id || '}', ',' ORDER BY custom_id)) AS digest FROM (SELECT *, 'PRJ' || (doc_id % 10) || '_IXP-' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '_chunk_002' ELSE '' END || '_prompt' || (doc_id % 4 + 1) AS custom_id FROM r) WHERE prompt_type IS NOT NULL GROUP BY ALL"""


def lists(rows):
    """The contents of each type by their places, which have to be 1 to n."""
    out = {}
    for r in rows:
        out.setdefault(r["prompt_type"], []).append((r["position"], r["content"], r["n"]))
    for kind, x in out.items():
        x.sort()
        assert [p for p, _, _ in x] == list(range(1, len(x) + 1)) and {n for _, _, n in x} == {len(x)}
        out[kind] = [c for _, c, _ in x]
    return out


def test_query_gives_whole_ordered_lists(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(SF, 'documents.parquet')}'")
    got = {k: (len(v), hashlib.md5(",".join(v).encode()).hexdigest()) for k, v in lists(QUERIES["contents_by_type"](spark, SF).collect()).items()}
    assert len(got) == 3 and got == {k: (n, d) for k, n, d in duck.sql(LISTS).fetchall()}


def test_places_of_odd_responses(spark):
    """One type has most rows; ids come twice, with the same and with other contents; texts without JSON, cut ones, failures, unknown ids."""
    r = random.Random(3)
    shapes = ['```json\n{"a":%d}\n```', '{"a":%d', "words %d", '[{"a":%d},', "é\U0001f600 %d"]
    rows = [(f"P{k % 7}_IXP-{r.randrange(900)}_prompt{1 if k % 10 else k % 30 // 10 + 1}", r.choice(shapes) % r.randrange(5), None) for k in range(1200)]
    rows += rows[:50] + [("P_é_prompt2", "x", None), ("P_\U0001f600_prompt2", "y", None), ("P_￿_prompt2", "z", None)]
    bad = [("P_a_prompt1", "", None), ("P_a_prompt1", None, None), ("P_a_prompt1", "x", "status 500"), ("P_a_prompt9", "x", None), ("P", "x", None), (None, "x", None)]
    from folioflow.functions.recovery import extract

    want = {}
    for i, c, _ in rows:
        want.setdefault(results.TYPES[int(i[-1]) - 1], []).append((i.encode(), extract(c).encode()))
    want = {k: [c.decode() for _, c in sorted(v)] for k, v in want.items()}
    assert len(want) == 3 and max(map(len, want.values())) > 1000
    df = spark.createDataFrame(rows + bad, "custom_id string, content string, error string").repartition(5)
    assert lists(results.contents_by_type(df).collect()) == want
