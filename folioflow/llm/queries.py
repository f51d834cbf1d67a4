"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import spread
from . import fertility, impacts, importance, langid, lattice, minhash, mixing, packing, pii, spotsigs, suffixes, toxicity, whitening
from .common import with_ids

#: The sources' target weights for op5 are their own shares to this power, which raises the small ones.
MIX_POWER = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def vocabulary_files() -> tuple[list[str], str]:
    """Vocabularies for the tokeniser's quality rules and the pattern of the rank files; FOLIOFLOW_VOCABULARIES names other ones (comma-joined)."""
    import public_tokenizers

    files = os.environ.get("FOLIOFLOW_VOCABULARIES")
    return files.split(",") if files else [public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken")], public_tokenizers.PATTERN


def tokenizer_file() -> str:
    """Vocabulary for packing; FOLIOFLOW_TOKENIZER names another file."""
    if path := os.environ.get("FOLIOFLOW_TOKENIZER"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.98)


def op2_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), importance.good_ids(_table(spark, sf_dir, "labels")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.extract(_table(spark, sf_dir, "documents")))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labelled = with_ids(docs, _table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return mixing.rated(docs, mixing.mix(docs, mixing.fit(labelled, "source"), None, MIX_POWER))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file())


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs.where(_remainder(4) != 2)), _remainder(4) == 2)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(_remainder(5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return toxicity.predict(docs, toxicity.fit(with_ids(docs.select("doc_id", "text"), labels, "doc_id", "inner")), _remainder(5) == 0)


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.stability(_table(spark, sf_dir, "documents"))


def op11_impacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impacts.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.rules(_table(spark, sf_dir, "documents"), *vocabulary_files())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lattice": op1_lattice,
    "op2_importance": op2_importance,
    "op3_pii": op3_pii,
    "op4_suffixes": op4_suffixes,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_minhash": op7_minhash,
    "op8_langid": op8_langid,
    "op9_toxicity": op9_toxicity,
    "op10_spotsigs": op10_spotsigs,
    "op11_impacts": op11_impacts,
    "op12_whitening": op12_whitening,
    "op13_fertility": op13_fertility,
}

ORACLES: dict[str, str] = {
    "op1_lattice": """WITH RECURSIVE v AS (SELECT DISTINCT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach AS (SELECT DISTINCT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), d AS (SELECT a, count(DISTINCT b) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, coalesce(c.component_id = e.vec_id, true) AS kept FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN d ON d.a = e.vec_id""",
    "op7_minhash": r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
e AS (SELECT DISTINCT doc_id, unnest(s) AS x FROM s), n AS (SELECT doc_id, count(*) AS n FROM e GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (SELECT DISTINCT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, coalesce(c.component_id = s.doc_id, true) AS kept FROM s LEFT JOIN c ON c.a = s.doc_id""",
    "op11_impacts": r"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, w, len(w) AS n FROM t WHERE len(w) > 0), s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d) GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)) GROUP BY ALL),
x AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(times * CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // l)))) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN f USING (term) CROSS JOIN s GROUP BY item_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM x WHERE score > 0) WHERE rank <= 10""",
}
