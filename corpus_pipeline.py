"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as
Parquet and reads again as the next stage's docs. All but the last return the columns of
documents; the last returns the packed pieces.

A stage that drops documents finds the ids to drop first and joins them away, so texts
are shuffled only when those ids are too many to broadcast. Rows with a null id are never
dropped; rows that repeat an id share its fate, and near_duplicates keeps one of them, the least by a digest of
its columns. Null and empty texts are neither rejected nor duplicates; they are packed as the closing id alone.
Empty tables give empty results. Columns of any other name are carried along by all stages but the last.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import importance, minhash, mixing, packing, pii
from folioflow.llm.common import delete, discard_since, release, shared_dir, stage, staged, with_ids
from folioflow.llm.queries import MIX_POWER, tokenizer_file
from folioflow.sources.staging import spread

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs whose id is not among ids (doc_id, not null)."""
    return with_ids(docs, ids.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what importance resampling towards the documents labelled as good doesn't draw."""
    drawn = importance.resample(docs, importance.good_ids(_table(spark, sf_dir, "labels")))
    return _without(docs, drawn.where("not kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates, once."""
    found = minhash.near_duplicates(docs, shingle=5, percent=80, n_bands=30)
    out = _without(docs, found.where("not kept"))
    repeated = stage(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.limit(1).count():
        return out
    rest = [c for c in docs.columns if c != "doc_id"]
    # maps and variants have no order, so the row whose JSON has the least digest stays
    digest = F.sha2(F.to_json(F.struct(*rest)), 256)
    once = with_ids(out, repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*rest), digest).alias("row"))
    return with_ids(out, repeated, "doc_id", "left_anti").unionByName(once.select("doc_id", *[F.col("row")[c].alias(c) for c in rest]).select(*docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that the sources' expected tokens meet tempered targets; none is dropped."""
    labelled = with_ids(docs, _table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return mixing.apply(docs, mixing.mix(docs, mixing.fit(labelled, "source"), None, MIX_POWER, least=1.0))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents and their places in sequences."""
    return packing.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", packed),
]

#: No stage but the last could be told in SQL, so the whole is tested against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's table goes to the shared folder. What a stage has staged, and the
    table that it read, are deleted once its own table is written."""
    base = f"{shared_dir(spark)}/folioflow/pipeline-{uuid.uuid4().hex}"
    docs, last = spread(_table(spark, sf_dir, "documents")), None
    for k, (name, step) in enumerate(STAGES):
        path, mark = f"{base}/{k}-{name}", staged()
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        discard_since(spark, mark)
        if last:
            delete(spark, last)
        last = path
        release(spark)
    return docs.select([F.col(c) for c in docs.columns])
