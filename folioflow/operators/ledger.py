"""Submission of request batches once each, whatever fails in between.

A project's request lines are cut into shards by a hash, and each shard is named by a digest of its lines: the same
requests always make the same shards. Lines are written below their shard's name. A ledger lists the shards that a
service has confirmed; only others are submitted, by executors, in waves, each of which is one published epoch of
the ledger. A shard that was submitted in a wave which died before it was published is found at the service by its
name, so nothing is submitted twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BATCH_HOURS
from ..sources.epochs import Epochs
from ..sources.staging import staged
from . import routing

LEDGER = "shard string, project_name string, part long, n_requests long, batch_id string, input_file_id string, status string, found boolean, error string"
#: Shards that one wave submits at most, and how many one task does.
WAVE, PER_TASK = 1_000, 4


class Desk(Protocol):
    """A batch service that can be asked for what it has. Called on executors; methods may raise."""

    def find(self, shard: str) -> dict | None: ...

    def submit(self, shard: str, path: str, project: str) -> dict: ...


def shards(made: DataFrame) -> DataFrame:
    """made (of routing.requests) with part, shard and line: a shard's name is a digest of its lines, in any order."""
    parts = routing.batch_files(made).groupBy("project_name").agg(F.count("*").alias("n_parts"))
    some = F.when(F.col("n_parts") > 1, F.col("n_parts") + F.ceil(F.col("n_parts") / 20)).otherwise(1)
    lines = made.join(parts, "project_name").select("project_name", F.pmod(F.xxhash64("custom_id"), some).alias("part"), routing.request_line().alias("value"))
    h = [F.xxhash64(F.lit(k), "value").cast("decimal(38,0)") for k in range(2)]
    names = lines.groupBy("project_name", "part").agg(F.count("*").alias("n_requests"), *[F.sum(x).cast("string").alias(f"h{k}") for k, x in enumerate(h)])
    shard = F.left(F.sha2(F.concat_ws("|", "project_name", "part", "n_requests", "h0", "h1"), 256), F.lit(32))
    return lines.join(names.select("project_name", "part", "n_requests", shard.alias("shard")), ["project_name", "part"])


def submit(made: DataFrame, desk: Desk, path: str, wave: int = WAVE) -> DataFrame:
    """Submits what the ledger below `path` doesn't hold yet, and returns its confirmed shards (LEDGER). Shards whose submission
    raised are kept with their error and tried again by the next call."""
    spark = made.sparkSession
    ledger = Epochs(spark, f"{path}/ledger")
    known = lambda: ledger.read("shards", LEDGER).where("error is null")
    cut = staged(shards(made), "shards")
    new = cut.join(known().select("shard").distinct(), "shard", "left_anti")
    run = f"{path}/requests/run={len(ledger.published())}"
    new.select("shard", "value").write.mode("overwrite").partitionBy("shard").text(run)
    todo = new.groupBy("shard", "project_name", "part").agg(F.max("n_requests").alias("n_requests")).withColumn("path", F.concat(F.lit(f"{run}/shard="), "shard"))
    todo = staged(todo.withColumn("at", F.floor((F.row_number().over(Window.orderBy("shard")) - 1) / wave)), "todo")  # a row per batch of up to 50,000 requests
    schema = pa.schema([(n, {"long": pa.int64(), "boolean": pa.bool_()}.get(k, pa.string())) for n, k in (x.split() for x in LEDGER.split(", "))])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = {k: row[k] for k in ("shard", "project_name", "part", "n_requests")} | {"found": False}
                try:
                    answer = desk.find(row["shard"])
                    out["found"] = answer is not None
                    answer = answer or desk.submit(row["shard"], row["path"], row["project_name"])
                    out |= {k: answer.get(k) for k in ("batch_id", "input_file_id", "status")}
                except Exception as e:  # noqa: BLE001 the service's failure is data
                    out["error"] = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pylist([out], schema)

    for k in range((todo.agg(F.max("at")).first()[0] or 0) + 1 if todo.limit(1).count() else 0):
        now = todo.where(F.col("at") == k).drop("at")
        tasks = max(1, -(-now.count() // PER_TASK))
        ledger.write((ledger.published() or [-1])[-1] + 1, {"shards": now.repartition(tasks, "shard").mapInArrow(ask, LEDGER)})
    return known()


def batch_infos(confirmed: DataFrame, made: DataFrame, stamp: Column | None = None) -> DataFrame:
    """What is kept of every batch: batch_id, project_name, input_file_id, created_at, status, total_requests, documents_info, completion_window.
    documents_info lists the documents that have a request in it."""
    at = (F.current_timestamp() if stamp is None else stamp).cast("string")
    of = shards(made).select("shard", F.get_json_object("value", "$.custom_id").alias("custom_id"))
    docs = made.join(of, "custom_id").groupBy("shard", "document_name", "prefix").agg(F.transform(F.array_sort(F.collect_set(F.struct("prompt_number", "prompt_type"))), lambda x: x["prompt_type"]).alias("prompts_applied"))
    one = F.struct("document_name", routing.document_type("document_name").alias("document_type"), routing.subfolder("document_name").alias("subfolder"), "prefix", "prompts_applied", at.alias("processed_at"))
    listed = docs.groupBy("shard").agg(F.array_sort(F.collect_list(one)).alias("documents_info"))  # at most one per request of a batch
    rows = confirmed.join(listed, "shard")
    return rows.select("batch_id", "project_name", "input_file_id", at.alias("created_at"), "status", F.col("n_requests").alias("total_requests"), "documents_info", F.lit(f"{BATCH_HOURS}h").alias("completion_window"))
