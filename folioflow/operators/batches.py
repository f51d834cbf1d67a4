"""Batches of requests: which are pending, which are orphaned, and their markers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BATCH_HOURS, DEAD_STATUSES, LIVE_STATUSES
from .routing import batch_files, documents_info, request_line

STATUS = "batch_id string, status string, created_at long, completed_at long, failed_at long, total int, completed int, failed int, output_file_id string, error_file_id string, message string"


class Service(Protocol):
    """A batch service. Methods may raise; they are called on executors (status) and on the driver (submit)."""

    def submit(self, path: str, project: str, part: int) -> str: ...

    def status(self, batch_id: str) -> dict: ...


def submit(made: DataFrame, service: Service, path: str, stamp: Column | None = None) -> DataFrame:
    """Writes requests (of routing.requests) and submits them: batch_id, project_name, status, created_at, manifest of documents.

    Every project's lines are cut into batches that the service takes and written below path by project and
    part; the driver only sees one row per batch. A project without requests has no batch.
    """
    spark = made.sparkSession
    parts = batch_files(made).groupBy("project_name").agg(F.count("*").alias("n_parts"))
    # a hash deals a project's requests over its batches, one more than needed, so that none is overfull
    some = F.when(F.col("n_parts") > 1, F.col("n_parts") + F.ceil(F.col("n_parts") / 20)).otherwise(1)
    numbered = made.join(parts, "project_name").withColumn("part", F.pmod(F.xxhash64("custom_id"), some))
    numbered.select("project_name", "part", request_line().alias("value")).write.mode("overwrite").partitionBy("project_name", "part").text(f"{path}/requests")
    written = spark.read.schema("value string, project_name string, part long").text(f"{path}/requests").groupBy("project_name", "part").count().orderBy("project_name", "part").collect()  # one row per batch
    rows = [(service.submit(f"{path}/requests/project_name={r['project_name']}/part={r['part']}", r["project_name"], r["part"]), r["project_name"], int(r["part"]), r["count"]) for r in written]
    infos = spark.createDataFrame(rows, "batch_id string, project_name string, part long, n_requests long")
    docs = documents_info(made).groupBy("project_name").agg(F.count("*").alias("n_documents"))
    return infos.join(docs, "project_name").withColumn("status", F.lit("submitted")).withColumn("created_at", F.current_timestamp() if stamp is None else stamp).withColumn("completion_window", F.lit(f"{BATCH_HOURS}h"))


def pending_changes(infos: DataFrame) -> DataFrame:
    """State rows of submitted projects: pending, with their last batch."""
    return infos.groupBy("project_name").agg(F.max("batch_id").alias("jobBatchId")).select(F.col("project_name").alias("id"), F.col("project_name").alias("folderName"), F.lit(True).alias("isBatchPending"), "jobBatchId")


def status(infos: DataFrame, service: Service) -> DataFrame:
    """STATUS of each batch, asked by executors. A request that fails is the status "error"; counts that a service
    doesn't give are 0."""

    def ask(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [x.split() for x in STATUS.split(", ")]
        schema = pa.schema([(name, {"long": pa.int64(), "int": pa.int32()}.get(kind, pa.string())) for name, kind in fields])
        for frame in found:
            rows = []
            for batch in frame.column("batch_id").to_pylist():
                try:
                    answer = service.status(batch)
                    counts = answer.get("request_counts") or {}
                    row = {**{k: answer.get(k) for k in schema.names}, **{k: int(counts.get(k) or 0) for k in ("total", "completed", "failed")}}
                except Exception as e:  # noqa: BLE001 the service's failure is data
                    row = {"status": "error", "message": f"{type(e).__name__}: {e}", "total": 0, "completed": 0, "failed": 0}
                rows.append({**row, "batch_id": batch})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return infos.select("batch_id").distinct().mapInArrow(ask, STATUS)


def is_batch_info(name: Column | str) -> Column:
    return F.contains(name, F.lit("batch_info_")) & F.endswith(name, F.lit(".json"))


def project_of(path: Column | str, stated: Column | str | None = None) -> Column:
    """The stated project, else the path's second segment."""
    inferred = F.get(F.split(path, "/"), F.lit(1))
    return inferred if stated is None else F.coalesce(stated, inferred)


def latest_info(infos: DataFrame, order: str = "created_at") -> DataFrame:
    """One row per batch: the file written last."""
    rest = [c for c in infos.columns if c != "batch_id"]
    return infos.groupBy("batch_id").agg(F.max_by(F.struct(*rest), order).alias("i")).select("batch_id", "i.*")


def with_status(infos: DataFrame, status: DataFrame) -> DataFrame:
    """status: batch_id, status. A batch without an answer is in error."""
    return infos.drop("status").join(status.select("batch_id", "status"), "batch_id", "left").withColumn("status", F.coalesce("status", F.lit("error")))


def without_marker(infos: DataFrame, markers: DataFrame) -> DataFrame:
    return infos.join(markers.select("batch_id"), "batch_id", "left_anti")


def live(infos: DataFrame, markers: DataFrame, folders: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """Batches in flight, and completed ones without a marker; of pending folders only, if any are given.

    An empty list of folders means all of them; compat takes it literally.
    """
    found = infos.where(F.col("status").isin(*LIVE_STATUSES))
    if folders is not None:
        names = folders.select(F.col("folderName").alias("project_name")).distinct()
        if compat or names.limit(1).count():
            found = found.join(names, "project_name", "left_semi")
    marked = markers.select("batch_id").withColumn("marked", F.lit(True))
    return found.join(marked, "batch_id", "left").where((F.col("status") != "completed") | F.col("marked").isNull()).drop("marked")


def orphans(infos: DataFrame, markers: DataFrame) -> DataFrame:
    """Completed batches without a marker, in any folder."""
    return without_marker(infos.where("status = 'completed'"), markers)


def pending(infos: DataFrame, status: DataFrame, markers: DataFrame, folders: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """batch_id, project_name, status, is_orphaned and the other fields of the infos: live and orphaned batches, each once. Both kinds
    are rows of the same latest infos, so no field has to be merged."""
    known = with_status(latest_info(infos), status)
    a = live(known, markers, folders, compat).select("batch_id", F.lit(True).alias("is_live"))
    b = orphans(known, markers).select("batch_id", F.lit(True).alias("is_orphaned"))
    met = known.join(a, "batch_id", "left").join(b, "batch_id", "left").where("is_live or is_orphaned")
    rest = [c for c in known.columns if c not in ("batch_id", "project_name", "status")]
    return met.select("batch_id", "project_name", "status", F.coalesce("is_orphaned", F.lit(False)).alias("is_orphaned"), *rest)


def dead(infos: DataFrame, status: DataFrame) -> DataFrame:
    """Batches that have ended without a result."""
    return with_status(latest_info(infos), status).where(F.col("status").isin(*DEAD_STATUSES, "error"))


def dispatch_counts(batches: DataFrame) -> DataFrame:
    s = F.col("status")
    return batches.agg(F.count("*").alias("batches"), F.count_if(s == "completed").alias("completed"), F.count_if(s.isin("validating", "in_progress", "finalizing")).alias("in_flight"), F.count_if(~s.isin(*LIVE_STATUSES)).alias("other"))


def markers_of(statistics: DataFrame, stamp: Column | None = None) -> DataFrame:
    return statistics.withColumn("processed_at", F.current_timestamp() if stamp is None else stamp)


def folder_changes(statistics: DataFrame, stamp: Column) -> DataFrame:
    """State rows of processed folders: no longer pending, with their last statistics."""
    return statistics.select(
        F.col("project_name").alias("id"), F.col("project_name").alias("folderName"), F.lit(False).alias("isBatchPending"), F.col("batch_id").alias("lastProcessedBatchId"), stamp.cast("string").alias("processedAt"),
        F.struct(F.col("total").alias("total_processed"), F.col("successful").alias("successful_responses"), F.col("failed").alias("failed_responses"), "success_rate").alias("lastStats"),
    )


def expired(infos: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Batches older than the service's completion window."""
    return infos.where(F.col("created_at") < now - F.expr(f"interval {hours} hours"))


def missing_types(files: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Per project the required result files that it lacks."""
    have = files.groupBy("project_name").agg(F.collect_set("document_name").alias("have"))
    lacking = F.array_except(F.array(*map(F.lit, required)), "have")
    return have.select("project_name", lacking.alias("missing"), (F.size(lacking) == 0).alias("complete"))


def wait(status_of: Callable[[], str], minutes: float = 60, every: float = 30, sleep: Callable[[float], None] | None = None, clock: Callable[[], float] | None = None) -> str:
    """Polls until a batch has ended or time is up ("timeout")."""
    import time

    sleep, clock = sleep or time.sleep, clock or time.monotonic
    end = clock() + 60 * minutes
    while clock() < end:
        status = status_of()
        if status == "completed" or status in DEAD_STATUSES:
            return status
        sleep(every)
    return "timeout"
