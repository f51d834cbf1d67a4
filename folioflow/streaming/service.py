"""A batch service as a stream: what its batches have come to, and the lines of their output and error files.

The source polls the service for the states of its batches. An offset is the number of the poll with the batches that
moved on since; a micro-batch has a partition for every output or error file of a batch that has ended, which an
executor downloads, and one for the other moves. `tick` turns such a stream into results: each micro-batch is one published
epoch of items, errors, statistics and markers, so a marker is never seen before its results.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..config import DEAD_STATUSES, EngineConfig
from ..operators import batches, results
from ..session import reachable
from ..sources.epochs import Epochs

LINES = "batch_id string, project_name string, status string, kind string, line long, value string"
#: A batch in these states moves no more.
ENDED = ("completed", *DEAD_STATUSES)


class Service(Protocol):
    """states: batches with batch_id, project_name, status, output_file_id, error_file_id. lines: of one of its files."""

    def states(self) -> list[dict]: ...

    def lines(self, file_id: str) -> Iterator[str]: ...


class FolderService:
    """A service replayed from a folder: batches.json lists states by poll, files/ holds the files. Every call of states takes the
    poll that the file `poll` names."""

    def __init__(self, folder: str):
        self.folder = Path(folder)

    def states(self) -> list[dict]:
        polls = json.loads((self.folder / "batches.json").read_text())
        at = self.folder / "poll"
        return polls[min(int(at.read_text()) if at.exists() else 0, len(polls) - 1)]

    def lines(self, file_id: str) -> Iterator[str]:
        with open(self.folder / "files" / file_id, encoding="utf-8") as f:
            yield from (x for line in f if (x := line.rstrip("\n")).strip())


def service_of(name: str, argument: str) -> Service:
    """package.module:Class, made of one argument."""
    module, _, kind = name.partition(":")
    return getattr(importlib.import_module(module), kind)(argument)


@dataclass
class File(InputPartition):
    """One file of an ended batch, or (without a file) a move."""

    batch_id: str
    project_name: str | None
    status: str
    kind: str
    file_id: str | None


class BatchServiceSource(DataSource):
    """spark.readStream.format("batch_service") with the options service (package.module:Class) and argument."""

    @classmethod
    def name(cls) -> str:
        return "batch_service"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> DataSourceStreamReader:
        return BatchServiceReader(self.options["service"], self.options.get("argument", ""))


class BatchServiceReader(DataSourceStreamReader):
    """Offsets are the states of the batches that the service lists, each as a JSON text of what a partition needs; so the range
    between two of them tells all work, and a restarted query does the same."""

    def __init__(self, service: str, argument: str):
        self.service, self.argument = service, argument

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for s in service_of(self.service, self.argument).states():
            ended = s["status"] in ENDED
            files = [s.get("output_file_id"), s.get("error_file_id")] if ended else [None, None]
            out[s["batch_id"]] = json.dumps([s["status"], s.get("project_name"), *files])
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for batch, now in sorted(end.items()):
            if start.get(batch) == now:
                continue
            status, project, output, errors = json.loads(now)
            out.append(File(batch, project, status, "move", None))
            out += [File(batch, project, status, kind, f) for kind, f in (("output", output), ("error", errors)) if f]
        return out

    def read(self, partition: File) -> Iterator[tuple]:
        p = partition
        if p.file_id is None:
            yield p.batch_id, p.project_name, p.status, p.kind, 0, None
            return
        for k, line in enumerate(service_of(self.service, self.argument).lines(p.file_id)):
            yield p.batch_id, p.project_name, p.status, p.kind, k, line


def moves(spark: SparkSession, service: str, argument: str = "") -> DataFrame:
    """The stream of LINES from a service."""
    reachable(spark)
    spark.dataSource.register(BatchServiceSource)
    return spark.readStream.format("batch_service").option("service", service).option("argument", argument).load()


ITEMS, ERRORS = "batch_id string, project_name string, custom_id string, document_name string, prompt_type string, object string", "batch_id string, kind string, line long, value string, error string"
MARKERS = "batch_id string, project_name string, status string, total long, successful long, failed long, epoch long"


def tick(stream: DataFrame, out: str, checkpoint: str, cfg: EngineConfig | None = None, trigger: dict | None = None, crash=None) -> StreamingQuery:
    """Results of batches that have ended: tables items, errors and markers below out (sources.epochs), one epoch per micro-batch. A
    batch that had been marked before is left alone. Dead batches get a marker without items."""
    cfg = cfg or EngineConfig()

    def work(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        epochs = Epochs(spark, out, crash and (lambda: crash(epoch)))
        if epochs.done(epoch):
            return
        rows = rows.persist()
        try:
            ended = rows.where(F.col("status").isin(*ENDED))
            marked = epochs.read("markers", MARKERS).where(F.col("epoch") < epoch).select("batch_id").distinct()
            new = ended.join(marked, "batch_id", "left_anti")
            output = new.where("kind = 'output'")
            parsed = results.parse_lines(output.select("batch_id", "value"))
            projects = new.groupBy("batch_id").agg(F.max("project_name").alias("project_name"), F.max("status").alias("status"))
            items = results.flatten_disbursements(results.objects(parsed, cfg.compat)).drop("project_name").join(projects, "batch_id").select("batch_id", "project_name", "custom_id", "document_name", "prompt_type", F.col("object").cast("string").alias("object"))
            bad = parsed.where("error is not null").select("batch_id", F.lit("output").alias("kind"), F.lit(None).cast("long").alias("line"), F.lit(None).cast("string").alias("value"), "error")
            given = new.where("kind = 'error'").select("batch_id", "kind", "line", "value", F.coalesce(F.get_json_object("value", "$.error.message"), F.get_json_object("value", "$.response.body.error.message"), F.lit("error file")).alias("error"))
            counts = parsed.groupBy("batch_id").agg(F.count("*").alias("total"), F.count_if(F.col("error").isNull()).alias("successful"))
            failed = given.groupBy("batch_id").agg(F.count("*").alias("given"))
            n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
            markers = projects.join(counts, "batch_id", "left").join(failed, "batch_id", "left").select("batch_id", "project_name", "status", (n("total") + n("given")).alias("total"), n("successful").alias("successful"), (n("total") - n("successful") + n("given")).alias("failed"), F.lit(epoch).cast("long").alias("epoch"))
            epochs.write(epoch, {"items": items, "errors": bad.unionByName(given), "markers": markers})
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def pending(states: DataFrame, out: str) -> DataFrame:
    """Batches (batch_id, status) that have ended and have no published marker."""
    marked = Epochs(states.sparkSession, out).read("markers", MARKERS)
    return batches.without_marker(states.where(F.col("status").isin(*ENDED)), marked.select("batch_id").distinct())
