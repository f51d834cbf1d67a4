"""Operation log: JSON lines for people and files, rows for Spark, metrics observed while a query runs."""

from __future__ import annotations

import json
import logging
import time
import uuid
from datetime import datetime, timezone
from logging.handlers import RotatingFileHandler

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from .schemas import LOG_EVENT

# Size of a log file and how many are kept.
FILE_BYTES, FILES = 10 * 1024 * 1024, 5


def operation_id() -> str:
    return str(uuid.uuid4())


class JsonFormatter(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        event = {"timestamp": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        event |= getattr(record, "fields", {})
        if record.exc_info:
            event["exception"] = self.formatException(record.exc_info)
        return json.dumps(event, ensure_ascii=False, default=str)


def logger(name: str, file: str | None = None) -> logging.Logger:
    """A logger of JSON lines to the console, and to a rotating file if one is named. Asking again adds no handler."""
    out = logging.getLogger(name)
    if not out.handlers:
        out.setLevel(logging.INFO)
        out.propagate = False
        for handler in (logging.StreamHandler(), *([RotatingFileHandler(file, maxBytes=FILE_BYTES, backupCount=FILES, encoding="utf-8")] if file else [])):
            handler.setFormatter(JsonFormatter())
            out.addHandler(handler)
    return out


class OperationLog:
    """Events of one operation. They go to the logger as they happen; rows() gives them as a table."""

    def __init__(self, name: str, log: logging.Logger | None = None, id: str | None = None):
        self.name, self.id, self.log = name, id or operation_id(), log or logger("folioflow")
        self.events: list[tuple] = []
        self.began = time.monotonic()

    def event(self, message: str, level: str = "INFO", **fields: object) -> None:
        shown = {k: str(v) for k, v in fields.items() if v is not None}
        self.events.append((datetime.now(timezone.utc).replace(tzinfo=None), level, self.log.name, message, self.id, self.name, shown))
        self.log.log(getattr(logging, level), message, extra={"fields": {"operation_id": self.id, "operation_name": self.name, **shown}})

    def start(self, **fields: object) -> OperationLog:
        self.began = time.monotonic()
        self.event("operation started", **fields)
        return self

    def end(self, success: bool = True, **fields: object) -> None:
        self.event("operation ended", "INFO" if success else "ERROR", success=success, duration_ms=round(1000 * (time.monotonic() - self.began)), **fields)

    def document(self, name: str, stage: str, status: str, **fields: object) -> None:
        self.event("document", document_name=name, stage=stage, status=status, **fields)

    def batch(self, batch_id: str, status: str, **fields: object) -> None:
        self.event("batch", batch_id=batch_id, status=status, **fields)

    def error(self, code: str, message: str, **fields: object) -> None:
        self.event(message, "ERROR", error_code=code, **fields)

    def metric(self, name: str, value: float, **fields: object) -> None:
        self.event("metric", metric=name, value=value, **fields)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.events, LOG_EVENT)

    def __enter__(self) -> OperationLog:
        return self.start()

    def __exit__(self, kind, error, _) -> None:
        if error is not None:
            self.error(kind.__name__, str(error))
        self.end(error is None)


def observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """A table whose metrics are counted on the way; Observation.get has them once an action has run."""
    seen = Observation(name)
    return df.observe(seen, *metrics), seen
