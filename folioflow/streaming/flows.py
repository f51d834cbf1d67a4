"""Structured Streaming: message intake, the life of batches, idempotent results, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEAD_STATUSES, PACE_SECONDS
from ..schemas import QUEUE_MESSAGE
from ..sources.epochs import Epochs
from . import intake


def messages(spark: SparkSession, path: str, max_files: int = 6) -> DataFrame:
    """A directory of JSON messages as a stream; broken lines are what refused() has."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return intake.examined(lines).where("cause is null").select("m.*")


def refused(spark: SparkSession, path: str, max_files: int = 6) -> DataFrame:
    """The lines that messages() leaves out, as a stream, with their cause: a dead-letter table once each_once or another writer
    has them."""
    return intake.dead_letters(spark.readStream.option("maxFilesPerTrigger", max_files).text(path))


def send(messages: DataFrame, path: str, limit: int | None = None, dry_run: bool = False) -> DataFrame:
    """Adds messages to an intake directory, the first `limit` by project if one is given; a dry run only returns them."""
    chosen = messages if limit is None else messages.orderBy("project_name").limit(limit)
    if not dry_run:
        chosen.select(F.to_json(F.struct(*chosen.columns)).alias("value")).write.mode("append").text(path)
    return chosen


def project_messages(projects: DataFrame, queue_type: str = "processing") -> DataFrame:
    """One message per project."""
    return projects.select("project_name", F.lit(queue_type).alias("queue_type")).distinct()


def paced(seconds: int = PACE_SECONDS) -> dict:
    """Trigger that leaves time between the messages it takes in; with one file per trigger, between any two."""
    return {"processingTime": f"{seconds} seconds"}


def queue_info(spark: SparkSession, path: str) -> DataFrame:
    """Files and messages of an intake directory, how many lack a required field, and its oldest and latest file."""
    lines = spark.read.text(path).select(F.from_json("value", QUEUE_MESSAGE).alias("m"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("at"))
    bad = F.col("m.project_name").isNull() | F.col("m.queue_type").isNull()
    return lines.agg(F.count_distinct("file").alias("files"), F.count("*").alias("messages"), F.count_if(bad).alias("rejected"), F.min("at").alias("oldest"), F.max("at").alias("latest"))


def peek(spark: SparkSession, path: str, n: int = 32) -> DataFrame:
    """The first n messages, without taking them."""
    return spark.read.text(path).select(F.from_json("value", QUEUE_MESSAGE).alias("m")).select("m.*").limit(n)


def each_once(stream: DataFrame, keys: list[str], path: str, checkpoint: str, trigger: dict | None = None, within: tuple[str, str] | None = None) -> StreamingQuery:
    """Writes rows of each key once, as the table `rows` of published epochs below path (sources.epochs), so readers never see
    a micro-batch in part.

    The keys seen are the stream's state, so no batch reads what earlier ones have written. within: a time column and
    how long a key may come again; older keys are forgotten. Without it they are kept for ever.
    """

    def commit(rows: DataFrame, epoch: int) -> None:
        Epochs(rows.sparkSession, path).write(epoch, {"rows": rows})

    once = stream.withWatermark(*within).dropDuplicatesWithinWatermark(keys) if within else stream.dropDuplicates(keys)
    return once.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def latest_status(stream: DataFrame, ttl: str = "24 hours") -> DataFrame:
    """Latest status per batch of a stream of (batch_id, status, ts); for update or complete output."""
    return stream.withWatermark("ts", ttl).groupBy("batch_id").agg(F.max_by("status", "ts").alias("status"), F.max("ts").alias("ts"))


def ended(stream: DataFrame) -> DataFrame:
    return stream.where(F.col("status").isin("completed", *DEAD_STATUSES))


def unique_batches(stream: DataFrame, ttl: str = "24 hours") -> DataFrame:
    return stream.withWatermark("ts", ttl).dropDuplicatesWithinWatermark(["batch_id"])


def moves(rows: DataFrame, key: str = "user_id", status: str = "event_type", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """History of states: every row with the state before and after it. A window per key; a key's own history is
    sorted, which spills, and nothing is gathered."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("before", F.lag(status).over(w)).withColumn("after", F.lead(status).over(w))


def tumbling(events: DataFrame, size: str = "5 minutes", late: str | None = None, by: str = "event_type") -> DataFrame:
    """Counts per window and kind; with a watermark for streams."""
    rows = events.withWatermark("ts", late) if late else events
    return rows.groupBy(F.window("ts", size).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), by, "n")


#: Order of a batch's states; a late message never moves one back.
STATES = ("validating", "in_progress", "finalizing", "completed", "failed", "expired", "cancelled")


def lifecycle(stream: DataFrame) -> DataFrame:
    """State machine per batch: emits a row when a batch moves on, and "expired" when none came for a day of
    event time. Arrow-backed stateful operator keyed by batch_id."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, frames, state: GroupState):
        held = state.get[0] if state.exists else -1
        if state.hasTimedOut:
            state.remove()
            if held < STATES.index("completed"):
                yield pd.DataFrame({"batch_id": [key[0]], "status": ["expired"], "ts": [pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")]})
            return
        moves = []
        rows = pd.concat(list(frames)).sort_values("ts", kind="stable")
        for status, ts in zip(rows["status"], rows["ts"], strict=True):
            rank = STATES.index(status) if status in STATES else -1
            if rank > held and held < STATES.index("completed"):
                held = rank
                moves.append((key[0], status, ts))
        state.update((held,))
        until = int(rows["ts"].max().timestamp() * 1000) + 24 * 3_600_000
        if until > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(until)
        if moves:
            yield pd.DataFrame(moves, columns=["batch_id", "status", "ts"])

    return stream.withWatermark("ts", "1 hour").groupBy("batch_id").applyInPandasWithState(step, "batch_id string, status string, ts timestamp", "rank int", "append", GroupStateTimeout.EventTimeTimeout)
