"""What becomes of messages: why they are refused, how often they were tried, when they may go out.

All three are plain aggregates and windows over tables of messages and of what happened to them, and so
hold for stored queues as well as, in micro-batches, for streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.running import running_max, running_sums
from ..schemas import QUEUE_MESSAGE


def examined(lines: DataFrame, value: str = "value") -> DataFrame:
    """lines with m (the message's fields) and cause: why it is refused, null for a sound one."""
    m = F.from_json(value, QUEUE_MESSAGE)
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    kind = F.schema_of_variant(F.try_parse_json(value))
    cause = F.when(blank(F.col(value)), "empty").when(kind.isNull(), "not JSON").when(~F.startswith(kind, F.lit("OBJECT")), "no object")
    return lines.withColumn("m", m).withColumn("cause", cause.when(blank(F.col("m.project_name")), "no project_name").when(blank(F.col("m.queue_type")), "no queue_type"))


def dead_letters(lines: DataFrame, value: str = "value") -> DataFrame:
    """Refused lines with their cause; what stands in them is kept as it is."""
    return examined(lines, value).where("cause is not null").drop("m")


def leases(history: DataFrame, now: Column, lease: str = "5 minutes", most: int = 5, id_col: str = "message_id") -> DataFrame:
    """State of each message from its history (id, what: sent, taken, done or failed; ts): done; leased, while the last attempt's lease
    runs and it has not failed; dead, after `most` attempts; else visible. With the number of attempts and the time when it becomes
    visible again. One aggregate per message, combined before the shuffle."""
    what, ts = F.col("what"), F.col("ts")
    of = history.groupBy(id_col).agg(
        F.count_if(what == "taken").alias("attempts"), F.max(F.when(what == "taken", ts)).alias("taken_at"), F.max(F.when(what == "failed", ts)).alias("failed_at"), F.max(what == "done").alias("is_done")
    )
    until = F.col("taken_at") + F.expr(f"interval {lease}")
    running = F.col("taken_at").isNotNull() & (until > now) & ~F.coalesce(F.col("failed_at") >= F.col("taken_at"), F.lit(False))
    state = F.when(F.col("is_done"), "done").when(running, "leased").when(F.col("attempts") >= most, "dead").otherwise("visible")
    return of.select(id_col, "attempts", state.alias("state"), F.when(state == "leased", until).alias("visible_at"))


def paced(messages: DataFrame, keys: list[str], gap: float, burst: int = 1, ts: str = "ts", tie: str = "message_id") -> DataFrame:
    """messages with released: when a token bucket per key lets each go, in order of time. A bucket holds `burst` tokens and gains one
    every `gap` seconds.

    With t_i the time of a key's i-th message, the bucket is owed until D_i = max(t_i, D_(i-1)) + gap, which is
    (i + 1) gap + max over j <= i of (t_j - j gap); message i goes at max(t_i, D_(i-1) - (burst - 1) gap). So a running count and a
    running maximum do, in microseconds, and a key with most of the messages is spread over ranges.
    """
    step = round(gap * 1_000_000)
    rows = messages.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("_one", F.lit(1))
    counted = running_sums(rows, keys, ["_t", tie], ["_one"])
    over = running_max(counted.withColumn("_d", F.col("_t") - F.col("before__one") * step), keys, ["_t", tie], "_d")
    owed = F.col("before__d") + F.col("before__one") * step  # until when the messages before it are owed
    at = F.greatest(F.col("_t"), F.coalesce(owed - (burst - 1) * step, F.col("_t")))
    return over.select(*messages.columns, F.timestamp_micros(at).alias("released"))
