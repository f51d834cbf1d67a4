"""The stateful processor of batches: moves, retries, timers, a known beginning, and a restart in between."""

from datetime import datetime, timedelta

from folioflow.session import reachable
from folioflow.streaming import machine

T0 = datetime(2024, 1, 1)


def test_batches_move_on_and_expire(spark, tmp_path):
    reachable(spark)
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    src, out, checkpoint = (str(tmp_path / x) for x in ("s", "o", "c"))
    kind = "batch_id string, status string, ts timestamp"

    def send(*rows):
        spark.createDataFrame([(b, s, T0 + timedelta(hours=h)) for b, s, h in rows], kind).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(kind).parquet(src)
        known = spark.createDataFrame([("k", "in_progress", T0), ("z", "completed", T0)], kind)
        machine.life(stream, known).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
        return {(r["batch_id"], r["status"]): r for r in spark.read.parquet(out).collect()}

    try:
        send(("a", "validating", 1), ("a", "error", 2), ("a", "error", 3), ("a", "in_progress", 4), ("a", "validating", 5), ("b", "validating", 1), ("k", "validating", 2), ("z", "in_progress", 1))
        got = run()
        assert set(got) == {("a", "validating"), ("a", "in_progress"), ("b", "validating")}
        # a new query on the same checkpoint: b and k have said nothing for a day, a goes on
        send(("a", "completed", 20), ("c", "validating", 48))
        got = run()
        send(("c", "in_progress", 49))
        got = run()
        assert {("a", "completed"), ("c", "validating"), ("c", "in_progress"), ("b", "expired"), ("k", "expired")} <= set(got)
        assert got["a", "completed"]["retries"] == 2 and got["b", "expired"]["ts"] == T0 + timedelta(hours=25) and got["k", "expired"]["ts"] == T0 + timedelta(hours=26)
        assert not {("a", "expired"), ("z", "expired"), ("z", "in_progress"), ("c", "expired")} & set(got)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
