"""The life of batches as a stateful processor with timers.

Per batch: the furthest state that it has reached, how often each state was reported as an error and tried again, and a
timer that lets it expire a day after its last message. The state can begin with batches that are known from stored
infos, and a restarted query goes on with states and timers of its checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .flows import STATES

OUT = "batch_id string, status string, ts timestamp, retries int"
#: Milliseconds after a batch's last message at which it expires.
DAY = 24 * 3_600_000
_END = STATES.index("completed")


class Machine(StatefulProcessor):
    """Rows (batch_id, status, ts) in; a row when a batch moves on, and "expired" when its time is up."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "rank int, until long")
        self.retries = handle.getMapState("retries", "status string", "n int")

    def _tried(self) -> int:
        return sum(n for _, (n,) in self.retries.iterator()) if self.retries.exists() else 0

    def _set(self, rank: int, until: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old if isinstance(old, int) else old[0])
        self.place.update((rank, until))
        if rank < _END:
            self.handle.registerTimer(until)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """A batch that is known already: its last status and when that was."""
        row = initialState.iloc[-1]
        self._set(STATES.index(row["status"]) if row["status"] in STATES else -1, int(row["ts"].timestamp() * 1000) + DAY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rank, until = tuple(self.place.get()) if self.place.exists() else (-1, 0)
        out = []
        every = pd.concat(list(rows)).sort_values("ts", kind="stable")
        for status, ts in zip(every["status"], every["ts"], strict=True):
            until = max(until, int(ts.timestamp() * 1000) + DAY)
            if status == "error":
                held = self.retries.getValue(("error",))[0] if self.retries.exists() and self.retries.containsKey(("error",)) else 0
                self.retries.updateValue(("error",), (held + 1,))
                continue
            place = STATES.index(status) if status in STATES else -1
            if rank < _END and place > rank:
                rank = place
                out.append((key[0], status, ts))
        self._set(rank, until)
        if out:
            yield pd.DataFrame(out, columns=["batch_id", "status", "ts"]).assign(retries=pd.Series([self._tried()] * len(out), dtype="int32"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rank = self.place.get()[0] if self.place.exists() else _END
        tried = self._tried()
        self.place.clear()
        self.retries.clear()
        if rank < _END:
            yield pd.DataFrame({"batch_id": [key[0]], "status": ["expired"], "ts": [pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")], "retries": pd.Series([tried], dtype="int32")})

    def close(self) -> None:
        pass


def life(stream: DataFrame, known: DataFrame | None = None, late: str = "1 hour") -> DataFrame:
    """Moves of the batches of a stream (batch_id, status, ts), expiries included. known: batches (batch_id, status, ts) that the state
    begins with. Needs a state store that keeps several states per key (RocksDB)."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    begin = None if known is None else known.select("batch_id", "status", "ts").groupBy("batch_id")
    rows = stream.select("batch_id", "status", "ts").withWatermark("ts", late).groupBy("batch_id")
    return rows.transformWithStateInPandas(statefulProcessor=Machine(), outputStructType=OUT, outputMode="append", timeMode="eventTime", initialState=begin)
