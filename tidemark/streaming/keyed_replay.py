"""The replay buffer as keyed state of a stream: a bounded list per group that each micro-batch moves on."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidemark.schema import BUFFER_ROWS, SERIES_KEY
from tidemark.session import join_on, ship_with_tasks, small_or_not
from tidemark.streaming.replay import ARRIVAL

ship_with_tasks(__name__)

IDLE_DAYS = 30
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Buffer(StatefulProcessor):
    """The last rows of a group by arrival, then `order`; a timer forgets a group that has been idle for long."""

    def __init__(self, columns, state: T.StructType, order, size: int, row_id: str | None, clock: str | None, idle_ms: int):
        self.columns, self.state, self.order, self.size, self.row_id = columns, state, order, size, row_id
        self.clock, self.idle_ms = clock, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.state)
        self.arrivals = handle.getValueState("arrivals", T.StructType([T.StructField("n", T.LongType())]))

    def _last(self, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([ARRIVAL, *self.order], kind="stable")
        if self.row_id:
            rows = rows.drop_duplicates(self.row_id, keep="last")
        return rows.tail(self.size)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        number = (self.arrivals.get()[0] if self.arrivals.exists() else 0) + 1
        held = pd.DataFrame(list(self.rows.get()), columns=self.state.fieldNames()) if self.rows.exists() else None
        for part in rows:  # a chunk at a time, so a hot group never lies in memory as a whole
            part = part[self.columns].assign(**{ARRIVAL: number})[self.state.fieldNames()]
            held = self._last(part if held is None else pd.concat([held, part], ignore_index=True))
        self.arrivals.update((number,))
        known = held.astype(object).where(held.notna(), None)  # the state takes None, not NaN or NaT
        self.rows.put(list(known.itertuples(index=False, name=None)))
        newest = held[self.clock].max() if self.clock else None
        if newest is not None and not pd.isna(newest):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(newest.timestamp() * 1000) + self.idle_ms)
        yield held

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.rows.clear()
        self.arrivals.clear()
        return iter(())

    def close(self) -> None:
        pass


def replay_stream(
    stream: DataFrame, order, size: int = BUFFER_ROWS, keys=SERIES_KEY, row_id: str | None = None, clock: str | None = None,
    idle_days: int = IDLE_DAYS,
) -> DataFrame:
    """The buffer of every group that a micro-batch brings rows of, as a stream to run in update mode.

    As `ReplayBuffer`, but kept in the state store: only changed groups are written, and the checkpoint holds the state, so a restart
    goes on with it. The buffer of a group is bounded by `size`. With the watermarked column `clock`, a group is forgotten once
    the watermark is `idle_days` past its newest row, and rows later than the watermark do not come in. Rows
    carry the number of their group's micro-batch in the arrival column. Null order columns come last. Sets the session's
    state store to RocksDB, which keyed state asks for.
    """
    stream.sparkSession.conf.set(STATE_STORE, ROCKS_DB)
    state = T.StructType([*stream.schema.fields, T.StructField(ARRIVAL, T.LongType())])
    processor = _Buffer(stream.columns, state, list(order), size, row_id, clock, idle_days * 86_400_000)
    return stream.groupBy(*keys).transformWithStateInPandas(processor, state, "Update", "EventTime" if clock else "None")


def newest_buffers(spark: SparkSession, path: str, keys=SERIES_KEY) -> DataFrame:
    """The last buffer of every group, of micro-batches that `append_sink(path)` took from a `replay_stream`."""
    sent = spark.read.parquet(path)
    last = sent.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"))
    return join_on(sent, small_or_not(last), [*keys, "batch_id"], "left_semi").drop("batch_id")
