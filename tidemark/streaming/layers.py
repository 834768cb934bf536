"""Silver and gold kept up to date by micro-batches, and drift watched on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.drift import count_values, ks_of_values, tall_values
from tidemark.operators.gold import affected_gold, gold_features
from tidemark.schema import DRIFT_ROWS, SILVER
from tidemark.session import scratch_scope, stage
from tidemark.sinks.log import AppendedTable
from tidemark.sinks.store import KeyedTable
from tidemark.streaming.replay import ReplayBuffer, recency_sample
from tidemark.streaming.sinks import COMPACT_EVERY, batch_folder

class LayerUpdater:
    """`foreachBatch` handler: new bars into silver, the changed rows into gold.

    With `AppendedTable`s a micro-batch writes its own rows and the gold rows that they change; after
    `compact_every` of them both tables are compacted.
    """

    def __init__(
        self, silver: KeyedTable | AppendedTable, gold: KeyedTable | AppendedTable, unique_days: bool = False, reach_days: int = 90,
        compact_every: int = COMPACT_EVERY,
    ):
        self.silver, self.gold = silver, gold
        self.unique_days, self.reach_days, self.compact_every = unique_days, reach_days, compact_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark):
            bars = stage(batch.select(*SILVER.fieldNames()), "bars")
            if bars.isEmpty():
                return
            self.silver.take(bars, batch_id, staged=True)
            if not self.gold.exists(spark):
                self.gold.take(gold_features(self.silver.read(spark), self.unique_days), batch_id)
            else:
                between = lambda spans: self.silver.between(spark, spans)
                # the rows are a projection of a stored table, so they need no copy of their own
                self.gold.take(affected_gold(between, bars, self.unique_days, self.reach_days), batch_id, staged=True)
        for table in (self.silver, self.gold):
            if isinstance(table, AppendedTable):
                table.compact(spark, self.compact_every)


class DriftMonitor:
    """`foreachBatch` handler: a sample of the buffer against a fixed reference, once it is large
    enough. The reference is counted once, not with every micro-batch.

    `rows` must not be above the buffer size, else no test would ever run; by default it is
    `DRIFT_ROWS`, or the whole of a smaller buffer.
    """

    def __init__(self, path: str, buffer: ReplayBuffer, reference: DataFrame, columns, row_id: str, rows: int | None = None, seed: int = 0):
        rows = min(DRIFT_ROWS, buffer.size) if rows is None else rows
        if rows > buffer.size:
            raise ValueError(f"drift sample of {rows} rows from a buffer of {buffer.size}")
        self.path, self.buffer = path, buffer
        self.reference = stage(count_values(reference, columns), "reference")
        self.columns, self.row_id, self.rows, self.seed = list(columns), row_id, rows, seed

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        held = self.buffer.update(batch, batch_id)
        with scratch_scope(batch.sparkSession):
            sample = stage(recency_sample(
                held, self.buffer.order, self.row_id, self.rows, self.seed + batch_id, self.buffer.keys, warm_only=True
            ), "sample")
            if not sample.isEmpty():
                report = ks_of_values(self.reference, tall_values(sample, self.columns))
                report.write.mode("overwrite").parquet(batch_folder(self.path, batch_id))
