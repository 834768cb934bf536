"""Online learning from replayed bars: buffer, sample, gold features, preparation, one step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.prepare import Preparation
from tidemark.schema import MICRO_BATCH_ROWS, SERIES_KEY
from tidemark.session import join_on, scratch_scope, small_or_not, stage
from tidemark.sinks.store import KeyedTable
from tidemark.streaming.online import OnlineModel
from tidemark.streaming.replay import ReplayBuffer, recency_sample

_KEY = [*SERIES_KEY, "timestamp_in_ms"]


class ReplayLearner:
    """`foreachBatch` handler for bars in the silver schema, to run after a `LayerUpdater`.

    The sampled bars take their features from the gold table, so a moving mean covers the bars
    before them and not just the sample. Series whose buffer is not warm yet keep their weights,
    and so do all when a micro-batch brings nothing new.
    """

    def __init__(
        self, gold: KeyedTable, buffer: ReplayBuffer, preparation: Preparation, model: OnlineModel,
        rows: int = MICRO_BATCH_ROWS, seed: int = 0,
    ):
        self.gold, self.buffer, self.preparation, self.model = gold, buffer, preparation, model
        self.rows, self.seed = rows, seed

    def sample(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """(series, dt, timestamp_in_ms) of the micro-batch to learn from."""
        held = self.buffer.update(batch.select("series", "dt", "timestamp_in_ms"), batch_id)
        drawn = recency_sample(
            held, self.buffer.order, "timestamp_in_ms", self.rows, self.seed + batch_id, SERIES_KEY, warm_only=True
        )
        return stage(drawn, "drawn")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark):
            drawn = self.sample(batch, batch_id)
            oldest = drawn.agg(F.min("dt")).first()[0]
            if oldest is None or batch.isEmpty():
                rows = self.gold.read(spark).limit(0)
            else:
                wanted = small_or_not(drawn.select(*_KEY))
                rows = join_on(self.gold.since(spark, oldest), wanted, _KEY, "left_semi")
            self.model.step(self.preparation.apply(rows), batch_id)
