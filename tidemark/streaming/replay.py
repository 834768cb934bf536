"""Experience replay: the last arrivals per series and a recency-biased sample of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import seeded_rank_key
from tidemark.operators.ordering import last_rows
from tidemark.schema import BUFFER_ROWS, MICRO_BATCH_ROWS, SERIES_KEY
from tidemark.session import named

ARRIVAL = "_batch_id"  # of a row in a buffer: the micro-batch it came with


def recency_sample(
    buffer: DataFrame, order, row_id: str, n: int = MICRO_BATCH_ROWS, seed: int = 0, keys=SERIES_KEY, warm_only: bool = False
) -> DataFrame:
    """The newest row per group and `n - 1` others, uniform without replacement; all rows when fewer.

    The sample is sorted by group and then by `order` without the arrival, so in time. `buffer` is bounded per group by its size. `warm_only` leaves out groups with less than `n` rows.
    """
    by = [named(k) for k in keys]
    newest = Window.partitionBy(*by).orderBy(*[named(c).desc() for c in order])
    ranked = buffer.withColumn("_age", F.row_number().over(newest))
    if warm_only:
        ranked = ranked.withColumn("_held", F.count(F.lit(1)).over(Window.partitionBy(*by))).where(F.col("_held") >= n).drop("_held")
    drawn = Window.partitionBy(*by).orderBy(F.col("_age") > 1, seeded_rank_key(named(row_id), seed), named(row_id))
    sample = ranked.withColumn("_draw", F.row_number().over(drawn)).where(F.col("_draw") <= n)
    time = [named(c) for c in order if c != ARRIVAL]
    return sample.orderBy(*by, *time).drop("_age", "_draw")


class ReplayBuffer:
    """The last `size` arrivals per group, kept as a table between micro-batches.

    A row arrives with its micro-batch; rows of one micro-batch are ordered by `order`. A row that
    is sent again (same group and `row_id`) takes the place of its earlier form. Two slots take
    turns, so the buffer before a micro-batch is still there when it runs again. Rows are cut per
    task before they are shuffled; no group is held by one stateful task.
    """

    def __init__(self, path: str, order, size: int = BUFFER_ROWS, keys=SERIES_KEY, row_id: str | None = None):
        self.path, self.size, self.keys, self.row_id = path, size, list(keys), row_id
        self.order = [ARRIVAL, *order]

    def _slot(self, batch_id: int) -> str:
        return f"{self.path}/slot{batch_id % 2}"

    def update(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        rows = batch.withColumn(ARRIVAL, F.lit(batch_id).cast("long"))
        if batch_id > 0:
            held = spark.read.schema(rows.schema).parquet(self._slot(batch_id - 1))
            if held.where(F.col(ARRIVAL) >= batch_id).limit(1).count():
                raise RuntimeError(f"replay buffer {self.path} is ahead of micro-batch {batch_id}")
            rows = rows.unionByName(held)
        if self.row_id:
            rows = last_rows(rows, [*self.keys, self.row_id], self.order, 1)
        last_rows(rows, self.keys, self.order, self.size).write.mode("overwrite").parquet(self._slot(batch_id))
        return spark.read.schema(rows.schema).parquet(self._slot(batch_id))
