"""Small aggregates per period of a keyed table, kept beside it and computed again only where a period changed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import SERIES_KEY
from tidemark.session import join_on, named, path_exists, small_or_not, stage
from tidemark.sinks.store import _PERIOD, KeyedTable


@dataclass(frozen=True)
class PeriodStates:
    """One row per (period, keys) with aggregates that can be merged over periods: counts, sums, minima, maxima."""

    table: KeyedTable
    path: str
    aggregates: dict[str, Column]
    keys: tuple[str, ...] = tuple(SERIES_KEY)

    def refresh(self, spark: SparkSession, periods=None) -> None:
        """Compute the states of these periods again (of all, for None); others are neither read nor written.

        `KeyedTable.upsert` returns the periods that it touched.
        """
        if periods is not None and not periods:
            return
        wanted = None if periods is None else {str(p) for p in periods}
        rows = self.table.read(spark) if wanted is None else self.table._read_periods(spark, wanted.__contains__)
        states = self.table._with_period(rows).groupBy(*[named(k) for k in self.keys], _PERIOD).agg(
            *[a.alias(n) for n, a in self.aggregates.items()]
        )
        mode = "static" if wanted is None else "dynamic"
        states.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(_PERIOD).parquet(self.path)

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, f"{self.path}/_SUCCESS")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).withColumn(_PERIOD, F.col(_PERIOD).cast("string"))


def clock_states(table: KeyedTable, path: str, clock: str = "dt") -> PeriodStates:
    """First and last instant of every series in every period."""
    return PeriodStates(table, path, {"first": F.min(named(clock)), "last": F.max(named(clock))})


def recent_stored(spark: SparkSession, states: PeriodStates, days: int, clock: str = "dt") -> DataFrame:
    """Rows of the last `days` days of each series, of a stored table with `clock_states`.

    Only periods that hold such rows of some series are read, so a series that ended long ago adds the folders of its
    own end and not all that came after. The list of periods, one entry per folder, comes to the driver.
    """
    spans = states.read(spark)
    bounds = stage(spans.groupBy(*states.keys).agg((F.max("last") - F.expr(f"interval {days} days")).alias("_since")), "bounds")
    bounds = small_or_not(bounds)
    needed = join_on(spans, bounds, states.keys).where(F.col("last") >= F.col("_since"))
    periods = {r[0] for r in needed.select(_PERIOD).distinct().collect()}
    rows = states.table._read_periods(spark, periods.__contains__)
    return join_on(rows, bounds, states.keys).where(named(clock) >= F.col("_since")).drop("_since")
