"""Reads of recent data: newest bar, reference window, gold or its build."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import local_clock, or_zero
from tidemark.operators.bars import newest
from tidemark.schema import PROVIDER_EXTRAS, PROVIDER_NAMES, REFERENCE_COLUMNS, REFERENCE_DAYS, SERIES_KEY
from tidemark.session import join_on, named, small_or_not, stage
from tidemark.sinks.store import KeyedTable


def newest_record(bars: DataFrame, ts: str = "ts") -> DataFrame:
    """Newest bar per series as a stream record, stamped with its arrival; event time is kept."""
    top = newest(bars, SERIES_KEY, ts)
    return top.select(
        *SERIES_KEY,
        *[or_zero(F.col(c)).alias(c) for c in ("open", "high", "low", "close")],
        F.coalesce(F.col("volume"), F.lit(0)).cast("bigint").alias("volume"),
        F.col(ts).alias("dt"),
        F.unix_millis(F.current_timestamp()).alias("timestamp_in_ms"),
    )


def normalise_provider(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Provider column names to ours, extras dropped, known columns that are present, clock without zone."""
    renamed = df.withColumnsRenamed(PROVIDER_NAMES).drop(*PROVIDER_EXTRAS)
    if dict(renamed.dtypes).get("dt") == "timestamp":
        renamed = renamed.withColumn("dt", local_clock(F.col("dt"), zone))
    return renamed.select(*[named(c) for c in [*SERIES_KEY, *REFERENCE_COLUMNS] if c in renamed.columns])


def reference_window(bars: DataFrame, ts: str = "ts", days: int = REFERENCE_DAYS) -> DataFrame:
    """Rows of the last `days` days of each series.

    The oldest of the series' bounds is one number, given to the scan as a literal so that older
    row groups are skipped; each series' own bound is then applied by a join.
    """
    span = F.expr(f"interval {days} days")
    bounds = bars.groupBy(*SERIES_KEY).agg((F.max(ts) - span).alias("_since"))
    bounds = stage(bounds, "bounds")
    oldest = bounds.agg(F.min("_since")).first()[0]
    recent = bars.where(F.col(ts) >= F.lit(oldest).cast(dict(bars.dtypes)[ts]))
    return join_on(recent, small_or_not(bounds), SERIES_KEY).where(F.col(ts) >= F.col("_since")).drop("_since")


def gold_or_build(
    spark: SparkSession, table: KeyedTable, build: Callable[[], DataFrame], refresh: bool = False, order=()
) -> DataFrame:
    """The stored gold table; built first when it is missing or a refresh is asked for.

    Rows come sorted only when `order` is given: jobs that need time order carry it as a key.
    """
    if refresh or not table.exists(spark):
        table.upsert(build())
    gold = table.read(spark)
    return gold.orderBy(*[named(c) for c in order]) if order else gold
