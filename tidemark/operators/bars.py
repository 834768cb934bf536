"""Bars of a fixed width out of raw ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import instant_key, midnight_millis
from tidemark.schema import SILVER
from tidemark.session import named


def bar_aggregates(price: str, ts: str, tie: str | None, volume: str | None):
    """Open, high, low, close, volume; all partial, so a hot series is reduced before the shuffle."""
    at = instant_key(F.col(ts), F.col(tie) if tie else None)
    return [
        F.min_by(price, at).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, at).alias("close"),
        (F.sum(volume) if volume else F.count(F.lit(1))).cast("long").alias("volume"),
    ]


def build_bars(
    ticks: DataFrame, series: str, ts: str, price: str, width: str, tie: str | None = None, volume: str | None = None
) -> DataFrame:
    """(series, ts, open, high, low, close, volume); works on a batch and on a stream.

    `tie` is an integer column that orders ticks of one instant. Volume counts ticks unless given.
    """
    at = F.col(ts).cast("timestamp") if dict(ticks.dtypes)[ts] == "timestamp_ntz" else F.col(ts)
    keyed = ticks.withColumn(ts, at)
    bars = keyed.groupBy(F.col(series).alias("series"), F.window(ts, width).alias("w")).agg(
        *bar_aggregates(price, ts, tie, volume)
    )
    return bars.select("series", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")


def build_daily_bars(
    ticks: DataFrame, series: str, ts: str, price: str, tie: str | None = None, volume: str | None = None
) -> DataFrame:
    """Daily bars in the silver schema. A calendar day needs no window expression: the date is the key."""
    bars = ticks.groupBy(F.col(series).alias("series"), F.to_date(ts).alias("dt")).agg(
        *bar_aggregates(price, ts, tie, volume)
    )
    return bars.withColumn("timestamp_in_ms", midnight_millis(F.col("dt"))).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER.fields]
    )


def newest(df: DataFrame, keys, order: str) -> DataFrame:
    """The newest row per key: one partial hash aggregation where all other columns are of fixed width.

    All columns are compared by the same `order`, so they come from one row, in ties too. One
    struct for the whole row would make Spark sort every input row instead.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*[named(k) for k in keys]).agg(*[F.max_by(named(c), named(order)).alias(c) for c in rest])
