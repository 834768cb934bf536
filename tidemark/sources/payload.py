"""Raw daily payloads: one JSON object per file, date text to a bar of strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import computed_once
from tidemark.schema import PAYLOAD_WRAPPER, RAW_BAR
from tidemark.session import file_system, join_on, small_or_not

_ENTRIES = "map<string,string>"


STALE = "_stale"  # beside the landed days; hidden from readers of the folder


def stale_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished lists of replaced days, the newest last."""
    at, fs = file_system(spark, f"{path}/{STALE}/v=*/_SUCCESS")
    return sorted(int(s.getPath().getParent().getName().split("=", 1)[1]) for s in fs.globStatus(at) or [])


def stale_days(spark: SparkSession, path: str) -> DataFrame | None:
    """(series, dt) of the landed days that a later landing replaced; None when there was no such landing."""
    versions = stale_versions(spark, path)
    return spark.read.schema("series string, dt date").parquet(f"{path}/{STALE}/v={versions[-1]}") if versions else None


def read_payloads(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """(series, dt, value) of a landing folder `series=<key>/dt=<latest>`, without replaced days.

    `one_per_file` takes a whole file as one object; otherwise each line is one.
    """
    landed = (
        spark.read.schema("value string, series string, dt date")
        .option("wholetext", str(one_per_file).lower())
        .text(path)
    )
    stale = stale_days(spark, path)
    return landed if stale is None else join_on(landed, small_or_not(stale), ["series", "dt"], "left_anti")


def payload_entries(value: Column) -> Column:
    """date text -> JSON text of its bar, with or without the provider's wrapper key.

    Bars stay text here so that one malformed bar cannot null its whole payload.
    """
    wrapped = F.from_json(value, f"struct<`{PAYLOAD_WRAPPER}`:{_ENTRIES}>")[PAYLOAD_WRAPPER]
    bare = F.from_json(value, _ENTRIES)
    return F.when(F.instr(value, f'"{PAYLOAD_WRAPPER}"') > 0, wrapped).otherwise(bare)


def explode_payloads(payloads: DataFrame, keep=()) -> DataFrame:
    """One row per date entry: (series, dt_string, raw, bar). An unreadable payload keeps one row."""
    entries = payloads.select(
        "series", "value", *keep, F.explode_outer(payload_entries(F.col("value"))).alias("dt_string", "entry")
    )
    return entries.select(
        "series",
        *keep,
        "dt_string",
        F.coalesce("entry", F.when(F.col("dt_string").isNull(), F.col("value"))).alias("raw"),
        computed_once(F.from_json("entry", RAW_BAR)).alias("bar"),
    )


def newest_landing(exploded: DataFrame, landed: str) -> DataFrame:
    """Of entries landed more than once for a series and date, the one landed last."""
    last = F.max_by(F.struct("raw", "bar"), landed).alias("last")
    return exploded.groupBy("series", "dt_string").agg(last).select("series", "dt_string", "last.*")


def explode_wide(wide: DataFrame, series: str) -> DataFrame:
    """The same rows from a table with one struct column per date.

    Each struct is turned into JSON text first, so columns need not share a struct type.
    """
    as_text = wide.select(*[F.to_json(wide[f"`{c}`"]).alias(c) for c in wide.columns])
    tall = as_text.unpivot([], [as_text[f"`{c}`"] for c in wide.columns], "dt_string", "raw")
    return tall.select(F.lit(series).alias("series"), "dt_string", "raw", computed_once(F.from_json("raw", RAW_BAR)).alias("bar"))
