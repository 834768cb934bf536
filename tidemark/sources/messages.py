"""Messages: a JSON array of records as text, decoded with a quarantine for bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import computed_once, iso_text
from tidemark.operators.silver import enforce_schema
from tidemark.schema import RECORD, SILVER

_MESSAGE = f"array<{RECORD.simpleString()}>"
# ISO 8601 local time: date, time with seconds, optional fraction. Others are quarantined.
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def encode_records(records: DataFrame, group) -> DataFrame:
    """(group..., value): the records of each group as one JSON array, in time order.

    A group is a micro-batch: of fixed size by construction.
    """
    record = F.struct(
        F.col("timestamp_in_ms"),
        *[F.col(c) for c in ("series", "open", "high", "low", "close", "volume")],
        iso_text(F.col("dt")).alias("dt"),
    )
    return records.groupBy(*group).agg(F.to_json(F.array_sort(F.collect_list(record))).alias("value"))


def _iso_timestamp(text: Column) -> Column:
    return F.when(text.rlike(_ISO), F.try_to_timestamp(text))


def decode_messages(messages: DataFrame, keep=()) -> DataFrame:
    """One row per record; `reason` is set for what cannot be used.

    An undecodable message keeps one row; an empty array gives none, as there is nothing in it.
    """
    decoded = messages.select(*keep, "value", computed_once(F.from_json("value", _MESSAGE)).alias("records"))
    outer = decoded.where(F.col("records").isNull() | (F.size("records") > 0)).select(
        *keep, "value", F.explode_outer("records").alias("r")
    )
    typed = outer.select(
        *keep, "value", "r.*",
    ).withColumn("dt", _iso_timestamp(F.col("dt")))
    missing = F.lit(False)
    for c in ("open", "high", "low", "close", "volume", "dt", "timestamp_in_ms"):
        missing = missing | F.col(c).isNull()
    bad_message = F.col("dt").isNull() & F.col("close").isNull() & F.col("timestamp_in_ms").isNull()
    return typed.withColumn("reason", F.when(bad_message, "bad message").when(missing, "bad record"))


def good_records(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).drop("reason", "value")


def bad_records(decoded: DataFrame, keep=()) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull()).select(*keep, "value", "reason")


def records_to_silver(records: DataFrame) -> DataFrame:
    """Records cast to the silver schema; the date is the day of the record. A null raises."""
    return enforce_schema(records, SILVER)


def rows_to_table(spark, rows, schema=SILVER) -> DataFrame:
    """Python records to a typed table; a null in a non-null column raises."""
    return spark.createDataFrame(rows, schema=schema)
