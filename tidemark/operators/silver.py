"""Silver: typed daily bars out of exploded payload rows, with a quarantine for the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import is_finite, midnight_millis, to_day
from tidemark.schema import PAYLOAD_FIELDS, SILVER


def type_bars(exploded: DataFrame) -> DataFrame:
    """Every input row, typed, with `reason` null when it is a valid bar."""
    casts = {"open": "float", "high": "float", "low": "float", "close": "float", "volume": "bigint"}
    typed = exploded.select(
        "series",
        to_day(F.col("dt_string")).alias("dt"),
        *[F.col("bar").getField(PAYLOAD_FIELDS[c]).try_cast(kind).alias(c) for c, kind in casts.items()],
        "dt_string",
        "raw",
    ).withColumn("timestamp_in_ms", midnight_millis(F.col("dt")))
    missing = F.lit(False)
    for c, kind in casts.items():
        missing = missing | (~is_finite(F.col(c)) if kind == "float" else F.col(c).isNull())
    reason = (
        F.when(F.col("dt_string").isNull(), "no readable entry")
        .when(F.col("dt").isNull(), "bad date")
        .when(F.col("series").isNull(), "no series")
        .when(missing, "missing or bad field")
    )
    return typed.withColumn("reason", reason)


def accepted(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("reason").isNull()).select(*SILVER.fieldNames())


def rejected(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("reason").isNotNull()).select("series", "dt_string", "raw", "reason")


def enforce_schema(df: DataFrame, schema) -> DataFrame:
    """Select, cast, and fail the job on a null in a non-null column. No pass through the driver."""
    columns = []
    for field in schema.fields:
        value = df[f"`{field.name}`"].cast(field.dataType)
        if not field.nullable:
            message = f"null in non-null column {field.name}"
            value = F.coalesce(value, F.raise_error(F.lit(message)).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)
