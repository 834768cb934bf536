"""Column expressions used by more than one job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(text: Column) -> Column:
    """`yyyy-MM-dd` text to date; null when it is not one."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def midnight_millis(day: Column) -> Column:
    """Epoch milliseconds of midnight UTC, whatever the session's zone is."""
    return F.unix_date(day).cast("long") * F.lit(86_400_000).cast("long")


def inverse_log(value: Column, inverse: str = "expm1") -> Column:
    """Back to price units. `expm1` undoes `log1p`; `exp` gives a forecast one unit higher."""
    if inverse not in ("expm1", "exp"):
        raise ValueError(f"inverse must be expm1 or exp, not {inverse!r}")
    return F.expm1(value) if inverse == "expm1" else F.exp(value)


def over_under(pred: Column, truth: Column) -> Column:
    return F.when(pred >= truth, F.lit("over")).otherwise(F.lit("under"))


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def seeded_rank_key(row_id: Column, seed: int) -> Column:
    """Repeatable pseudo-random order of rows: a digest of id and seed, so each seed gives another order."""
    return F.md5(F.concat(row_id.cast("string"), F.lit(f":{seed}")))


def instant_key(ts: Column, tie: Column | None = None) -> Column:
    """One number that orders by instant, then by an integer tie key.

    `min_by`/`max_by` over a struct would force a sort aggregation of every input row; a
    decimal buffer keeps them in hash aggregation. 2^64 keeps the tie below one microsecond.
    """
    micros = F.unix_micros(ts.cast("timestamp"))
    if tie is None:
        return micros
    return micros.cast("decimal(18,0)") * F.expr("18446744073709551616BD") + tie.cast("decimal(19,0)")


def computed_once(value: Column) -> Column:
    """A generator of one row that holds `value`.

    A filter on a plain computed column is pushed below it and computes it again; one on the
    output of a generator is not. For costly values such as parsed JSON.
    """
    return F.explode_outer(F.array(value))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def local_clock(ts: Column, zone: str) -> Column:
    """Wall clock of `zone` without a zone."""
    return F.from_utc_timestamp(ts, zone).cast("timestamp_ntz")
