"""Exact medians without gathering a group's values in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_sums
from tidemark.session import join_on, named, small_or_not, stage

# Non-null values of one group that the built-in exact `percentile` may hold in one buffer.
BUFFER_VALUES = 1_000_000
_ACCURACY = 10_000


def exact_medians(df: DataFrame, columns, by=(), limit: int = BUFFER_VALUES, largest: int | None = None) -> DataFrame:
    """One row per group: the interpolated median of each column, under the column's name.
    `largest` is the greatest number of values in a group, counted here when not given.

    Small groups use `percentile`. Otherwise a mergeable sketch brackets the middle (its rank
    error is bounded), and the exact middle is read off running counts of the distinct values
    inside the bracket, about 4 in 10,000 of the rows.
    """
    keys = [named(k) for k in by]
    if largest is None:
        counts = df.groupBy(*keys).agg(*[F.count(named(c)).alias(c) for c in columns])
        largest = counts.agg(F.greatest(*[F.max(named(c)) for c in columns], F.lit(0))).first()[0]
    if largest <= limit:
        return df.groupBy(*keys).agg(*[F.percentile(named(c).cast("double"), 0.5).alias(c) for c in columns])
    return _bracketed(df, columns, by)


def _bracketed(df, columns, by):
    slack = 2.0 / _ACCURACY
    keys = [named(k) for k in by]
    sketch = df.groupBy(*keys).agg(
        *[F.count(named(c)).alias(f"n_{c}") for c in columns],
        *[
            F.percentile_approx(named(c).cast("double"), [0.5 - slack, 0.5 + slack], _ACCURACY).alias(f"b_{c}")
            for c in columns
        ],
    )
    sketch = stage(sketch, "brackets")
    if by:
        bounded = join_on(df, small_or_not(sketch), by)
    else:
        row = sketch.first()  # one row: two bounds and a count per column
        bounded = df.select(
            "*",
            *[F.lit(row[f"n_{c}"]).alias(f"n_{c}") for c in columns],
            *[F.array(*[F.lit(x) for x in row[f"b_{c}"]]).cast("array<double>").alias(f"b_{c}") if row[f"b_{c}"]
              else F.lit(None).cast("array<double>").alias(f"b_{c}") for c in columns],
        )

    def value(c):
        return named(c).cast("double")

    inside = lambda c: value(c).between(named(f"b_{c}")[0], named(f"b_{c}")[1])
    below = bounded.groupBy(*keys).agg(
        *[F.count(F.when(value(c) < named(f"b_{c}")[0], 1)).alias(f"below_{c}") for c in columns],
        *[F.max(named(f"n_{c}")).alias(f"n_{c}") for c in columns],
    )
    below = stage(below.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(c).alias("_column"), named(f"below_{c}").alias("_below"), named(f"n_{c}").alias("_n"))
        for c in columns
    ]))), "below")
    middle = bounded.select(*keys, F.inline(F.array_compact(F.array(*[
        F.when(inside(c), F.struct(F.lit(c).alias("_column"), value(c).alias("_value"))) for c in columns
    ]))))
    distinct = stage(middle.groupBy(*keys, "_column", "_value").agg(F.count(F.lit(1)).alias("_here")), "middle")
    cumulative = running_sums(distinct, [*by, "_column"], ["_value"], {"_upto": "_here"})
    ranked = join_on(cumulative, small_or_not(below), [*by, "_column"]).withColumn("_upto", F.col("_upto") + F.col("_below"))
    low, high = F.expr("(_n - 1) div 2"), F.expr("_n div 2")
    held = F.bool_and(F.col("_below") <= low) & (F.max(F.col("_upto") - high) > 0)
    middle_value = (F.min(F.when(F.col("_upto") > low, F.col("_value"))) + F.min(F.when(F.col("_upto") > high, F.col("_value")))) / 2
    medians = ranked.groupBy(*keys).pivot("_column", list(columns)).agg(
        F.when(held, middle_value).when(held.isNotNull(), F.raise_error(F.lit("a bracket does not hold the middle")).cast("double"))
    )
    missing = [c for c in columns if c not in medians.columns]
    return medians.withColumns({c: F.lit(None).cast("double") for c in missing}) if missing else medians
