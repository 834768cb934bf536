"""Two-sample drift tests: Kolmogorov-Smirnov for numbers, chi-square for categories."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordering import running_sums
from tidemark.schema import CLOCK_COLUMNS, DRIFT_LEVEL
from tidemark.session import TASK_ROWS, join_on, named, ship_with_tasks, small_or_not, stage

ship_with_tasks(__name__)

_TERMS = 100


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in CLOCK_COLUMNS]


def as_table(spark, rows) -> DataFrame:
    """A DataFrame as it is, or a list of records as one."""
    return rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows)


def kolmogorov_p(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value, null without a statistic; below 0.2 the cut-off series is not usable and p is 1."""
    n, m = n.cast("double"), m.cast("double")  # the product of two large counts is beyond a bigint
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_TERMS)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * lam * lam),
    )
    return F.when(lam.isNull(), F.lit(None).cast("double")).when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


def tall_values(df: DataFrame, columns, kind: str = "double", by=()) -> DataFrame:
    """(by..., column, value, n = 1) per non-null value."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), named(c).cast(kind).alias("value")) for c in columns])
    tall = df.select(*[named(k) for k in by], F.inline(entries)).where(F.col("value").isNotNull())
    return tall.withColumn("n", F.lit(1).cast("long"))


def count_values(df: DataFrame, columns, kind: str = "double", by=()) -> DataFrame:
    """A sample reduced to its distinct values, to be kept and compared more than once."""
    tall = tall_values(df, columns, kind, by)
    return tall.groupBy(*[named(k) for k in by], "column", "value").agg(F.sum("n").alias("n"))


def _both(reference: DataFrame, current: DataFrame, by) -> DataFrame:
    """(by..., column, value, n_ref, n_cur) of two samples, counted before or not; one shuffle."""
    none = F.lit(0).cast("long")
    sides = reference.select("*", F.col("n").alias("r"), none.alias("c")).unionByName(
        current.select("*", none.alias("r"), F.col("n").alias("c"))
    )
    return sides.groupBy(*[named(k) for k in by], "column", "value").agg(
        F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur")
    )


def ks_drift(
    reference: DataFrame, current: DataFrame, columns=None, by=(), level: float = DRIFT_LEVEL, limit: int = TASK_ROWS
) -> DataFrame:
    """(by..., column, n_ref, n_cur, statistic, p_value, flag) per numeric column."""
    columns = list(columns) if columns else [c for c in numeric_columns(reference) if c in current.columns]
    return ks_of_values(tall_values(reference, columns, by=by), tall_values(current, columns, by=by), by, level, limit)


def ks_of_values(reference: DataFrame, current: DataFrame, by=(), level: float = DRIFT_LEVEL, limit: int = TASK_ROWS) -> DataFrame:
    """`ks_drift` of two samples in tall form; a reference that is kept may be counted already."""
    keys = [*by, "column"]
    counted = stage(_both(reference, current, by), "values")
    steps = running_sums(counted, keys, ["value"], {"c_ref": "n_ref", "c_cur": "n_cur"}, limit)
    totals = stage(counted.groupBy(*keys).agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")), "totals")
    gaps = join_on(steps.drop("n_ref", "n_cur"), small_or_not(totals), keys)
    gap = F.abs(F.try_divide(F.col("c_ref"), F.col("n_ref")) - F.try_divide(F.col("c_cur"), F.col("n_cur")))
    tested = gaps.groupBy(*keys, "n_ref", "n_cur").agg(F.max(gap).alias("statistic"))
    tested = tested.withColumn("p_value", kolmogorov_p(F.col("statistic"), F.col("n_ref"), F.col("n_cur")))
    return with_flag(tested, level)


def with_flag(tested: DataFrame, level: float = DRIFT_LEVEL) -> DataFrame:
    """`untested` where a sample has no values."""
    p = F.col("p_value")
    return tested.withColumn("flag", F.when(p.isNull(), "untested").when(p < level, "drift").otherwise("stable"))


@F.pandas_udf(T.DoubleType())
def chi_square_p(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution; one row per tested column."""
    return pd.Series([None if pd.isna(x) else _upper_gamma(k / 2.0, x / 2.0) if k > 0 else 1.0 for x, k in zip(statistic, freedom)], dtype=object)


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: power series below a+1, continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    b = x + 1 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return h * scale


def chi_square_drift(reference: DataFrame, current: DataFrame, columns, by=(), level: float = DRIFT_LEVEL) -> DataFrame:
    """(by..., column, freedom, statistic, p_value, flag) per categorical column.

    The contingency table is counted in SQL, so categories may be many; only its sums are left
    for the closing formula.
    """
    keys = [*by, "column"]
    counted = stage(_both(*[tall_values(df, columns, "string", by) for df in (reference, current)], by), "values")
    totals = stage(counted.groupBy(*keys).agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur")), "totals")
    cells = join_on(counted, small_or_not(totals), keys)
    share = (F.col("n_ref") + F.col("n_cur")) / (F.col("t_ref") + F.col("t_cur"))
    part = lambda n, t: F.try_divide((F.col(n) - share * F.col(t)) * (F.col(n) - share * F.col(t)), share * F.col(t))
    tested = cells.groupBy(*keys).agg(
        (F.count(F.lit(1)) - 1).alias("freedom"),
        F.when(
            (F.min("t_ref") > 0) & (F.min("t_cur") > 0), F.sum(part("n_ref", "t_ref") + part("n_cur", "t_cur"))
        ).alias("statistic"),
    )
    return with_flag(tested.withColumn("p_value", chi_square_p("statistic", "freedom")), level)
