"""Declarative checks on one table: all metrics in one aggregation, one result row per rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import is_finite
from tidemark.schema import QUALITY_CHECK, QUALITY_LEVEL, QUALITY_RULES
from tidemark.session import named

_COMPARE = {
    ">": lambda v, bound: v > bound,
    ">=": lambda v, bound: v >= bound,
    "<": lambda v, bound: v < bound,
    "<=": lambda v, bound: v <= bound,
    "=": lambda v, bound: v == bound,
}


class QualityError(RuntimeError):
    pass


def _metric(kind: str, column: str | None, finite: bool = False):
    """`finite`: the column holds floating numbers, of which only finite ones are complete."""
    rows = F.count(F.lit(1))
    if kind == "size":
        return rows.cast("double")
    if kind == "completeness":
        value = named(column)
        return F.try_divide(F.count(F.when(is_finite(value), value) if finite else value), rows)
    if kind == "min":
        return F.min(named(column)).cast("double")
    if kind == "max":
        return F.max(named(column)).cast("double")
    raise ValueError(f"unknown metric {kind!r}")


def quality_report(
    df: DataFrame, rules=QUALITY_RULES, name: str = QUALITY_CHECK, level: str = QUALITY_LEVEL, by=()
) -> DataFrame:
    """(by..., check, level, constraint, column, value, status) for (metric, column, operator, bound) rules."""
    kinds = dict(df.dtypes)
    metrics = df.groupBy(*by).agg(*[
        _metric(kind, c, kinds.get(c) in ("float", "double")).alias(f"_m{i}") for i, (kind, c, _, _) in enumerate(rules)
    ])
    return _judged(metrics, rules, name, level, by)


def _judged(metrics: DataFrame, rules, name: str, level: str, by) -> DataFrame:
    results = F.array(*[
        F.struct(
            F.lit(kind).alias("constraint"),
            F.lit(column).cast("string").alias("column"),
            F.col(f"_m{i}").alias("value"),
            F.when(_COMPARE[op](F.col(f"_m{i}"), F.lit(bound)), "Success").otherwise("Failure").alias("status"),
        )
        for i, (kind, column, op, bound) in enumerate(rules)
    ])
    return metrics.select(*by, F.inline(results)).select(
        *by, F.lit(name).alias("check"), F.lit(level).alias("level"), "constraint", "column", "value", "status"
    )


def state_aggregates(kinds: dict[str, str], rules=QUALITY_RULES) -> dict:
    """Per rule an aggregate that can be merged over parts of a table, for `sinks.states`; `kinds` are the column types."""
    out = {"_rows": F.count(F.lit(1))}
    for i, (kind, column, _, _) in enumerate(rules):
        if kind == "completeness":
            value = named(column)
            floating = kinds.get(column) in ("float", "double")
            out[f"_s{i}"] = F.count(F.when(is_finite(value), value) if floating else value).cast("double")
        elif kind != "size":
            out[f"_s{i}"] = _metric(kind, column)
    return out


def report_of_states(
    states: DataFrame, rules=QUALITY_RULES, name: str = QUALITY_CHECK, level: str = QUALITY_LEVEL, by=()
) -> DataFrame:
    """`quality_report` of a whole table from the states of its parts."""
    merged = []
    for i, (kind, _, _, _) in enumerate(rules):
        state = F.col(f"_s{i}") if kind != "size" else None
        merged.append({
            "size": lambda: F.coalesce(F.sum("_rows"), F.lit(0)).cast("double"),
            "completeness": lambda: F.try_divide(F.sum(state), F.sum("_rows")),
            "min": lambda: F.min(state), "max": lambda: F.max(state),
        }[kind]().alias(f"_m{i}"))
    return _judged(states.groupBy(*by).agg(*merged), rules, name, level, by)


def quality_gate(report: DataFrame) -> None:
    """Stops the caller when a rule failed, naming each failed rule once; the report has the groups."""
    failed = report.where(F.col("status") != "Success").groupBy("constraint", "column").agg(
        F.count(F.lit(1)).alias("groups"), F.min("value").alias("low"), F.max("value").alias("high")
    ).orderBy("constraint", "column").collect()  # a row per rule at most
    if failed:
        said = [f"{r.constraint}({r.column or '*'}) = {r.low if r.low == r.high else f'{r.low} to {r.high}'} in {r.groups} group(s)" for r in failed]
        raise QualityError("; ".join(said))
