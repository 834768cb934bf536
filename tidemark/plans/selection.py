"""Scoring candidates, choosing one, and the tables that compare forecast and truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import point_forecast, scores
from tidemark.functions.scalar import inverse_log, over_under
from tidemark.operators.ordering import last_rows
from tidemark.schema import BAR_KEY, PRODUCTION_WINDOW, SERIES_KEY, TARGET
from tidemark.session import join_on, named


def score_candidates(df: DataFrame, candidates: dict[str, str], truth: str = TARGET, by=()) -> DataFrame:
    """(by..., candidate, mse, mae_ratio): all prediction columns scored in one pass."""
    tall = df.select(
        *[named(k) for k in by], named(truth).alias("_truth"),
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("candidate"), named(column).alias("_pred")) for name, column in sorted(candidates.items())
        ])),
    )
    return tall.groupBy(*[named(k) for k in by], "candidate").agg(*scores(F.col("_pred"), F.col("_truth")))


def best_candidate(scored: DataFrame, by=()) -> DataFrame:
    """Lowest error; ties go to the name that sorts first."""
    known = F.coalesce("mse", F.lit(float("inf"))).alias("mse")
    best = F.min(F.struct(known, F.col("candidate"), F.col("mae_ratio"))).alias("best")
    return scored.groupBy(*[named(k) for k in by]).agg(best).select(*[named(k) for k in by], "best.candidate", "best.mse", "best.mae_ratio")


def select_production(
    validation: DataFrame, candidates: dict[str, str], order=("dt",), truth: str = TARGET,
    window: int = PRODUCTION_WINDOW, by=SERIES_KEY,
) -> DataFrame:
    """The best candidate on the newest `window` validation rows of each group."""
    needed = [*by, *order, truth, *candidates.values()]
    recent = last_rows(validation.select(*[named(c) for c in dict.fromkeys(needed)]), by, order, window)
    return best_candidate(score_candidates(recent, candidates, truth, by), by)


def forecast_rows(scored: DataFrame, pred: str, inverse: str = "expm1") -> DataFrame:
    """Adds the forecast in price units."""
    return scored.withColumn("forecast", inverse_log(named(pred), inverse))


def forecast_summary(scored: DataFrame, pred: str, truth: str = TARGET, by=(), inverse: str = "expm1") -> DataFrame:
    """(by..., forecast, mse, mae_ratio): one number per group."""
    return scored.groupBy(*[named(k) for k in by]).agg(
        point_forecast(named(pred), inverse).alias("forecast"), *scores(named(pred), named(truth))
    )


def discrepancy(truth: DataFrame, predictions: DataFrame, pred: str, keys=BAR_KEY, target: str = TARGET, inverse: str = "expm1") -> DataFrame:
    """(keys..., actual, forecast, side): paired by key, never by position."""
    paired = join_on(truth.select(*keys, target), predictions.select(*keys, named(pred).alias("_pred")), keys, null_safe=False)
    actual, forecast = inverse_log(named(target), inverse), inverse_log(F.col("_pred"), inverse)
    return paired.select(*keys, actual.alias("actual"), forecast.alias("forecast"), over_under(F.col("_pred"), named(target)).alias("side"))
