"""Forecast scores as aggregate expressions. Truth and prediction are on the log scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import inverse_log


def mse(pred: Column, truth: Column) -> Column:
    return F.avg((pred - truth) * (pred - truth))


def mae_ratio(pred: Column, truth: Column) -> Column:
    """exp of the mean absolute log error: a ratio between prices, not a price."""
    return F.exp(F.avg(F.abs(pred - truth)))


def scores(pred: Column, truth: Column) -> list[Column]:
    return [mse(pred, truth).alias("mse"), mae_ratio(pred, truth).alias("mae_ratio")]


def point_forecast(pred: Column, inverse: str = "expm1") -> Column:
    """One number for a batch: the mean is taken on the log scale."""
    return inverse_log(F.avg(pred), inverse)


def online_forecast(pred: Column, inverse: str = "expm1") -> Column:
    """One number for a micro-batch: the mean is taken in price units."""
    return F.avg(inverse_log(pred, inverse))


def score_rows(df: DataFrame, keys, pred: str, truth: str) -> DataFrame:
    return df.groupBy(*keys).agg(*scores(F.col(pred), F.col(truth)))


def score_batches(df: DataFrame, keys, batch: str, pred: str, truth: str) -> DataFrame:
    """Unweighted mean of per-batch scores; a short last batch weighs as much as a full one."""
    per_batch = df.groupBy(*keys, batch).agg(*scores(F.col(pred), F.col(truth)))
    return per_batch.groupBy(*keys).agg(F.avg("mse").alias("mse"), F.avg("mae_ratio").alias("mae_ratio"))
