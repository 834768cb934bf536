"""Linear learners from sufficient statistics, and the combiner of several learners.

Linear fits need a fold's rows only through the sums of x*x', x*y and y*y. Those sums for all
folds of all series come from one aggregation; every configuration is then tried on the sums,
in Spark tasks, without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import CLIP_NORM, PATIENCE, TOLERANCE
from tidemark.session import join_on, named, ship_with_tasks, stage

ship_with_tasks(__name__)

LEARNERS = ("linear", "ridge", "gbt")


def check_learner(name: str) -> str:
    if name not in LEARNERS:
        raise ValueError(f"unknown learner {name!r}; one of {', '.join(LEARNERS)}")
    return name


def fold_sums(folded: DataFrame, keys, features, target: str) -> DataFrame:
    """(keys..., fold, role, n, xx, xy, yy): xx is the upper triangle with the intercept last.

    Rows with a null feature or target are left out of all sums.
    """
    for c in [*features, target]:
        folded = folded.where(named(c).isNotNull())
    x = [*[named(c).cast("double") for c in features], F.lit(1.0)]
    y = named(target).cast("double")
    p = len(x)
    upper = [(i, j) for i in range(p) for j in range(i, p)]
    sums = folded.groupBy(*[named(k) for k in keys], "fold", "role").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x[i] * x[j]).alias(f"_xx{i}_{j}") for i, j in upper],
        *[F.sum(x[i] * y).alias(f"_xy{i}") for i in range(p)],
        F.sum(y * y).alias("yy"),
    )
    return sums.select(
        *[named(k) for k in keys], "fold", "role", "n",
        F.array(*[F.col(f"_xx{i}_{j}") for i, j in upper]).alias("xx"),
        F.array(*[F.col(f"_xy{i}") for i in range(p)]).alias("xy"),
        "yy",
    )


def _matrices(upper: pd.Series, p: int) -> np.ndarray:
    """Symmetric matrices out of their upper triangles, one per row."""
    rows, columns = np.triu_indices(p)
    flat = np.stack(upper.to_list())
    full = np.empty((len(flat), p, p))
    full[:, rows, columns] = flat
    full[:, columns, rows] = flat
    return full


def _product(xx: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.einsum("nij,nj->ni", xx, w)


def validation_rows(folded: DataFrame, keys, features, target: str) -> DataFrame:
    """(keys..., fold, v_rows): the validation rows of a fold as arrays of features, 1 and target.

    A fold validates on a window of fixed length, so a list is bounded by it. Rows with a null are left out, as in the sums.
    """
    rows = folded.where(F.col("role") == "validation")
    for c in [*features, target]:
        rows = rows.where(named(c).isNotNull())
    row = F.array(*[named(c).cast("double") for c in features], F.lit(1.0), named(target).cast("double"))
    return rows.groupBy(*[named(k) for k in keys], "fold").agg(F.collect_list(row).alias("v_rows"))


class _Folds:
    """The sums of some folds as arrays."""

    def __init__(self, batch: pd.DataFrame):
        self.rows = [np.stack(r) for r in batch.v_rows] if "v_rows" in batch else None
        self.xy, self.v_xy = np.stack(batch.xy.to_list()), np.stack(batch.v_xy.to_list())
        self.p = self.xy.shape[1]
        self.xx, self.v_xx = _matrices(batch.xx, self.p), _matrices(batch.v_xx, self.p)
        self.n, self.v_n, self.v_yy = (batch[c].to_numpy(float) for c in ("n", "v_n", "v_yy"))

    def penalty(self, l2: float) -> np.ndarray:
        """No penalty on the intercept."""
        out = np.full(self.p, l2)
        out[-1] = 0.0
        return out

    def validation_loss(self, w: np.ndarray) -> np.ndarray:
        """Mean squared error; rounding may take a perfect fit below zero, which counts as zero."""
        squares = self.v_yy - 2 * (w * self.v_xy).sum(axis=1) + (w * _product(self.v_xx, w)).sum(axis=1)
        return np.maximum(squares / self.v_n, 0.0)

    def absolute_error(self, w: np.ndarray) -> np.ndarray:
        """Mean absolute error on the validation rows, with the weights of each fold."""
        return np.array([np.abs(rows[:, :-1] @ weights - rows[:, -1]).mean() for rows, weights in zip(self.rows, w)])


def _ridge(folds: _Folds, l2: float):
    w = _product(np.linalg.pinv(folds.xx + np.diag(folds.penalty(l2)), hermitian=True), folds.xy)
    loss = folds.validation_loss(w)
    return w, loss, np.ones(len(w), np.int64), loss[:, None]


def _descend(folds: _Folds, rate: float, l2: float, budget: int, patience: int, tol: float):
    """Full-batch gradient descent from the mean; the norm of a gradient is clipped.

    A fold ends when its gradient or loss is not finite, or after `patience` epochs in a row without
    a validation loss lower by more than `tol`. Weights and loss are those of its best epoch; the losses of all
    its epochs come last.
    """
    w = np.zeros_like(folds.xy)
    w[:, -1] = folds.xy[:, -1] / folds.n
    best_w, best = w.copy(), np.full(len(w), np.inf)
    misses, epochs = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
    going, losses = np.ones(len(w), dtype=bool), []
    for epoch in range(budget):
        gradient = 2.0 * (_product(folds.xx, w) - folds.xy) / folds.n[:, None] + 2.0 * folds.penalty(l2) * w
        norm = np.sqrt((gradient * gradient).sum(axis=1))
        going &= np.isfinite(norm)
        if not going.any():
            break
        scale = rate * np.minimum(1.0, CLIP_NORM / np.maximum(norm, CLIP_NORM))
        w[going] -= (scale[:, None] * gradient)[going]
        loss = folds.validation_loss(w)
        losses.append(loss)
        going &= np.isfinite(loss)
        better = going & (loss + tol < best)
        best[better], best_w[better] = loss[better], w[better]
        misses = np.where(better, 0, misses + going)
        epochs[going] = epoch + 1
        going &= misses < patience
    return best_w, best, epochs, np.stack(losses, axis=1) if losses else np.empty((len(w), 0))


def paired_sums(sums: DataFrame, keys) -> DataFrame:
    """One row per fold: its train sums and, as `v_...`, its validation sums."""
    train = sums.where(F.col("role") == "train").drop("role")
    other = sums.where(F.col("role") == "validation").drop("role")
    return join_on(train, other.withColumnsRenamed({c: f"v_{c}" for c in ("n", "xx", "xy", "yy")}), [*keys, "fold"])


SLICE_FOLDS = 256  # folds whose matrices a task holds at a time


def fit_on_sums(
    paired: DataFrame, keys, learner: str, configs, budget: int, patience: int = PATIENCE, tol: float = TOLERANCE, steps: bool = False
) -> DataFrame:
    """(keys..., fold, config_id, weights, mse, epoch) for every fold and configuration.

    The sums of a fold move once; its task tries all configurations. `weights` and `mse`, the
    validation loss, are of the best epoch; `epoch` is the last one run. A configuration with a `budget` of its own
    keeps to that. With `v_rows` in `paired`, `mae` has the mean absolute error of the same weights; `steps`
    adds `losses`, the validation loss of every epoch run.
    """
    # a number of partitions, as the rows are few bytes and much work and would be put into one task
    tasks = int(paired.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = paired.repartition(tasks, *[named(k) for k in keys], "fold")
    schema = T.StructType([f for f in spread.schema.fields if f.name in [*keys, "fold"]]).add("config_id", T.LongType())
    schema = schema.add("weights", T.ArrayType(T.DoubleType())).add("mse", T.DoubleType()).add("epoch", T.LongType())
    with_rows = "v_rows" in paired.columns
    if with_rows:
        schema = schema.add("mae", T.DoubleType())
    if steps:
        schema = schema.add("losses", T.ArrayType(T.DoubleType()))
    tried = [(c["config_id"], float(c["learning_rate"]), float(c["l2"]), int(c.get("budget", budget))) for c in configs]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), SLICE_FOLDS):
                part = batch.iloc[first:first + SLICE_FOLDS]
                folds = _Folds(part)
                for config_id, rate, l2, epochs in tried:
                    fit = _ridge(folds, l2) if learner == "ridge" else _descend(folds, rate, l2, epochs, patience, tol)
                    fitted = part[[*keys, "fold"]].copy()
                    fitted["config_id"] = config_id
                    fitted["weights"], fitted["mse"], fitted["epoch"] = list(fit[0]), fit[1], fit[2]
                    if with_rows:
                        fitted["mae"] = folds.absolute_error(fit[0])
                    if steps:
                        fitted["losses"] = [row[:n] for row, n in zip(fit[3], fit[2])]
                    yield fitted

    return spread.mapInPandas(solve, schema)


def linear_prediction(features, weights: str = "weights") -> Column:
    """Prediction of a row from an array of weights, intercept last."""
    total = F.col(weights)[len(features)]
    for i, c in enumerate(features):
        total = total + named(c).cast("double") * F.col(weights)[i]
    return total


def score_folds(folded: DataFrame, fits: DataFrame, keys, features) -> DataFrame:
    """Validation rows of each fold with `pred` of its own fit; the fits are joined by fold."""
    rows = folded.where(F.col("role") == "validation")
    fitted = fits.select(*[named(k) for k in keys], "fold", "config_id", "weights")
    return join_on(rows, fitted, [*keys, "fold"]).withColumn("pred", linear_prediction(features)).drop("weights")


class LinearFit:
    """A linear model with the weights of `fit_linear`; used like an MLlib model."""

    def __init__(self, name: str, features, weights):
        self.name, self.features, self.weights = name, list(features), [float(w) for w in weights]

    def transform(self, rows: DataFrame) -> DataFrame:
        held = rows.withColumn("_weights", F.array(*[F.lit(w) for w in self.weights]))
        return held.withColumn(f"pred_{self.name}", linear_prediction(self.features, "_weights")).drop("_weights")

    def save(self, spark, path: str) -> None:
        spark.createDataFrame([(self.name, self.features, self.weights)], "name string, features array<string>, weights array<double>").coalesce(
            1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "LinearFit":
        return LinearFit(*spark.read.parquet(path).first())


def fit_linear(train: DataFrame, name: str, features, target: str, config: dict, budget: int) -> LinearFit:
    """The model that a search tried, on all train rows: the same solver on their sums, with the
    same setting. Descent keeps its best epoch on the train rows."""
    check_learner(name)
    rows = train.select(*[named(c) for c in features], named(target), F.lit(0).alias("fold"))
    sums = stage(fold_sums(rows.withColumn("role", F.lit("train")), [], features, target), "sums")  # read twice
    both = sums.unionByName(sums.withColumn("role", F.lit("validation")))
    fitted = fit_on_sums(paired_sums(both, []), [], name, [config], budget).first()
    return LinearFit(name, features, fitted.weights)


def stack_forecasts(train: DataFrame, predictions, target: str):
    """Linear combiner over the predictions of several models, fitted on their rows."""
    assembler = VectorAssembler(inputCols=list(predictions), outputCol="_experts")
    combiner = LinearRegression(featuresCol="_experts", labelCol=target, predictionCol="pred_stacked")
    return Pipeline(stages=[assembler, combiner]).fit(train)
