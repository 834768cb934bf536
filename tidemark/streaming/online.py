"""Online learning: one gradient step per micro-batch and group, as sums and a small table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import mse, online_forecast
from tidemark.functions.scalar import is_finite
from tidemark.plans.learners import linear_prediction
from tidemark.schema import SERIES_KEY, TARGET
from tidemark.session import delete_folder, join_on, named, path_exists, stage
from tidemark.streaming.sinks import batch_folder


def step_scale(gradient: Column, clip: float | None) -> Column:
    """Factor on a gradient: 0 when it is not finite, else what brings its norm to `clip` or less."""
    norm = F.sqrt(F.aggregate(gradient, F.lit(0.0), lambda acc, g: acc + g * g))
    scale = F.lit(1.0) if clip is None else F.when(norm > clip, F.lit(clip) / norm).otherwise(1.0)
    return F.when(is_finite(norm), scale).otherwise(0.0)


def gradient_step(
    batch: DataFrame, weights: DataFrame | None, features, target: str = TARGET, rate: float = 0.01,
    clip: float | None = None, keys=SERIES_KEY, inverse: str = "expm1",
) -> DataFrame:
    """(keys..., weights, steps, rows, mse, forecast) after one squared-error step on the batch.

    Scores and forecast are those of the weights before the step. Groups without rows in the
    batch keep their weights; rows with a null feature or target are left out as a whole.
    """
    for c in [*features, target]:
        batch = batch.where(named(c).isNotNull())
    width = len(features) + 1
    zeros = F.array_repeat(F.lit(0.0), width)
    if weights is None:
        rows = batch.withColumn("weights", zeros)
        held = None
    else:
        held = weights.select(*keys, "weights", "steps")
        rows = join_on(batch, held.drop("steps"), keys, "left").withColumn("weights", F.coalesce("weights", zeros))
    rows = rows.withColumn("_pred", linear_prediction(features))
    error = F.col("_pred") - named(target)
    x = [*[named(c).cast("double") for c in features], F.lit(1.0)]
    sums = rows.groupBy(*[named(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.avg(error * xi) * 2.0 for xi in x]).alias("_gradient"),
        mse(F.col("_pred"), named(target)).alias("mse"),
        online_forecast(F.col("_pred"), inverse).alias("forecast"),
    )
    if held is None:
        paired = sums.withColumns({"weights": zeros, "steps": F.lit(0).cast("long")})
    else:
        old = held.withColumnsRenamed({"weights": "_w", "steps": "_s"})
        everyone = held.select(*keys).unionByName(sums.select(*keys)).distinct()
        paired = join_on(join_on(everyone, sums, keys, "left"), old, keys, "left").withColumns({
            "weights": F.coalesce("_w", zeros), "steps": F.coalesce("_s", F.lit(0).cast("long")),
        })
    scale = step_scale(F.col("_gradient"), clip)
    moved = F.zip_with("weights", "_gradient", lambda w, g: w - F.lit(rate) * g * scale)
    # 0 * infinity is not a number, so a step of scale 0 is skipped rather than multiplied out.
    stepped = F.col("_gradient").isNotNull() & (scale > 0)
    return paired.select(
        *[named(k) for k in keys],
        F.when(stepped, moved).otherwise(F.col("weights")).alias("weights"),
        (F.col("steps") + stepped.cast("long")).alias("steps"),
        "rows", "mse", "forecast",
    )


KEPT_BATCHES = 100


class OnlineModel:
    """Weights per group in one folder per micro-batch. A micro-batch that runs again starts from
    the same earlier folder and writes the same rows.

    `start` (keys..., weights), such as `production_weights`, is where the first step begins; it is written beside the folders
    once, so a restarted stream keeps its own. Groups that are not in it begin at zero. The folders of the last
    `kept` micro-batches stay.
    """

    def __init__(
        self, path: str, features, target: str = TARGET, rate: float = 0.01, clip: float | None = None, keys=SERIES_KEY,
        start: DataFrame | None = None, kept: int = KEPT_BATCHES,
    ):
        if kept < 2:
            raise ValueError("a micro-batch that runs again needs the folder before its own: keep two at least")
        self.path, self.features, self.target = path, list(features), target
        self.rate, self.clip, self.keys, self.start, self.kept = rate, clip, list(keys), start, kept

    def _begin(self, spark) -> DataFrame | None:
        if self.start is None:
            return None
        path = f"{self.path}/_start"  # hidden from a reader of all folders
        if not path_exists(spark, f"{path}/_SUCCESS"):
            stage(self.start.select(*[named(k) for k in self.keys], "weights", F.lit(0).cast("long").alias("steps")), path=path)
        held = spark.read.parquet(path)
        wrong = held.where(F.size("weights") != len(self.features) + 1).first()
        if wrong:
            raise ValueError(f"{len(wrong.weights)} starting weights for {len(self.features)} features and an intercept")
        return held

    def weights(self, spark, batch_id: int) -> DataFrame | None:
        return spark.read.parquet(batch_folder(self.path, batch_id)) if batch_id >= 0 else self._begin(spark)

    def step(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        held = self.weights(spark, batch_id - 1)
        after = gradient_step(batch, held, self.features, self.target, self.rate, self.clip, self.keys)
        after = stage(after, path=batch_folder(self.path, batch_id))
        if batch_id >= self.kept:
            delete_folder(spark, batch_folder(self.path, batch_id - self.kept))
        return after

    __call__ = step

    def history(self, spark) -> DataFrame:
        """The rows of the micro-batches that are kept."""
        return spark.read.parquet(self.path)


def fit_batches(model: OnlineModel, batches: DataFrame, batch: str = "batch_id") -> DataFrame:
    """The same steps over a table of ordered batches, one job per batch as each needs the last."""
    ids = [r[0] for r in batches.select(batch).distinct().orderBy(batch).collect()]
    for i, b in enumerate(ids):
        after = model.step(batches.where(F.col(batch) == b).drop(batch), i)
    return after
