"""The weekly run: check, tune, choose. A failed check stops it before any tuning."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.prepare import Preparation, fit
from tidemark.operators.quality import quality_gate, quality_report
from tidemark.operators.splits import chronological_split
from tidemark.plans.learners import LEARNERS, LinearFit, fit_linear, stack_forecasts
from tidemark.plans.selection import select_production
from tidemark.plans.trees import TreeFit, fit_tree_model
from tidemark.plans.tuning import RunLog, run_hyperband, search_space, walk_forward_evaluator
from tidemark.schema import DEFAULT_CATEGORICAL, DEFAULT_NUMERIC, FOLD_GAP, HALVING_FACTOR, SERIES_KEY, TARGET, TEST_ROWS, TRAIN_WINDOW, VALIDATION_WINDOW
from tidemark.session import join_on, path_exists, scratch_path, small_or_not, stage
from tidemark.sinks.store import read_layer, write_splits


@dataclass(frozen=True)
class WeeklySettings:
    learners: tuple[str, ...] = ("linear", "ridge", "gbt")
    test_rows: int = TEST_ROWS
    train: int = TRAIN_WINDOW
    validation: int = VALIDATION_WINDOW
    gap: int = FOLD_GAP
    budget: int = 1000
    factor: int = HALVING_FACTOR
    schedule: str = "published"
    space: Callable = search_space
    stacked: bool = True
    numeric: tuple[str, ...] = tuple(DEFAULT_NUMERIC)
    categorical: tuple[str, ...] = tuple(DEFAULT_CATEGORICAL)
    seed: int = 0
    short: str = "raise"  # or leave_out: series too short for a split or a fold go without a model


def prepared_splits(gold: DataFrame, settings: WeeklySettings, path: str | None = None):
    """(prepared rows with `split`, the fitted preparation). Statistics come from train rows only.

    Kept under `path` (scratch when not given): `splits` and `prepared`, a folder per split in
    each, and `preparation`. The key (series, dt) stays beside the prepared block.
    """
    spark = gold.sparkSession
    path = path or scratch_path(spark, "dataset")
    write_splits(chronological_split(gold, SERIES_KEY, ["dt"], settings.test_rows, settings.short), f"{path}/splits")
    labelled = read_layer(spark, f"{path}/splits")
    train = labelled.where(F.col("split") == "train")
    preparation = fit(train, settings.numeric, settings.categorical, ["dt"], path=f"{path}/preparation")
    write_splits(preparation.apply(labelled), f"{path}/prepared")
    return read_layer(spark, f"{path}/prepared"), preparation


def weekly_run(
    spark: SparkSession, gold: DataFrame, settings: WeeklySettings, run_log: RunLog | None = None, path: str | None = None
) -> DataFrame:
    """(series, candidate, mse, mae_ratio) of the chosen model per series.

    With `path`, the preparation, the models and the choice are kept there for `production_rows`.
    """
    quality_gate(quality_report(gold))
    prepared, preparation = prepared_splits(gold, settings, path and f"{path}/dataset")
    train = prepared.where(F.col("split") == "train")
    held_out = prepared.where(F.col("split") == "validation")
    features = preparation.feature_names
    candidates = {}
    fitted_on, chosen_on = train, held_out
    linear = None  # linear learners share one pass over the rows
    for learner in settings.learners:
        if linear is not None and learner != "gbt":
            evaluate = linear.for_learner(learner)
        else:
            evaluate = walk_forward_evaluator(
                train, SERIES_KEY, ["dt"], features, learner, TARGET,
                train=settings.train, validation=settings.validation, gap=settings.gap, short=settings.short,
            )
            linear = linear if learner == "gbt" else evaluate
        found = run_hyperband(
            spark, evaluate, settings.budget, settings.factor, settings.seed, settings.schedule, settings.space, run_log
        )
        # the model kept is the one searched: same solver, setting and budget
        if learner == "gbt":
            model = fit_tree_model(train, features, TARGET, found.config["max_depth"], found.budget)
        else:
            model = fit_linear(train, learner, features, TARGET, found.config, found.budget)
        if path:
            _save(spark, model, f"{path}/{learner}")
        candidates[learner] = f"pred_{learner}"
        fitted_on, chosen_on = (model.transform(rows) for rows in (fitted_on, chosen_on))
    if settings.stacked and len(candidates) > 1:
        experts = list(candidates.values())
        stacked = stack_forecasts(fitted_on, experts, TARGET)
        if path:
            _save(spark, stacked, f"{path}/stacked")
        chosen_on = stacked.transform(chosen_on).drop("_experts")
        candidates["stacked"] = "pred_stacked"
    chosen = select_production(chosen_on, candidates, by=SERIES_KEY)
    return stage(chosen, path=f"{path}/choice") if path else chosen


def _save(spark: SparkSession, model, path: str) -> None:
    model.save(spark, path) if isinstance(model, (LinearFit, TreeFit)) else model.write().overwrite().save(path)


def production_rows(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Prepared rows with `candidate` and `pred`, the forecast of the model chosen for their series.

    `path` is that of a weekly run. Series without a choice are left out.
    """
    choice = spark.read.parquet(f"{path}/choice").select(*SERIES_KEY, "candidate")
    rows = join_on(rows, small_or_not(choice), SERIES_KEY, "inner")
    wanted = [r.candidate for r in choice.select("candidate").distinct().collect()]  # at most one per learner
    learners = [n for n in LEARNERS if path_exists(spark, f"{path}/{n}")] if "stacked" in wanted else [n for n in LEARNERS if n in wanted]
    for name in learners:
        rows = (TreeFit if name == "gbt" else LinearFit).load(spark, f"{path}/{name}").transform(rows)
    if "stacked" in wanted:
        rows = PipelineModel.load(f"{path}/stacked").transform(rows).drop("_experts")
        learners = [*learners, "stacked"]
    pred = F.coalesce(*[F.when(F.col("candidate") == name, F.col(f"pred_{name}")) for name in learners])
    return rows.withColumn("pred", pred).drop(*[f"pred_{name}" for name in learners])


def production_weights(spark: SparkSession, path: str) -> DataFrame:
    """(series, weights): the linear weights, intercept last, from which online steps of a series start.

    `path` is that of a weekly run. They are those of the chosen model; a series whose choice is not linear
    takes those of the first linear learner that the run kept.
    """
    kept = {n: LinearFit.load(spark, f"{path}/{n}") for n in LEARNERS if n != "gbt" and path_exists(spark, f"{path}/{n}")}
    if not kept:
        raise ValueError(f"{path} holds no linear model to start from")
    weights = {n: F.array(*[F.lit(w) for w in fit.weights]) for n, fit in kept.items()}
    chosen = F.coalesce(*[F.when(F.col("candidate") == n, w) for n, w in weights.items()], next(iter(weights.values())))
    return spark.read.parquet(f"{path}/choice").select(*SERIES_KEY, chosen.alias("weights"))


def production_preparation(spark: SparkSession, path: str) -> Preparation:
    """The preparation that the models of a weekly run were fitted with."""
    return Preparation.load(spark, f"{path}/dataset/preparation")
