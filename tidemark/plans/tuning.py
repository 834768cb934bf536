"""Random search spaces, early stopping, Hyperband and the run log."""

from __future__ import annotations

import math
import uuid
from copy import copy
from dataclasses import dataclass
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.splits import walk_forward_folds
from tidemark.plans.learners import check_learner, fit_on_sums, fold_sums, paired_sums, validation_rows
from tidemark.plans.trees import bin_edges, fit_trees, pack
from tidemark.schema import HALVING_FACTOR, HYPERBAND_BUDGET, LEARNING_RATE_RANGE, PATIENCE, TARGET, TOLERANCE
from tidemark.session import join_on, named, stage

EVALUATIONS_SCHEMA = "bracket int, round int, budget int, config_id bigint, mse double, mae_ratio double"
RUNS_SCHEMA = "run_id string, parent string, kind string, key string, value string, number double, step bigint"


def search_space(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """`n` random configurations, drawn by a digest of number, seed and parameter; the same seed gives the same ones."""
    def unit(label):
        digest = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed)), F.lit(label)))
        return F.conv(F.substring(digest, 1, 7), 16, 10).cast("double") / F.lit(float(1 << 28))

    low, high = LEARNING_RATE_RANGE
    return spark.range(n).select(
        F.col("id").alias("config_id"),
        (unit("rate") * (high - low) + low).alias("learning_rate"),
        F.pow(F.lit(10.0), unit("l2") * 6 - 4).alias("l2"),
        (F.floor(unit("depth") * 5) + 2).cast("int").alias("max_depth"),
    )


def early_stop(losses: Column, patience: int = PATIENCE, tol: float = TOLERANCE) -> Column:
    """struct(best, epoch): lowest loss that improved by more than `tol`, and the epoch it ended at.

    Ends after `patience` epochs in a row without such an improvement; later losses are not seen.
    """
    start = F.struct(
        F.lit(float("inf")).alias("best"), F.lit(0).alias("misses"), F.lit(0).alias("epoch"), F.lit(False).alias("done")
    )

    def step(acc, loss):
        better = loss + tol < acc["best"]
        misses = F.when(better, 0).otherwise(acc["misses"] + 1)
        moved = F.struct(
            F.when(better, loss).otherwise(acc["best"]).alias("best"),
            misses.alias("misses"),
            (acc["epoch"] + 1).alias("epoch"),
            (misses >= patience).alias("done"),
        )
        return F.when(acc["done"], acc).otherwise(moved)

    return F.aggregate(losses, start, step, lambda acc: F.struct(acc["best"], acc["epoch"]))


def brackets(budget: int = HYPERBAND_BUDGET, factor: int = HALVING_FACTOR, schedule: str = "published"):
    """(s, configurations, first budget) per bracket.

    `published` is the formula of the Hyperband paper; `reference` gives budget // factor^s
    configurations to bracket s, so the bracket with the most rounds has the fewest.
    """
    if schedule not in ("published", "reference"):
        raise ValueError(f"unknown schedule {schedule!r}")
    s_max = 0
    while factor ** (s_max + 1) <= budget:
        s_max += 1
    out = []
    for s in range(s_max, -1, -1):
        if schedule == "published":
            out.append((s, -(-(s_max + 1) * factor**s // (s + 1)), max(1, budget // factor**s)))
        else:
            n = budget // factor**s
            out.append((s, n, budget // n))
    return out


@dataclass
class SearchResult:
    """Best configuration with its budget and score, and every evaluation as a table."""

    config: dict
    budget: int
    mse: float
    mae_ratio: float
    evaluations: DataFrame


def survivors(results: DataFrame, keep: int) -> DataFrame:
    """The `keep` best configurations; ties go to the smaller id, a missing score is last."""
    return results.orderBy(F.coalesce("mse", F.lit(float("inf"))), "config_id").limit(keep)


def ranked_in_brackets(results: DataFrame, bracket_of: dict[int, int]) -> DataFrame:
    """Results with the bracket of their configuration and their rank in it; ties and missing scores as in `survivors`."""
    places = results.sparkSession.createDataFrame(sorted(bracket_of.items()), "config_id long, bracket int")
    worst = F.coalesce("mse", F.lit(float("inf")))
    order = Window.partitionBy("bracket").orderBy(worst, "config_id")
    return results.join(F.broadcast(places), "config_id").withColumn("rank", F.row_number().over(order))


def _evaluated(evaluate, tried) -> DataFrame:
    """Scores of (configurations, budget) pairs, in one plan."""
    if hasattr(evaluate, "together"):
        return evaluate.together(tried)
    return reduce(DataFrame.unionByName, [evaluate(configs, budget) for configs, budget in tried])


def run_hyperband(
    spark: SparkSession, evaluate, budget: int = HYPERBAND_BUDGET, factor: int = HALVING_FACTOR, seed: int = 0,
    schedule: str = "published", space=search_space, run_log: "RunLog | None" = None,
) -> SearchResult:
    """Brackets of successive halving, which all advance together: a round of all of them is one Spark job.

    `evaluate(configs, budget)` gives (config_id, mse, mae_ratio); with a method `together`, all pairs of
    configurations and budgets of a round are handed over at once. The survivors of all brackets come from one
    window. Only scores, at most one row per configuration, come to the driver. When scores do not depend
    on the budget, one round over the configurations of all brackets gives the same best.
    """
    evaluations, best = [], None
    plan = brackets(budget, factor, schedule)
    if not getattr(evaluate, "uses_budget", True):
        plan = [(0, sum(n for _, n, _ in plan), budget)]
    drawn = iter([r.asDict() for r in space(spark, sum(n for _, n, _ in plan), seed).orderBy("config_id").collect()])
    parent = run_log.start(params={"budget": budget, "factor": factor, "schedule": schedule}) if run_log else None
    live = {s: list(islice(drawn, n)) for s, n, _ in plan}
    first_budget = {s: r for s, _, r in plan}
    number = 0
    while live:
        budgets = {s: first_budget[s] * factor**number for s in live}
        bracket_of = {c["config_id"]: s for s, configs in live.items() for c in configs}
        by_id = {c["config_id"]: c for configs in live.values() for c in configs}
        results = _evaluated(evaluate, [(configs, budgets[s]) for s, configs in live.items()])
        rows = ranked_in_brackets(results, bracket_of).orderBy(F.col("bracket").desc(), "rank").collect()
        evaluations += [(r.bracket, number, budgets[r.bracket], r.config_id, r.mse, r.mae_ratio) for r in rows]
        for r in rows:
            if r["rank"] == 1 and _is_number(r.mse) and (best is None or r.mse < best[1].mse):
                best = (by_id[r.config_id], r, budgets[r.bracket])
        if run_log:
            for s, configs in live.items():
                run_log.log_round(parent, s, number, budgets[s], configs, [r for r in rows if r.bracket == s])
        keep = {s: len(configs) // factor for s, configs in live.items()}
        left = {s: [by_id[r.config_id] for r in rows if r.bracket == s and r["rank"] <= keep[s]] for s in live if s > number}
        live = {s: configs for s, configs in left.items() if configs}
        number += 1
    if best is None:
        raise RuntimeError("no configuration gave a finite score")
    config, score, round_budget = best
    if run_log:
        run_log.log(parent, metrics={"best_mse": score.mse, "best_mae_ratio": score.mae_ratio}, params=config)
    return SearchResult(config, round_budget, score.mse, score.mae_ratio, spark.createDataFrame(evaluations, EVALUATIONS_SCHEMA))


def _is_number(x) -> bool:
    return x is not None and math.isfinite(x)


class RunLog:
    """Appends runs to a Parquet table; queries on it are plain SQL."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def start(self, parent: str | None = None, params: dict | None = None, run_id: str | None = None) -> str:
        run_id = run_id or uuid.uuid4().hex
        self.log(run_id, parent=parent, params={"started": "true", **(params or {})})
        return run_id

    def log(self, run_id, parent=None, params=None, metrics=None, step=None) -> None:
        rows = [(run_id, parent, "param", k, str(v), None, step) for k, v in (params or {}).items()]
        rows += [(run_id, parent, "metric", k, None, float(v), step) for k, v in (metrics or {}).items() if v is not None]
        self._append(rows)

    def log_round(self, parent, bracket, number, budget, configs, results) -> None:
        by_id = {c["config_id"]: c for c in configs}
        rows = []
        for r in results:
            child = f"{parent}/{bracket}/{number}/{r.config_id}"
            rows += [(child, parent, "param", k, str(v), None, None) for k, v in by_id[r.config_id].items()]
            rows += [(child, parent, "metric", k, None, r[k], budget) for k in ("mse", "mae_ratio") if r[k] is not None]
        self._append(rows)

    def log_steps(self, parent: str, steps: DataFrame, metric: str = "mse") -> None:
        """A metric per step, written by the tasks that have it: `steps` (run, step, value), runs under `parent`."""
        null = F.lit(None).cast("string")
        steps.select(
            F.concat(F.lit(f"{parent}/"), F.col("run").cast("string")).alias("run_id"), F.lit(parent).alias("parent"),
            F.lit("metric").alias("kind"), F.lit(metric).alias("key"), null.alias("value"),
            F.col("value").cast("double").alias("number"), F.col("step").cast("long").alias("step"),
        ).write.mode("append").parquet(self.path)

    def _append(self, rows) -> None:
        if rows:
            self.spark.createDataFrame(rows, RUNS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUNS_SCHEMA).parquet(self.path)


def best_run(runs: DataFrame, metric: str = "mse") -> DataFrame:
    """Per parent, the child with the lowest metric."""
    children = runs.where((F.col("kind") == "metric") & (F.col("key") == metric) & F.col("parent").isNotNull())
    return children.groupBy("parent").agg(
        F.min(F.struct(F.col("number").alias("value"), F.col("run_id"))).alias("best")
    ).select("parent", "best.run_id", F.col("best.value").alias(metric))


def mean_over_folds(per_fold: DataFrame, by=("config_id",)) -> DataFrame:
    return per_fold.groupBy(*by).agg(F.avg("mse").alias("mse"), F.avg("mae_ratio").alias("mae_ratio"))


def with_budgets(tried) -> list[dict]:
    """The configurations of (configurations, budget) pairs, each with its budget."""
    return [{**c, "budget": int(budget)} for configs, budget in tried for c in configs]


def step_losses(fits: DataFrame, keys) -> DataFrame:
    """(keys..., fold, config_id, step, mse) of fits made with `steps`; steps count from 1."""
    of = [*[named(k) for k in keys], "fold", "config_id"]
    return fits.select(*of, F.posexplode("losses").alias("step", "mse")).withColumn("step", F.col("step") + 1)


class WalkForwardEvaluator:
    """An `evaluate` for Hyperband: walk-forward folds of every series, averaged per configuration.

    Linear learners are fitted on the staged sums of each fold, which give the MSE; the validation rows of
    the fold lie beside them, so the task that fits it takes the MAE of all its configurations too.
    """

    def __init__(self, folded: DataFrame, keys, features, learner: str, target: str, patience: int, tol: float):
        self.keys, self.learner, self.patience, self.tol = keys, learner, patience, tol
        sums = paired_sums(stage(fold_sums(folded, keys, features, target), "sums"), keys)
        self.paired = stage(join_on(sums, validation_rows(folded, keys, features, target), [*keys, "fold"]), "paired")

    @property
    def uses_budget(self) -> bool:
        """The closed form has no iterations, so more budget gives the same scores."""
        return self.learner != "ridge"

    def for_learner(self, learner: str) -> "WalkForwardEvaluator":
        """The same folds and sums for another linear learner."""
        other = copy(self)
        other.learner = learner
        return other

    def fits(self, configs, budget, steps: bool = False) -> DataFrame:
        return fit_on_sums(self.paired, self.keys, self.learner, configs, budget, self.patience, self.tol, steps)

    def __call__(self, configs, budget) -> DataFrame:
        return self.together([(configs, budget)])

    def together(self, tried) -> DataFrame:
        return mean_over_folds(self.fits(with_budgets(tried), 0).withColumn("mae_ratio", F.exp("mae")))


def walk_forward_evaluator(
    df: DataFrame, keys, order, features, learner: str, target: str = TARGET, bound: int | None = None,
    patience: int = PATIENCE, tol: float = TOLERANCE, **windows,
):
    """The evaluator of a learner: sums of each fold for linear ones, histograms for boosted trees."""
    check_learner(learner)
    folded = walk_forward_folds(df, keys, order, bound=bound, **windows)
    if learner == "gbt":
        return TreeEvaluator(df, folded, features, target, patience, tol)
    return WalkForwardEvaluator(folded, keys, features, learner, target, patience, tol)


class TreeEvaluator:
    """An `evaluate` of boosted trees: the series of a fold position pooled, scores averaged over the positions.

    The rows are cut into bins and packed once. A configuration counts by its depth, and the trees of a small budget are
    the first ones of a larger, so each depth is grown once a round, for all folds together.
    """

    def __init__(self, df: DataFrame, folded: DataFrame, features, target: str, patience: int, tol: float):
        self.patience, self.tol = patience, tol
        self.edges = bin_edges(df, features)
        self.chunks = pack(folded, ["fold"], features, target, self.edges)

    def fits(self, tried) -> DataFrame:
        """(config_id, fold, budget, mse, mae, losses): one row per configuration and fold, of the best tree within the budget."""
        configs = [(c["config_id"], int(c["max_depth"]), c["budget"]) for c in with_budgets(tried)]
        grown = fit_trees(self.chunks, ["fold"], [d for _, d, _ in configs], max(b for _, _, b in configs), self.patience, self.tol)
        wanted = grown.sparkSession.createDataFrame(configs, "config_id long, max_depth int, budget int")
        each = grown.drop("mse", "mae").join(F.broadcast(wanted), "max_depth")  # one row per configuration of a round
        seen = each.withColumn("losses", F.slice("losses", F.lit(1), F.col("budget")))
        best = seen.withColumn("mse", early_stop(F.col("losses"), self.patience, self.tol)["best"])
        at = F.array_position("losses", F.col("mse")).cast("int")
        return best.select("config_id", "fold", "budget", "mse", F.element_at("maes", at).alias("mae"), "losses")

    def __call__(self, configs, budget) -> DataFrame:
        return self.together([(configs, budget)])

    def together(self, tried) -> DataFrame:
        return mean_over_folds(self.fits(tried).withColumn("mae_ratio", F.exp("mae")))
