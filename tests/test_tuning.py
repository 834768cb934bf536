import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.metrics import online_forecast, point_forecast, score_batches, score_rows
from tidemark.functions.scalar import inverse_log
from tidemark.operators.gold import gold_features
from tidemark.operators.ordering import last_rows
from tidemark.operators.prepare import Preparation
from tidemark.operators.quality import QualityError
from tidemark.operators.splits import walk_forward_folds
from tidemark.plans.learners import LinearFit, check_learner, fit_linear, fit_on_sums, fold_sums, paired_sums, score_folds
from tidemark.plans.selection import best_candidate, discrepancy, select_production
from tidemark.plans.tuning import RunLog, best_run, brackets, early_stop, run_hyperband, search_space, survivors, walk_forward_evaluator
from tidemark.plans.weekly import WeeklySettings, prepared_splits, production_rows, weekly_run
from tidemark.session import stage


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 4.0)], "p double, t double")
    r = score_rows(df, [], "p", "t").first()
    assert r.mse == 2.0 and r.mae_ratio == pytest.approx(math.e)


def test_batch_mean_and_row_mean(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 1.0), (1, 1.0), (2, 6.0)], "batch_id int, e double")
    df = df.withColumns({"p": F.sqrt("e"), "t": F.lit(0.0)})
    assert score_batches(df, [], "batch_id", "p", "t").first().mse == pytest.approx(8 / 3)
    assert score_rows(df, [], "p", "t").first().mse == pytest.approx(2.0)


def test_forecasts(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "p double")
    r = df.select(point_forecast(F.col("p")), point_forecast(F.col("p"), "exp"), online_forecast(F.col("p"), "exp")).first()
    assert list(r) == pytest.approx([math.expm1(2), math.exp(2), (math.exp(1) + math.exp(3)) / 2])
    with pytest.raises(ValueError):
        inverse_log(F.col("p"), "log")


@pytest.mark.parametrize("losses, patience, want", [
    ([5.0, 4.0, 4.0, 4.0, 3.0], 2, (4.0, 4)),
    ([5.0, 4.0, 3.0], 2, (3.0, 3)),
    ([5.0, 5.0 - 5e-6, 4.0], 10, (4.0, 3)),
    ([], 2, (math.inf, 0)),
])
def test_early_stop(spark, losses, patience, want):
    df = spark.createDataFrame([(losses,)], "l array<double>")
    assert tuple(df.select(early_stop(F.col("l"), patience).alias("s")).first().s) == want


def test_schedules():
    assert brackets(100, 4, "reference") == [(3, 1, 100), (2, 6, 16), (1, 25, 4), (0, 100, 1)]
    # The example of the Hyperband paper.
    assert brackets(81, 3) == [(4, 81, 1), (3, 34, 3), (2, 15, 9), (1, 8, 27), (0, 5, 81)]
    assert brackets(1000, 10)[0][0] == 3


def test_search_space_repeats(spark):
    first, again = search_space(spark, 50, 3).collect(), search_space(spark, 50, 3).collect()
    assert first == again and first != search_space(spark, 50, 4).collect()
    assert all(1e-5 <= r.learning_rate <= 1e-2 for r in first)


def known_loss(spark, seen):
    def evaluate(configs, budget):
        seen.append((len(configs), budget))
        rows = [(c["config_id"], abs(c["config_id"] - 2) + 1.0 / budget, 1.0) for c in configs]
        return spark.createDataFrame(rows, "config_id long, mse double, mae_ratio double")
    return evaluate


def test_hyperband_rounds_and_best(spark, tmp_path):
    seen = []
    log = RunLog(spark, str(tmp_path / "runs"))
    found = run_hyperband(spark, known_loss(spark, seen), budget=9, factor=3, run_log=log)
    assert seen == [(9, 1), (5, 3), (3, 9), (3, 3), (1, 9), (1, 9)]  # round by round, all brackets in each
    assert found.config["config_id"] == 2 and found.mse == pytest.approx(1 / 9)
    assert found.evaluations.count() == sum(n for n, _ in seen)
    best = best_run(log.read()).first()
    assert best.run_id.endswith("/2") and best.mse == pytest.approx(1 / 9)


def test_bracket_ends_without_survivors(spark):
    seen = []
    run_hyperband(spark, known_loss(spark, seen), budget=100, factor=4, schedule="reference")
    assert seen == [(1, 100), (6, 16), (25, 4), (100, 1), (1, 64), (6, 16)]


def test_survivors_order(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, float("nan")), (4, None), (5, 0.5)], "config_id int, mse double")
    assert [r.config_id for r in survivors(df, 3).collect()] == [5, 1, 3]


def linear_rows(spark, n=120, series=("a", "b")):
    rng = np.random.default_rng(1)
    rows = []
    for s in series:
        for i in range(n):
            x, z = rng.normal(), rng.normal()
            rows.append((s, i, float(x), float(z), float(3 * x - z + 2 + 0.01 * rng.normal())))
    return spark.createDataFrame(rows, "series string, dt int, x double, z double, y double")


WINDOWS = dict(train=40, validation=20, gap=5)


def test_ridge_is_least_squares_per_fold(spark):
    df = linear_rows(spark)
    folded = walk_forward_folds(df, ["series"], ["dt"], **WINDOWS)
    config = {"config_id": 0, "learning_rate": 0.1, "l2": 0.0, "max_depth": 2}
    fits = fit_on_sums(paired_sums(fold_sums(folded, ["series"], ["x", "z"], "y"), ["series"]), ["series"], "ridge", [config], 1)
    scored = score_folds(folded, fits, ["series"], ["x", "z"])
    per_fold = {(r.series, r.fold): r.mse for r in score_rows(scored, ["series", "fold"], "pred", "y").collect()}
    data = df.toPandas()
    for r in fits.collect():
        part = data[data.series == r.series].sort_values("dt")
        train = part.iloc[r.fold * 20: r.fold * 20 + 40]
        want, *_ = np.linalg.lstsq(np.c_[train.x, train.z, np.ones(40)], train.y, rcond=None)
        assert r.weights == pytest.approx(want.tolist(), abs=1e-8)
        assert r.mse == pytest.approx(per_fold[r.series, r.fold], rel=1e-6)
    assert len(per_fold) == 6


def test_descent_lowers_the_loss(spark):
    evaluate = walk_forward_evaluator(linear_rows(spark), ["series"], ["dt"], ["x", "z"], "linear", "y", **WINDOWS)
    config = {"config_id": 0, "learning_rate": 0.1, "l2": 0.0, "max_depth": 2}
    few, many = (evaluate([config], b).first().mse for b in (2, 60))
    assert many < few / 10


@pytest.mark.parametrize("learner, rate", [("ridge", 0.1), ("linear", 0.3)])
def test_loss_and_weights_are_of_one_epoch_and_nulls_are_left_out(spark, learner, rate):
    df = linear_rows(spark).unionByName(spark.createDataFrame([("a", 1000, None, 1.0, 5.0), ("b", 1000, 1.0, 1.0, None)], "series string, dt int, x double, z double, y double"))
    folded = walk_forward_folds(df, ["series"], ["dt"], **WINDOWS)
    configs = [{"config_id": i, "learning_rate": rate * (i + 1), "l2": 0.5 * i, "max_depth": 2} for i in range(3)]
    fits = fit_on_sums(paired_sums(fold_sums(folded, ["series"], ["x", "z"], "y"), ["series"]), ["series"], learner, configs, 30, patience=3)
    fits = stage(fits, "fits")
    whole = folded.where("x IS NOT NULL AND y IS NOT NULL")
    per_fold = {(r.series, r.fold, r.config_id): r.mse for r in score_rows(score_folds(whole, fits, ["series"], ["x", "z"]), ["series", "fold", "config_id"], "pred", "y").collect()}
    rows = fits.collect()
    assert len(rows) == 3 * len({(r.series, r.fold) for r in rows})
    for r in rows:
        assert r.mse == pytest.approx(per_fold[r.series, r.fold, r.config_id], rel=1e-5, abs=1e-9) and r.mse >= 0


def test_the_fitted_model_is_the_searched_one(spark, tmp_path):
    rows = linear_rows(spark).select("x", "z", "y")
    config = {"config_id": 0, "learning_rate": 0.1, "l2": 25.0, "max_depth": 2}
    model = fit_linear(rows, "ridge", ["x", "z"], "y", config, 1)
    data = rows.toPandas()
    x = np.c_[data.x, data.z, np.ones(len(data))]
    assert model.weights == pytest.approx(np.linalg.solve(x.T @ x + np.diag([25.0, 25.0, 0.0]), x.T @ data.y).tolist(), rel=1e-8)
    model.save(spark, str(tmp_path / "m"))
    again = LinearFit.load(spark, str(tmp_path / "m"))
    assert [r.pred_ridge for r in again.transform(rows).collect()] == pytest.approx((x @ np.array(model.weights)).tolist())


def test_weekly_run_keeps_models_that_forecast(spark, bars, tmp_path):
    import math

    gold = gold_features(bars([("a" if i % 2 else "b", i // 2, 50 + 10 * math.sin(i / 9) + i / 50) for i in range(700)]))
    space = lambda spark, n, seed: search_space(spark, n, seed).where("config_id = 0")
    settings = WeeklySettings(learners=("ridge", "linear"), test_rows=60, train=80, validation=40, gap=5, budget=4, factor=4,
                              numeric=("open", "30_day_ma_close"), categorical=("month",), space=space)
    chosen = {r.series: r for r in weekly_run(spark, gold, settings, path=str(tmp_path)).collect()}
    held_out = spark.read.parquet(f"{tmp_path}/dataset/prepared").where("split = 'validation'")
    forecast = production_rows(spark, str(tmp_path), held_out)
    scored = {r.series: r.mse for r in score_rows(last_rows(forecast, ["series"], ["dt"], 7), ["series"], "pred", "close").collect()}
    assert scored == pytest.approx({s: r.mse for s, r in chosen.items()}, rel=1e-6)
    assert {r.candidate for r in forecast.select("candidate").distinct().collect()} == {r.candidate for r in chosen.values()}


def test_closed_form_needs_one_round(spark):
    evaluate = walk_forward_evaluator(linear_rows(spark), ["series"], ["dt"], ["x", "z"], "linear", "y", **WINDOWS)
    ridge = evaluate.for_learner("ridge")
    found = run_hyperband(spark, ridge, budget=9, factor=3)
    assert found.evaluations.count() == sum(n for _, n, _ in brackets(9, 3))
    configs = [r.asDict() for r in search_space(spark, found.evaluations.count()).collect()]
    best = survivors(ridge(configs, 1), 1).first()
    assert (found.config["config_id"], found.mse) == (best.config_id, best.mse)
    assert found.mae_ratio == pytest.approx(ridge([found.config], 1).first().mae_ratio) and found.mae_ratio > 1
    assert evaluate.learner == "linear" and evaluate.uses_budget


def test_collinear_features_are_no_trouble(spark):
    df = linear_rows(spark).withColumn("copy", F.col("x"))
    evaluate = walk_forward_evaluator(df, ["series"], ["dt"], ["x", "copy", "z"], "ridge", "y", **WINDOWS)
    assert evaluate([{"config_id": 0, "learning_rate": 0.1, "l2": 0.0, "max_depth": 2}], 1).first().mse < 1e-3


def test_trees(spark):
    evaluate = walk_forward_evaluator(linear_rows(spark, 70, ["a"]), ["series"], ["dt"], ["x", "z"], "gbt", "y", **WINDOWS)
    r = evaluate([{"config_id": 4, "learning_rate": 0.1, "l2": 0.0, "max_depth": 2}], 3).first()
    assert r.config_id == 4 and r.mse > 0 and r.mae_ratio > 1


def test_unknown_learner():
    with pytest.raises(ValueError, match="unknown learner"):
        check_learner("gru")


def test_best_candidate_is_the_least_error_then_the_first_name(spark):
    df = spark.createDataFrame([("b", 1.0, 1.1), ("a", 1.0, 1.1), ("c", None, 1.0), ("d", 2.0, 1.0)], "candidate string, mse double, mae_ratio double")
    assert best_candidate(df).first().candidate == "a"


def test_choice_looks_at_the_newest_rows_only(spark):
    df = spark.range(20).select(
        F.lit("s").alias("series"), F.col("id").alias("dt"), F.lit(0.0).alias("close"),
        F.when(F.col("id") < 13, 0.0).otherwise(1.0).alias("early"), F.when(F.col("id") < 13, 9.0).otherwise(0.5).alias("late"),
    )
    assert select_production(df, {"early": "early", "late": "late"}).first().candidate == "late"


def test_discrepancy_pairs_by_key(spark):
    truth = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)], "series string, dt int, close double")
    pred = spark.createDataFrame([("a", 2, 1.5), ("a", 1, 1.0)], "series string, dt int, p double")
    assert {(r.dt, r.side) for r in discrepancy(truth, pred, "p").collect()} == {(1, "over"), (2, "under")}


def test_dataset_is_kept(spark, bars, tmp_path):
    gold = gold_features(bars([("a", d, d % 7 + 1) for d in range(40)]))
    settings = WeeklySettings(test_rows=5, numeric=("open",), categorical=("month",))
    prepared, preparation = prepared_splits(gold, settings, str(tmp_path))
    assert {(r.split, r["count"]) for r in prepared.groupBy("split").count().collect()} == {
        ("train", 30), ("validation", 5), ("test", 5)}
    train = spark.read.parquet(str(tmp_path / "prepared" / "split=train"))
    assert train.agg(F.avg("open")).first()[0] == pytest.approx(0.0, abs=1e-12)
    again = Preparation.load(spark, str(tmp_path / "preparation"))
    raw = spark.read.parquet(str(tmp_path / "splits"))
    assert again.feature_names == preparation.feature_names == ["open", "month_0"]
    assert again.apply(raw).select("dt", "open", "month_0").exceptAll(prepared.select("dt", "open", "month_0")).isEmpty()


def test_failed_check_stops_the_week(spark, bars):
    with pytest.raises(QualityError):
        weekly_run(spark, bars([("a", d, 0) for d in range(30)]), WeeklySettings(test_rows=5))
