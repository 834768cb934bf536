import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import quality_report, report_of_states, state_aggregates
from tidemark.operators.splits import chronological_split, short_groups, walk_forward_folds
from tidemark.plans.learners import fit_on_sums, fold_sums, paired_sums, validation_rows
from tidemark.plans.tuning import RunLog, step_losses
from tidemark.sinks.states import PeriodStates, clock_states, recent_stored
from tidemark.sinks.store import KeyedTable
from tidemark.streaming.online import OnlineModel

MONTHLY = "date_format(dt, 'yyyyMM')"


def files(path):
    return sorted(str(p) for p in path.rglob("*.parquet"))


@pytest.fixture
def table(tmp_path):
    return KeyedTable(str(tmp_path / "t"), period=MONTHLY)


def test_report_from_refreshed_states_is_the_full_report(spark, bars, table, tmp_path):
    table.upsert(bars([("a", d, d + 1) for d in range(100)] + [("b", 3, 5)]))
    states = PeriodStates(table, str(tmp_path / "s"), state_aggregates(dict(table.read(spark).dtypes)))
    states.refresh(spark)
    before = files(tmp_path / "s")
    touched = table.upsert(bars([("a", 40, -7), ("c", 41, float("nan"))]))
    assert touched == ["202402"]
    states.refresh(spark, touched)
    kept = [f for f in before if "period=202402" not in f]
    assert set(kept) < set(files(tmp_path / "s"))
    for by in ([], ["series"]):
        got, want = report_of_states(states.read(spark), by=by), quality_report(table.read(spark), by=by)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    states.refresh(spark, [])
    assert report_of_states(states.read(spark).limit(0)).count() == quality_report(table.read(spark).limit(0)).count()


def test_a_dead_series_does_not_make_all_history_be_read(spark, bars, table, tmp_path):
    table.upsert(bars([("dead", d, d) for d in range(10)] + [("a", d, d) for d in range(200)]))
    states = clock_states(table, str(tmp_path / "s"))
    states.refresh(spark)
    recent = recent_stored(spark, states, 3)
    assert {(r.series, r.dt) for r in recent.select("series", "dt").collect()} == {
        *(("dead", dt.date(2024, 1, d)) for d in (7, 8, 9, 10)), *(("a", dt.date(2024, 7, 18) - dt.timedelta(days=i)) for i in range(4))
    }
    assert {f.split("period=")[1][:6] for f in recent.inputFiles() if "period=" in f} == {"202401", "202407"}


def test_short_groups_are_left_out_or_raise(spark):
    df = spark.createDataFrame([("long", i) for i in range(40)] + [("short", i) for i in range(6)], "series string, dt int")
    with pytest.raises(ValueError, match="short"):
        chronological_split(df, ["series"], ["dt"], 3)
    split = chronological_split(df, ["series"], ["dt"], 3, short="leave_out")
    assert {r.series for r in split.collect()} == {"long"} and split.count() == 40
    with pytest.raises(ValueError, match="shorter"):
        walk_forward_folds(df, ["series"], ["dt"], 5, 2, 1)
    folds = walk_forward_folds(df, ["series"], ["dt"], 5, 2, 1, short="leave_out")
    assert {r.series for r in folds.select("series").distinct().collect()} == {"long"}
    with pytest.raises(ValueError):
        walk_forward_folds(df.where("series = 'short'"), ["series"], ["dt"], 5, 2, 1, short="leave_out")
    assert [tuple(r) for r in short_groups(df, ["series"], 7).collect()] == [("short", 6, 7)]
    with pytest.raises(ValueError, match="leave_out"):
        chronological_split(df, ["series"], ["dt"], 3, short="skip")


def test_steps_begin_at_the_given_weights_and_old_folders_go(spark, tmp_path):
    pairs = lambda rows, s="a": spark.createDataFrame([(s, float(x), float(y)) for x, y in rows], "series string, x double, close double")
    start = spark.createDataFrame([("a", [0.5, 0.3]), ("idle", [1.0, 2.0])], "series string, weights array<double>")
    model = OnlineModel(str(tmp_path / "w"), ["x"], rate=0.1, start=start, kept=2)
    first = {r.series: r for r in model.step(pairs([(1, 1)]), 0).collect()}
    assert first["a"].weights == pytest.approx([0.54, 0.34]) and first["a"].steps == 1
    assert first["idle"].weights == [1.0, 2.0] and first["idle"].steps == 0
    again = OnlineModel(str(tmp_path / "w"), ["x"], rate=0.1, start=start.withColumn("weights", F.array(F.lit(9.0), F.lit(9.0))), kept=2)
    assert {r.series: r.weights for r in again.step(pairs([(1, 1)]), 0).collect()}["a"] == pytest.approx([0.54, 0.34])
    for i in range(1, 5):
        model.step(pairs([(1, 1)], "b"), i)
    assert sorted({r.batch_id for r in model.history(spark).collect()}) == [3, 4]
    with pytest.raises(ValueError, match="two"):
        OnlineModel(str(tmp_path / "v"), ["x"], kept=1)
    with pytest.raises(ValueError, match="starting weights"):
        OnlineModel(str(tmp_path / "u"), ["x", "z"], start=start).step(pairs([(1, 1)]).withColumn("z", F.lit(1.0)), 0)


def test_losses_by_step_and_own_budgets(spark, tmp_path):
    rows = [("s", i, float(i % 7), float(3 * (i % 7) + 1)) for i in range(100)]
    folded = walk_forward_folds(spark.createDataFrame(rows, "series string, dt int, x double, y double"), ["series"], ["dt"], 40, 20, 5)
    sums = paired_sums(fold_sums(folded, ["series"], ["x"], "y"), ["series"])
    paired = sums.join(validation_rows(folded, ["series"], ["x"], "y"), ["series", "fold"])
    configs = [{"config_id": i, "learning_rate": 0.05, "l2": 0.0, "budget": b} for i, b in enumerate((2, 5))]
    fits = fit_on_sums(paired, ["series"], "linear", configs, 99, steps=True)
    of = {(r.fold, r.config_id): r for r in fits.collect()}
    assert {r.epoch for r in of.values()} == {2, 5} and all(len(r.losses) == r.epoch and min(r.losses) == pytest.approx(r.mse) for r in of.values())
    assert of[0, 0].losses == of[0, 1].losses[:2]
    data = folded.where("role = 'validation' AND fold = 0").toPandas()
    w, b = of[0, 1].weights
    assert of[0, 1].mae == pytest.approx((data.x * w + b - data.y).abs().mean())
    log = RunLog(spark, str(tmp_path / "runs"))
    steps = step_losses(fits, ["series"]).groupBy(F.col("config_id").alias("run"), "step").agg(F.avg("mse").alias("value"))
    log.log_steps("p", steps)
    assert sorted((r.run_id, r.step) for r in log.read().collect()) == [("p/0", 1), ("p/0", 2), *[("p/1", i) for i in range(1, 6)]]
