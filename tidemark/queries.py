"""Registered queries: each runs a job of the library over the whole test tables.

Outputs are put in plain types (text for dates, rounded doubles) so that they can be compared
with the SQL of `oracles.py`.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.metrics import online_forecast, point_forecast, score_batches, score_rows
from tidemark.operators import bars as B
from tidemark.operators import drift as D
from tidemark.operators import gold as G
from tidemark.operators import prepare as P
from tidemark.operators import quality as Q
from tidemark.operators import silver as S
from tidemark.operators import splits as X
from tidemark.operators.ordering import row_index, running_sums
from tidemark.operators.quantile import exact_medians
from tidemark.plans import learners as L
from tidemark.plans import selection as C
from tidemark.plans import tuning as H
from tidemark.plans.lakehouse import Lakehouse, run_lakehouse
from tidemark.plans.weekly import WeeklySettings, production_preparation, production_rows, production_weights, weekly_run
from tidemark.schema import PAYLOAD_FIELDS, SERIES_KEY
from tidemark.session import DATE_DOMAIN_ROWS, named, scratch_path, stage
from tidemark.sinks.landing import land_payloads, make_payloads
from tidemark.sinks.log import AppendedTable
from tidemark.sinks.states import PeriodStates, clock_states, recent_stored
from tidemark.sinks.store import KeyedTable, write_splits
from tidemark.sources import messages as M
from tidemark.sources import payload as Y
from tidemark.sources import windows as R
from tidemark.streaming import ingest as I
from tidemark.streaming import layers as A
from tidemark.streaming.keyed_replay import newest_buffers, replay_stream
from tidemark.streaming.learner import ReplayLearner
from tidemark.streaming.online import OnlineModel, gradient_step
from tidemark.streaming.replay import ReplayBuffer, recency_sample
from tidemark.streaming.sinks import append_sink, decode_sink, fan_out, upsert_sink

# Window sizes of the registered queries: the defaults scaled to the daily bars of one series.
TRAIN, VALIDATION, GAP = 100, 50, 10
TEST = 100
FEATURES = ["open", "high", "low"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        c = named(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(f.name))
    return df.select(*columns)


# --- inputs ------------------------------------------------------------------


def daily(spark, sf_dir) -> DataFrame:
    return B.build_daily_bars(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey")


def minutes(spark, sf_dir) -> DataFrame:
    return B.build_bars(table(spark, sf_dir, "events"), "event_type", "ts", "value", "1 minute", "event_id")


def intraday(spark, sf_dir) -> DataFrame:
    return I.bars_to_silver(minutes(spark, sf_dir))


def daily_gold(spark, sf_dir) -> DataFrame:
    return G.gold_features(daily(spark, sf_dir))


def candidates(gold: DataFrame) -> DataFrame:
    """Gold with three simple log-scale forecasts of the close."""
    return gold.withColumns({
        "pred_mean": F.log1p(F.col("`30_day_ma_close`")),
        "pred_open": F.log1p(F.col("open").cast("double")),
        "pred_mid": F.log1p((F.col("high").cast("double") + F.col("low").cast("double")) / 2),
    })


CANDIDATES = {"mean": "pred_mean", "open": "pred_open", "mid": "pred_mid"}


def thousands(df: DataFrame) -> DataFrame:
    """Prices in units of 100,000, so that sums of squares stay well scaled."""
    return df.withColumns({c: F.col(c).cast("double") / 100000.0 for c in FEATURES})


# Number of the micro-batch of an event.
EVENT_PART = (
    "CASE WHEN ts >= TIMESTAMP_NTZ '2024-01-21 12:00:30' THEN 2 "
    "WHEN ts >= TIMESTAMP_NTZ '2024-01-21 11:00:30' AND event_id % 2 = 0 THEN 2 "
    "WHEN ts >= TIMESTAMP_NTZ '2024-01-11 00:00:30' THEN 1 ELSE 0 END"
)

# A group limit that makes the ranged forms run on small tables too.
SPLIT_ROWS = 1000


# --- bars, silver, gold --------------------------------------------------------


def daily_bars(spark, sf_dir):
    return plain(daily(spark, sf_dir), 3)


def minute_bars(spark, sf_dir):
    return plain(minutes(spark, sf_dir))


def silver_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    land_payloads(make_payloads(daily(spark, sf_dir)), path)
    typed = S.type_bars(Y.explode_payloads(Y.read_payloads(spark, path)))
    return plain(S.accepted(typed), 3)


def _damaged(spark, sf_dir) -> DataFrame:
    """Payloads in which bars of the 13th lack a field, of the 14th have a bad date, of the 15th a bad number."""
    day = F.dayofmonth("dt")
    text = {f: F.col(c).cast("string") for c, f in PAYLOAD_FIELDS.items()}
    text["3. low"] = F.when(day != 13, text["3. low"])
    text["5. volume"] = F.when(day == 15, F.lit("many")).when(day == 16, F.lit("3000000000")).otherwise(text["5. volume"])
    entry = F.struct(
        F.concat(F.date_format("dt", "yyyy-MM-dd"), F.when(day == 14, "x").otherwise("")).alias("key"),
        F.struct(*[v.alias(f) for f, v in text.items()]).alias("value"),
    )
    by_month = daily(spark, sf_dir).groupBy("series", F.date_trunc("month", "dt").alias("month")).agg(
        F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("Time Series (Daily)"))).alias("value")
    )
    return by_month.select("series", "value")


def silver_rejects(spark, sf_dir):
    typed = S.type_bars(Y.explode_payloads(_damaged(spark, sf_dir)))
    return S.rejected(typed).select("series", "dt_string", "reason")


def silver_kept(spark, sf_dir):
    typed = S.type_bars(Y.explode_payloads(_damaged(spark, sf_dir)))
    return plain(S.accepted(typed), 3)


def gold_features(spark, sf_dir):
    return plain(daily_gold(spark, sf_dir).orderBy("dt", "series"), 4)


def gold_latest(spark, sf_dir):
    silver = stage(daily(spark, sf_dir), "silver")
    return plain(G.gold_features(silver, latest_only=True), 4)


def gold_halo_window(spark, sf_dir):
    bars = stage(intraday(spark, sf_dir), "bars")
    return plain(G.gold_features(bars, unique_days=False, limit=SPLIT_ROWS), 4)


def gold_empty(spark, sf_dir):
    return plain(G.gold_features(daily(spark, sf_dir).where(F.col("close") < 0)))


def latest_dates(spark, sf_dir):
    return plain(G.latest_days(daily(spark, sf_dir)))


def lakehouse_run(spark, sf_dir):
    lake = Lakehouse(scratch_path(spark, "lake"))
    return plain(run_lakehouse(spark, lake, make_payloads(daily(spark, sf_dir))), 4)


def _half_year(spark, sf_dir) -> DataFrame:
    """Payloads of the first half of 2000, with closes that a later landing corrects."""
    bars = daily(spark, sf_dir).where("dt >= DATE '2000-01-01' AND dt < DATE '2000-06-15'")
    return make_payloads(bars.withColumn("close", (F.col("close") + 1).cast("float")))


def lakehouse_overlap(spark, sf_dir):
    """Two landings in one call share dates; the newer one counts."""
    lake = Lakehouse(scratch_path(spark, "lake"))
    payloads = _half_year(spark, sf_dir).unionByName(make_payloads(daily(spark, sf_dir)))
    return plain(run_lakehouse(spark, lake, payloads), 4)


def landing_replaced(spark, sf_dir):
    """Landed days after all bars are landed over half a year: the older day of each series is gone."""
    path = scratch_path(spark, "bronze")
    land_payloads(_half_year(spark, sf_dir), path)
    land_payloads(make_payloads(daily(spark, sf_dir)), path, replace=True)
    return plain(Y.read_payloads(spark, path).select("series", "dt"))


def nan_rejects(spark, sf_dir):
    """Bars of the 13th have an open of NaN, those of the 14th a high without bound."""
    day = F.dayofmonth("dt")
    text = {f: F.col(c).cast("string") for c, f in PAYLOAD_FIELDS.items()}
    text["1. open"] = F.when(day == 13, "NaN").otherwise(text["1. open"])
    text["2. high"] = F.when(day == 14, "Infinity").otherwise(text["2. high"])
    entry = F.map_from_arrays(F.array(F.date_format("dt", "yyyy-MM-dd")), F.array(F.struct(*[v.alias(f) for f, v in text.items()])))
    payloads = daily(spark, sf_dir).select("series", F.to_json(entry).alias("value"))
    return S.rejected(S.type_bars(Y.explode_payloads(payloads))).select("series", "dt_string", "reason")


def table_from_nothing(spark, sf_dir):
    """A gold table whose first write has no rows, read back."""
    gold = KeyedTable(scratch_path(spark, "gold"))
    gold.upsert(G.gold_features(daily(spark, sf_dir).where(F.col("close") < 0)))
    return plain(gold.read(spark))


# --- store -----------------------------------------------------------------------


def _target_and_source(spark, sf_dir):
    bars = daily(spark, sf_dir)
    target = bars.where(F.col("dt") < F.lit("2000-01-01").cast("date"))
    source = bars.where(F.col("dt") >= F.lit("1999-07-01").cast("date")).withColumn("close", (F.col("close") + 1).cast("float"))
    return target, source


def upsert_bars(spark, sf_dir):
    target, source = _target_and_source(spark, sf_dir)
    layer = KeyedTable(scratch_path(spark, "silver"))
    layer.upsert(target)
    layer.upsert(source)
    return plain(layer.read(spark), 3)


def upsert_twice(spark, sf_dir):
    target, source = _target_and_source(spark, sf_dir)
    layer = KeyedTable(scratch_path(spark, "silver"))
    for rows in (target, source, source):
        layer.upsert(rows)
    return plain(layer.read(spark), 3)


def create_or_upsert(spark, sf_dir):
    layer = KeyedTable(scratch_path(spark, "silver"))
    return plain(R.gold_or_build(spark, layer, lambda: daily(spark, sf_dir)), 3)


def append_copy(spark, sf_dir):
    bars = daily(spark, sf_dir)
    layer = KeyedTable(scratch_path(spark, "copy"))
    layer.append(bars)
    layer.append(bars)
    return layer.read(spark).groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("dt").alias("days"))


# --- checks ------------------------------------------------------------------------


def quality_report(spark, sf_dir):
    return plain(Q.quality_report(daily_gold(spark, sf_dir)), 3)


def quality_by_series(spark, sf_dir):
    return plain(Q.quality_report(daily_gold(spark, sf_dir), by=["series"]), 3)


def quality_refreshed(spark, sf_dir):
    """The report of a table after an upsert, from states of its periods of which only the touched ones are new."""
    bars = daily(spark, sf_dir)
    bars_table = KeyedTable(scratch_path(spark, "bars"), period="date_format(dt, 'yyyyMM')")
    bars_table.upsert(bars.where(F.col("dt") < "2000-01-01"))
    states = PeriodStates(bars_table, scratch_path(spark, "states"), Q.state_aggregates(dict(bars.dtypes)))
    states.refresh(spark)
    changed = bars.where(F.col("dt") >= "1999-07-01").withColumn("close", (F.col("close").cast("double") + 1).cast("float"))
    states.refresh(spark, bars_table.upsert(changed))
    return plain(Q.report_of_states(states.read(spark), by=["series"]), 3)


def _samples(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_type", "user_id", "value")
    cut = F.lit("2024-01-21").cast("timestamp_ntz")
    return events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)


def ks_drift(spark, sf_dir):
    reference, current = _samples(spark, sf_dir)
    return plain(D.ks_drift(reference, current, ["value", "user_id"]))


def ks_drift_default(spark, sf_dir):
    """The columns are found: all numbers that are no clocks."""
    reference, current = _samples(spark, sf_dir)
    return plain(D.ks_drift(reference, current))


def drift_untested(spark, sf_dir):
    """Nothing to compare with is no drift."""
    reference, current = _samples(spark, sf_dir)
    return plain(D.ks_drift(reference, current.where("value < -1e300"), ["value"]))


def ks_drift_ranged(spark, sf_dir):
    """The same test through the ranged running sums."""
    reference, current = _samples(spark, sf_dir)
    return plain(D.ks_drift(reference, current, ["value", "user_id"], limit=SPLIT_ROWS))


def drift_flags(spark, sf_dir):
    reference, current = _samples(spark, sf_dir)
    return D.ks_drift(reference, current, ["value"], by=["event_type"]).select("event_type", "column", "flag")


def chi2_drift(spark, sf_dir):
    reference, current = _samples(spark, sf_dir)
    return plain(D.chi_square_drift(reference, current, ["event_type"]))


# --- feature preparation -------------------------------------------------------------


def _split(spark, sf_dir):
    return X.chronological_split(stage(daily_gold(spark, sf_dir), "gold"), SERIES_KEY, ["dt"], TEST)


def chrono_split(spark, sf_dir):
    return plain(_split(spark, sf_dir).select("series", "dt", "split"))


def split_counts(spark, sf_dir):
    path = scratch_path(spark, "splits")
    write_splits(_split(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return plain(stored.groupBy("series", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt")
    ))


def _with_gaps(df: DataFrame) -> DataFrame:
    """Volume is missing on the 7th of each month."""
    return df.withColumn("volume", F.when(F.dayofmonth("dt") != 7, F.col("volume")))


def impute_scale(spark, sf_dir):
    rows = stage(_with_gaps(_split(spark, sf_dir)), "rows")
    fitted = P.fit(rows.where(F.col("split") == "train"), ["open", "volume", "30_day_ma_close"], [], ["dt"])
    return plain(fitted.apply(rows).select("series", "dt", "open", "volume", "30_day_ma_close"))


def impute_scale_by_series(spark, sf_dir):
    rows = stage(_with_gaps(_split(spark, sf_dir)), "rows")
    fitted = P.fit(rows.where(F.col("split") == "train"), ["open", "volume"], [], ["dt"], by=["series"])
    return plain(fitted.apply(rows).select("series", "dt", "open", "volume"))


def exact_median(spark, sf_dir):
    """The bracketed form, as it runs when a group is too large for one buffer."""
    rows = table(spark, sf_dir, "lineitem")
    return plain(exact_medians(rows, ["l_extendedprice", "l_quantity", "l_tax"], ["l_returnflag"], limit=0), 4)


def binary_encode(spark, sf_dir):
    rows = stage(_split(spark, sf_dir), "rows")
    fitted = P.fit(rows.where(F.col("split") == "train"), [], ["month", "date"], ["dt"], by=["series"])
    fitted = P.Preparation.load(spark, _saved(spark, fitted))
    return plain(fitted.apply(rows).select("series", "dt", *fitted.feature_names))


def _saved(spark, fitted) -> str:
    path = scratch_path(spark, "saved")
    fitted.save(path)
    return path


def ordered_batches(spark, sf_dir):
    rows = daily(spark, sf_dir).select("series", "dt", "close")
    return plain(X.ordered_batches(rows, SERIES_KEY, ["dt"], 32, bound=DATE_DOMAIN_ROWS).select("series", "dt", "batch_id"))


def batch_mean_metrics(spark, sf_dir):
    rows = candidates(daily_gold(spark, sf_dir))
    batched = X.ordered_batches(rows, SERIES_KEY, ["dt"], 32, bound=DATE_DOMAIN_ROWS)
    return plain(score_batches(batched, SERIES_KEY, "batch_id", "pred_mean", "close"))


def event_index(spark, sf_dir):
    """Position of every event in its type, through sorted ranges."""
    events = table(spark, sf_dir, "events").select("event_type", "ts", "event_id")
    indexed = row_index(events, ["event_type"], ["ts", "event_id"], limit=SPLIT_ROWS)
    return indexed.select("event_type", "event_id", "row_idx")


def running_volume(spark, sf_dir):
    bars = minutes(spark, sf_dir).select("series", "ts", "volume")
    return plain(running_sums(bars, SERIES_KEY, ["ts"], {"running": "volume"}, limit=SPLIT_ROWS))


# --- folds, tuning, selection ----------------------------------------------------------


def _folds(spark, sf_dir, columns=("close",)):
    gold = daily_gold(spark, sf_dir).select("series", "dt", *columns)
    return X.walk_forward_folds(gold, SERIES_KEY, ["dt"], TRAIN, VALIDATION, GAP, bound=DATE_DOMAIN_ROWS)


def walk_forward_folds(spark, sf_dir):
    return plain(_folds(spark, sf_dir).select("series", "dt", "row_idx", "fold", "role"))


def _config(config_id, l2):
    return {"config_id": config_id, "learning_rate": 0.01, "l2": l2, "max_depth": 3}


def fold_regression(spark, sf_dir):
    folded = thousands(_folds(spark, sf_dir, ["close", *FEATURES]))
    sums = L.paired_sums(stage(L.fold_sums(folded, SERIES_KEY, ["open"], "close"), "sums"), SERIES_KEY)
    fits = L.fit_on_sums(sums, SERIES_KEY, "ridge", [_config(0, 0.0)], 1)
    return plain(fits.select("series", "fold", F.col("weights")[0].alias("slope"), F.col("weights")[1].alias("intercept")), 4)


def fold_scores(spark, sf_dir):
    folded = stage(thousands(_folds(spark, sf_dir, ["close", *FEATURES])), "folds")
    sums = L.paired_sums(stage(L.fold_sums(folded, SERIES_KEY, ["open"], "close"), "sums"), SERIES_KEY)
    fits = stage(L.fit_on_sums(sums, SERIES_KEY, "ridge", [_config(0, 0.0)], 1), "fits")
    scored = L.score_folds(folded, fits, SERIES_KEY, ["open"])
    per_fold = score_rows(scored, ["series", "fold", "config_id"], "pred", "close")
    return plain(H.mean_over_folds(per_fold, ["series", "config_id"]), 4)


def _evaluator(spark, sf_dir, learner, features=FEATURES):
    gold = thousands(daily_gold(spark, sf_dir).select("series", "dt", "close", *FEATURES))
    return H.walk_forward_evaluator(
        gold, SERIES_KEY, ["dt"], features, learner, bound=DATE_DOMAIN_ROWS,
        train=TRAIN, validation=VALIDATION, gap=GAP,
    )


def hyperband_survivors(spark, sf_dir):
    """Every evaluation of a search over learning rates, all folds of all series in each round."""
    found = H.run_hyperband(spark, _evaluator(spark, sf_dir, "linear"), budget=27, factor=3)
    return plain(found.evaluations)


def step_losses(spark, sf_dir):
    """Validation loss by epoch of three configurations, averaged over folds, as the run table has it."""
    configs = [r.asDict() for r in H.search_space(spark, 3).collect()]
    fits = _evaluator(spark, sf_dir, "linear").fits(configs, 8, steps=True)
    steps = H.step_losses(fits, SERIES_KEY).groupBy(F.col("config_id").alias("run"), "step").agg(F.avg("mse").alias("value"))
    log = H.RunLog(spark, scratch_path(spark, "runs"))
    log.log_steps("search", steps)
    return plain(log.read().where("kind = 'metric' AND key = 'mse'").select("run_id", "step", F.col("number").alias("mse")))


def ridge_scores(spark, sf_dir):
    configs = [_config(i, l2) for i, l2 in enumerate((0.0, 0.1, 1.0, 10.0, 100.0))]
    evaluate = _evaluator(spark, sf_dir, "ridge", ["open"])
    return plain(evaluate(configs, 1).select("config_id", "mse"), 4)


def tree_scores(spark, sf_dir):
    """Three boosted trees of one split each per fold position, series pooled."""
    gold = thousands(daily_gold(spark, sf_dir).select("series", "dt", "close", *FEATURES))
    evaluate = H.walk_forward_evaluator(
        gold, SERIES_KEY, ["dt"], FEATURES, "gbt", bound=DATE_DOMAIN_ROWS, train=TRAIN, validation=VALIDATION, gap=GAP
    )
    return plain(evaluate([{**_config(0, 0.0), "max_depth": 1}], 3))


def run_table_best(spark, sf_dir):
    """Scores of the simple forecasts logged as runs, and the best run read back per parent."""
    log = H.RunLog(spark, scratch_path(spark, "runs"))
    scored = C.score_candidates(candidates(daily_gold(spark, sf_dir)), CANDIDATES)
    parent = log.start(run_id="weekly")
    for r in scored.collect():  # one row per candidate
        log.log(f"weekly/{r.candidate}", parent, metrics={"mse": r.mse, "mae_ratio": r.mae_ratio})
    return plain(H.best_run(log.read()))


def early_stop(spark, sf_dir):
    """Monthly mean price taken as a loss history; one history per series, one entry per month."""
    monthly = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("series"), F.date_trunc("month", "o_orderdate").alias("month")
    ).agg(F.round(F.avg("o_totalprice"), 2).alias("loss"))
    histories = monthly.groupBy("series").agg(F.array_sort(F.collect_list(F.struct("month", "loss"))).alias("h"))
    stop = H.early_stop(F.transform("h", lambda x: x["loss"]), patience=5, tol=10.0)
    return plain(histories.select("series", stop.alias("s")).select(
        "series", F.col("s.best").alias("best"), F.col("s.epoch").cast("bigint").alias("epoch")
    ))


def best_candidate(spark, sf_dir):
    rows = candidates(_split(spark, sf_dir).where(F.col("split") == "validation"))
    return plain(C.select_production(rows, CANDIDATES))


def stacked_forecast(spark, sf_dir):
    rows = stage(candidates(_split(spark, sf_dir)), "rows")
    model = L.stack_forecasts(rows.where(F.col("split") == "train"), list(CANDIDATES.values()), "close")
    scored = model.transform(rows.where(F.col("split") == "validation"))
    summary = C.forecast_summary(scored, "pred_stacked", by=SERIES_KEY)
    return plain(plain(summary, 4).withColumn("forecast", F.round("forecast", 2)), 4)


def score_forecast(spark, sf_dir):
    rows = candidates(daily_gold(spark, sf_dir))
    return plain(C.forecast_summary(rows, "pred_mean", by=SERIES_KEY), 4)


def forecast_means(spark, sf_dir):
    """Both one-number forecasts, both inverses."""
    rows = candidates(daily_gold(spark, sf_dir))
    pred = F.col("pred_mean")
    return plain(rows.groupBy("series").agg(
        point_forecast(pred).alias("point"), point_forecast(pred, "exp").alias("point_exp"),
        online_forecast(pred).alias("online"), online_forecast(pred, "exp").alias("online_exp"),
    ), 3)


def discrepancy(spark, sf_dir):
    rows = candidates(_split(spark, sf_dir).where(F.col("split") == "test"))
    table_of = C.discrepancy(rows, rows, "pred_mid")
    # Logs, as prices on a binary grid sit on rounding ties of decimal digits.
    return plain(table_of.withColumns({"actual": F.ln("actual"), "forecast": F.ln("forecast")}))


def weekly_best(spark, sf_dir):
    """Check, split, prepare, tune by Hyperband, choose: all learners and default columns on all series, windows scaled to the daily bars."""
    settings = WeeklySettings(test_rows=50, train=80, validation=40, gap=8, budget=27, factor=3)
    gold = stage(daily_gold(spark, sf_dir), "gold")
    return plain(weekly_run(spark, gold, settings), 4)


def short_series(spark, sf_dir):
    """Orders of a customer split by time; customers with too few orders are left out, and listed by another query."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    split = X.chronological_split(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], 3, short="leave_out")
    return split.select("o_custkey", "o_orderkey", "split")


def series_left_out(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey")
    return X.short_groups(rows, ["o_custkey"], 7).withColumnRenamed("rows", "n")


def _one_config(spark, n, seed):
    return spark.createDataFrame([(0, 0.01, 5.0, 2)], "config_id long, learning_rate double, l2 double, max_depth int")


def _production(spark, gold) -> str:
    """The folder of a weekly run whose models are ridge regressions on the opening price."""
    path = scratch_path(spark, "production")
    settings = WeeklySettings(
        learners=("ridge",), test_rows=50, train=60, validation=30, gap=5, numeric=("open",), categorical=(), stacked=False, space=_one_config
    )
    weekly_run(spark, gold, settings, path=path)
    return path


def weekly_production(spark, sf_dir):
    """Test rows of every series as the model forecasts them that the weekly run kept and chose."""
    path = _production(spark, stage(daily_gold(spark, sf_dir), "gold"))
    rows = spark.read.parquet(f"{path}/dataset/prepared").where(F.col("split") == "test")
    return plain(production_rows(spark, path, rows).select("series", "dt", "candidate", "pred"))


# --- recent data -------------------------------------------------------------------------


def reference_window(spark, sf_dir):
    bars = stage(minutes(spark, sf_dir), "bars")
    recent = R.reference_window(bars, "ts").withColumnRenamed("ts", "Datetime")
    return plain(R.normalise_provider(recent.withColumns({"Dividends": F.lit(0.0), "Stock Splits": F.lit(0.0)})))


def reference_dead_series(spark, sf_dir):
    """The last three days of each series of a stored table, one of which ended on the tenth."""
    bars = minutes(spark, sf_dir).where("series <> 'error' OR ts < TIMESTAMP '2024-01-10'")
    stored = KeyedTable(scratch_path(spark, "bars"), ["series", "ts"], "date_format(ts, 'yyyyMMdd')")
    stored.upsert(bars)
    states = clock_states(stored, scratch_path(spark, "states"), "ts")
    states.refresh(spark)
    return plain(recent_stored(spark, states, 3, "ts"))


def latest_stamp(spark, sf_dir):
    """Whether the newest record of a series is stamped with the time of the run."""
    begin = F.lit(int(time.time() * 1000))
    top = R.newest_record(minutes(spark, sf_dir))
    return top.select("series", F.col("timestamp_in_ms").between(begin, begin + 3_600_000).cast("int").alias("stamped"))


def latest_bar(spark, sf_dir):
    return plain(R.newest_record(minutes(spark, sf_dir)).drop("timestamp_in_ms"))


def replay_sample(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("series"), "ts", "event_id", "value")
    buffer = ReplayBuffer(scratch_path(spark, "buffer"), ["ts", "event_id"])
    sample = recency_sample(buffer.update(events, 0), buffer.order, "event_id", 4, seed=11, warm_only=True)
    return plain(sample.select("series", "event_id", "value"))


def replay_order(spark, sf_dir):
    """Where each row of a sample stands in it."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("series"), "ts", "event_id")
    buffer = ReplayBuffer(scratch_path(spark, "buffer"), ["ts", "event_id"])
    sample = recency_sample(buffer.update(events, 0), buffer.order, "event_id", 25, seed=3)
    placed = stage(sample.withColumn("_at", F.monotonically_increasing_id()), "placed")
    return row_index(placed, ["series"], ["_at"], "place", bound=25).select("series", "event_id", "place")


def replay_seeds(spark, sf_dir):
    """Draws of consecutive seeds from one buffer."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("series"), "ts", "event_id")
    buffer = ReplayBuffer(scratch_path(spark, "buffer"), ["ts", "event_id"], row_id="event_id")
    held, drawn = buffer.update(events, 0), None
    for seed in range(5):
        sample = recency_sample(held, buffer.order, "event_id", 4, seed=seed).select(F.lit(seed).alias("seed"), "series", "event_id")
        drawn = sample if drawn is None else drawn.unionByName(sample)
    return drawn


# --- streams --------------------------------------------------------------------------------


def _event_files(spark, sf_dir):
    """The events as three micro-batches. Both cuts lie inside a minute, and half of the events of the
    hour before the second one come late, with the third."""
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "events")
    for part in range(3):
        events.where(F.expr(EVENT_PART) == part).coalesce(1).write.mode("append").parquet(path)
    return I.file_stream(spark, path, events.schema, files_per_batch=1)


def _checkpoint(spark):
    return scratch_path(spark, "checkpoint")


def gold_late_bars(spark, sf_dir):
    """The gold rows that follow from one late bar per series, the 200th: it and the 29 after it."""
    bars = stage(row_index(daily(spark, sf_dir), SERIES_KEY, ["dt"], "i", bound=DATE_DOMAIN_ROWS), "bars")
    late = F.col("i") == 199
    silver = KeyedTable(scratch_path(spark, "silver"), period="date_format(dt, 'yyyyMM')")
    silver.upsert(bars.where(~late).drop("i"))
    arrived = stage(bars.where(late).drop("i"), "late")
    silver.upsert(arrived, staged=True)
    changed = G.affected_gold(lambda spans: silver.between(spark, spans), arrived, unique_days=True)
    return plain(changed, 4)


def stream_bars(spark, sf_dir):
    """Bars taken by one consumer as they come; a second one takes every form in which a bar was sent."""
    target = AppendedTable(scratch_path(spark, "bars"), ["series", "ts"], "date_format(ts, 'yyyyMMdd')")
    sent = scratch_path(spark, "sent")
    bars = I.stream_bars(_event_files(spark, sf_dir), "event_type", "ts", "value", "1 minute", "1 day", "event_id")
    I.run_once(bars, fan_out(upsert_sink(target), append_sink(sent)), _checkpoint(spark))
    largest = spark.read.parquet(sent).groupBy("series", "ts").agg(F.max("volume").alias("volume"))
    return plain(target.read(spark).join(largest, ["series", "ts", "volume"]))


def stream_latest(spark, sf_dir):
    """The newest event per type as a running aggregate of the stream, with its arrival stamped."""
    landed = _event_files(spark, sf_dir).select(
        F.col("event_type").alias("series"), F.col("ts").cast("timestamp").alias("ts"), F.lit(1).alias("volume"),
        *[F.col("value").alias(c) for c in ("open", "high", "low", "close")],
    )
    target = KeyedTable(scratch_path(spark, "latest"), ["series"], "'all'")
    I.run_once(R.newest_record(landed), upsert_sink(target), _checkpoint(spark))
    return plain(target.read(spark).drop("timestamp_in_ms"))


def stream_distinct(spark, sf_dir):
    """Every event polled twice; repeats within the watermark are dropped."""
    events = I.with_event_time(_event_files(spark, sf_dir).select("event_id", "ts", "event_type"), "ts", "40 days")
    polled = events.withColumn("poll", F.explode(F.array(F.lit(0), F.lit(1)))).drop("poll")
    path = scratch_path(spark, "distinct")
    I.run_once(I.drop_repeats(polled, ["event_id"]), append_sink(path), _checkpoint(spark), "append")
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def stream_gold(spark, sf_dir):
    silver, gold = (
        AppendedTable(scratch_path(spark, label), ["series", "timestamp_in_ms"], "date_format(dt, 'yyyyMMdd')") for label in ("silver", "gold")
    )
    bars = I.stream_bars(_event_files(spark, sf_dir), "event_type", "ts", "value", "1 minute", "1 day", "event_id")
    I.run_once(I.bars_to_silver(bars), A.LayerUpdater(silver, gold), _checkpoint(spark))
    return plain(gold.read(spark), 4)


def _messages(spark, sf_dir) -> DataFrame:
    """One message per series and hour; those of 03:00 are cut short, those of 04:00 lack a close."""
    bars = intraday(spark, sf_dir)
    hour = F.timestamp_millis(F.col("timestamp_in_ms") - F.col("timestamp_in_ms") % 3600000)
    records = bars.select(
        "series", "open", "high", "low", "volume", "timestamp_in_ms",
        F.when(F.hour(hour) != 4, F.col("close")).alias("close"),
        F.timestamp_millis("timestamp_in_ms").alias("dt"), hour.alias("hour"),
    )
    sent = M.encode_records(records.withColumn("of", F.col("series")), ["of", "hour"])
    return sent.select(F.when(F.hour("hour") == 3, F.substring("value", 1, 9)).otherwise(F.col("value")).alias("value"))


def _decoded(spark, sf_dir):
    landing, good, bad = (scratch_path(spark, label) for label in ("messages", "good", "bad"))
    stage(_messages(spark, sf_dir), path=landing)
    stream = I.file_stream(spark, landing, "value string")
    I.run_once(stream, decode_sink(append_sink(good), append_sink(bad)), _checkpoint(spark), "append")
    return spark.read.parquet(good), spark.read.parquet(bad)


def stream_decode(spark, sf_dir):
    good, _ = _decoded(spark, sf_dir)
    return plain(M.records_to_silver(good.withColumn("dt", F.to_date("dt"))), 4)


def stream_quarantine(spark, sf_dir):
    _, bad = _decoded(spark, sf_dir)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def stream_replay(spark, sf_dir):
    """The buffer as keyed state, after three micro-batches in which every event is sent twice."""
    rows = I.with_event_time(_event_files(spark, sf_dir).select(F.col("event_type").alias("series"), "ts", "event_id", "value"), "ts", "1 day")
    rows = rows.withColumn("poll", F.explode(F.array(F.lit(0), F.lit(1)))).drop("poll")
    path = scratch_path(spark, "buffers")
    I.run_once(replay_stream(rows, ["ts", "event_id"], row_id="event_id", clock="ts"), append_sink(path), _checkpoint(spark))
    return plain(newest_buffers(spark, path).select("series", "event_id", "value"))


def stream_replay_slots(spark, sf_dir):
    """The same buffer kept as a table by the handler of the stream."""
    buffer = ReplayBuffer(scratch_path(spark, "buffer"), ["ts", "event_id"], row_id="event_id")
    rows = _event_files(spark, sf_dir).select(F.col("event_type").alias("series"), "ts", "event_id", "value")
    rows = rows.withColumn("poll", F.explode(F.array(F.lit(0), F.lit(1)))).drop("poll")
    held = []
    I.run_once(rows, lambda batch, i: held.append(buffer.update(batch, i)), _checkpoint(spark), "append")
    return plain(held[-1].select("series", "event_id", "value"))


def online_step(spark, sf_dir):
    """One gradient step per series on all its prices."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series"), (F.col("o_totalprice") / 100000.0).alias("x"),
        F.log1p("o_totalprice").alias("close"),
    )
    after = gradient_step(rows, None, ["x"], rate=0.05, clip=1.0)
    return plain(after.select(
        "series", F.col("weights")[0].alias("w"), F.col("weights")[1].alias("b"), "steps", "rows", "mse", "forecast"
    ))


def stream_online(spark, sf_dir):
    """Online steps as a stream makes them, one file one micro-batch, each from the weights before."""
    rows = _event_files(spark, sf_dir).select(
        F.col("event_type").alias("series"), (F.col("user_id") / 100.0).alias("x"), F.log1p("value").alias("close")
    )
    model = OnlineModel(scratch_path(spark, "weights"), ["x"], rate=0.05)
    I.run_once(rows, model, _checkpoint(spark), "append")
    last = model.history(spark)
    return plain(last.select("series", "batch_id", F.col("weights")[0].alias("w"), F.col("weights")[1].alias("b"), "rows", "mse")
                 .withColumn("batch_id", F.col("batch_id").cast("bigint")))


def stream_learn(spark, sf_dir):
    """Bars from the stream into silver and gold, a replayed sample of them into an online step."""
    silver, gold = (
        KeyedTable(scratch_path(spark, label), ["series", "timestamp_in_ms"], "date_format(dt, 'yyyyMMdd')")
        for label in ("silver", "gold")
    )
    history = stage(G.gold_features(intraday(spark, sf_dir), unique_days=False), "history")
    preparation = P.fit(history, ["open", "high", "low", "30_day_ma_close"], [], ["dt", "timestamp_in_ms"])
    model = OnlineModel(scratch_path(spark, "weights"), preparation.feature_names, rate=0.01, clip=1.0)
    learner = ReplayLearner(gold, ReplayBuffer(scratch_path(spark, "buffer"), ["timestamp_in_ms"]), preparation, model)
    bars = I.stream_bars(_event_files(spark, sf_dir), "event_type", "ts", "value", "1 minute", "1 day", "event_id")
    I.run_once(I.bars_to_silver(bars), fan_out(A.LayerUpdater(silver, gold), learner), _checkpoint(spark))
    learned = model.history(spark).where("rows IS NOT NULL")  # a last micro-batch without events may follow
    return plain(learned.select(F.col("batch_id").cast("long").alias("batch_id"), "series", "steps", "rows", "mse"))


def stream_from_production(spark, sf_dir):
    """Online steps that go on from the weekly run's models: the last 60 bars of a series in two micro-batches."""
    gold = stage(row_index(daily_gold(spark, sf_dir).withColumn("back", -F.unix_date("dt")), SERIES_KEY, ["back"], "age", bound=DATE_DOMAIN_ROWS).drop("back"), "gold")
    path = _production(spark, gold.where("age >= 60").drop("age"))
    preparation = production_preparation(spark, path)
    landed = scratch_path(spark, "landed")
    for part in (gold.where("age BETWEEN 30 AND 59"), gold.where("age < 30")):
        part.drop("age").coalesce(1).write.mode("append").parquet(landed)
    model = OnlineModel(scratch_path(spark, "weights"), preparation.feature_names, rate=0.01, start=production_weights(spark, path))
    stream = I.file_stream(spark, landed, gold.drop("age").schema, files_per_batch=1)
    I.run_once(stream, lambda batch, i: model.step(preparation.apply(batch), i), _checkpoint(spark), "append")
    return plain(model.history(spark).select(
        F.col("batch_id").cast("long").alias("batch_id"), "series", F.col("weights")[0].alias("w"), F.col("weights")[1].alias("b"), "steps", F.col("rows").alias("n"), "mse"
    ))


def stream_drift(spark, sf_dir):
    """The newest events of each type, as the stream holds them after each of three micro-batches, against the first twenty days."""
    reference, _ = _samples(spark, sf_dir)
    path, size = scratch_path(spark, "drift"), 100
    buffer = ReplayBuffer(scratch_path(spark, "buffer"), ["ts", "event_id"], size)
    monitor = A.DriftMonitor(path, buffer, reference, ["value", "user_id"], "event_id", rows=size)
    rows = _event_files(spark, sf_dir).select(F.col("event_type").alias("series"), "ts", "event_id", "value", "user_id")
    I.run_once(rows, monitor, _checkpoint(spark), "append")
    return plain(spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long")))


QUERIES = {f.__name__: f for f in (
    daily_bars, minute_bars, silver_roundtrip, silver_rejects, silver_kept, gold_features, gold_latest,
    gold_halo_window, gold_empty, latest_dates, lakehouse_run, lakehouse_overlap,
    landing_replaced, nan_rejects, table_from_nothing, ks_drift_default, drift_untested, upsert_bars, upsert_twice, create_or_upsert,
    append_copy, quality_report, quality_by_series, quality_refreshed, ks_drift, ks_drift_ranged, drift_flags, chi2_drift,
    chrono_split, split_counts, impute_scale, impute_scale_by_series, exact_median, binary_encode,
    ordered_batches, batch_mean_metrics, event_index, running_volume, walk_forward_folds, fold_regression,
    fold_scores, hyperband_survivors, step_losses, ridge_scores, tree_scores, run_table_best, early_stop, best_candidate,
    stacked_forecast, score_forecast, forecast_means, discrepancy, short_series, series_left_out, weekly_best, weekly_production, reference_window, reference_dead_series, latest_stamp, latest_bar,
    replay_sample, replay_order, replay_seeds, gold_late_bars, stream_bars, stream_latest, stream_distinct, stream_gold, stream_decode, stream_quarantine, stream_replay, stream_replay_slots,
    online_step, stream_online, stream_from_production, stream_learn, stream_drift,
)}
