import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bars import build_bars
from tidemark.operators.gold import affected_gold, gold_features
from tidemark.operators.prepare import fit
from tidemark.sinks.store import KeyedTable
from tidemark.sources.messages import bad_records, decode_messages, encode_records, good_records, records_to_silver
from tidemark.streaming.ingest import bars_to_silver, drop_repeats, file_stream, run_once, start, stream_bars, with_event_time
from tidemark.streaming.layers import DriftMonitor, LayerUpdater
from tidemark.streaming.learner import ReplayLearner
from tidemark.streaming.online import OnlineModel, fit_batches, gradient_step
from tidemark.streaming.replay import ReplayBuffer, recency_sample
from tidemark.streaming.sinks import append_sink, decode_sink, fan_out, upsert_sink

TICK = "series string, ts timestamp, id long, price double"


def ticks(spark, n=400, step=37):
    start_at = dt.datetime(2024, 1, 1)
    rows = [("hot" if i % 3 else "cold", start_at + dt.timedelta(seconds=step * i), i, float((i * 31) % 97)) for i in range(n)]
    return spark.createDataFrame(rows, TICK)


def land_in_parts(df, path, parts=4):
    """Files in time order, one per part."""
    edges = -(-df.count() // parts)
    for p in range(parts):
        df.where((F.col("id") >= p * edges) & (F.col("id") < (p + 1) * edges)).coalesce(1).write.mode("append").parquet(path)


def minute_stream(spark, path):
    return stream_bars(file_stream(spark, path, TICK, files_per_batch=1), "series", "ts", "price", "1 minute", "10 minutes", "id")


def test_streamed_bars_are_the_batch_bars_and_restart_adds_nothing(spark, tmp_path):
    df, path, checkpoint = ticks(spark), str(tmp_path / "in"), str(tmp_path / "ck")
    land_in_parts(df, path)
    table, copy = (KeyedTable(str(tmp_path / n), ["series", "ts"], "date_format(ts, 'yyyyMMddHH')") for n in ("t", "copy"))
    for _ in range(2):
        run_once(minute_stream(spark, path), fan_out(upsert_sink(table), upsert_sink(copy)), checkpoint)
        batch = build_bars(df, "series", "ts", "price", "1 minute", "id")
        for t in (table, copy):
            assert t.read(spark).exceptAll(batch).isEmpty() and batch.exceptAll(t.read(spark)).isEmpty()


def test_streamed_gold_is_the_batch_gold(spark, tmp_path):
    df, path = ticks(spark), str(tmp_path / "in")
    land_in_parts(df, path, 3)
    silver, gold = (KeyedTable(str(tmp_path / n), ["series", "timestamp_in_ms"]) for n in ("s", "g"))
    run_once(bars_to_silver(minute_stream(spark, path)), LayerUpdater(silver, gold), str(tmp_path / "ck"))
    want = gold_features(bars_to_silver(build_bars(df, "series", "ts", "price", "1 minute", "id")), unique_days=False)
    got = gold.read(spark)
    key = ["series", "timestamp_in_ms"]
    pairs = got.alias("g").join(want.alias("w"), key)
    assert got.count() == want.count() == pairs.count()
    assert pairs.where(F.abs(F.col("g.`30_day_ma_close`") - F.col("w.`30_day_ma_close`")) > 1e-9).isEmpty()


def spans_of(silver):
    """What a table's `between` gives, of a DataFrame."""
    def between(spans):
        if spans is None:
            return silver
        ends = [(a or dt.date.min, b or dt.date.max) for a, b in spans]
        return silver.where(" OR ".join(f"dt BETWEEN DATE'{a}' AND DATE'{b}'" for a, b in ends))

    return between


@pytest.mark.parametrize("lookback", [1, 40, 1000])
def test_late_and_changed_bars_move_the_means_after_them(spark, bars, lookback):
    old = bars([("hot", d, d % 13) for d in range(100)] + [("a", d, d) for d in range(0, 90, 3)])
    new = bars([("hot", 60, 50), ("a", 50, 7)])
    silver = old.join(new, ["series", "dt"], "left_anti").unionByName(new)
    want = gold_features(silver)
    got = affected_gold(spans_of(silver), new, unique_days=True, reach_days=lookback)
    before = gold_features(old)
    kept = before.join(got, ["series", "dt"], "left_anti")
    merged = kept.unionByName(got).alias("g").join(want.alias("w"), ["series", "dt"])
    assert kept.count() + got.count() == merged.count() == want.count()
    assert merged.where(F.abs(F.col("g.`30_day_ma_close`") - F.col("w.`30_day_ma_close`")) > 1e-9).isEmpty()
    assert got.where("dt < '2024-02-20'").isEmpty()


def test_polled_again(spark, tmp_path):
    df, path = ticks(spark, 20), str(tmp_path / "in")
    df.coalesce(1).write.parquet(path)
    df.coalesce(1).write.mode("append").parquet(path)
    out = str(tmp_path / "out")
    stream = with_event_time(file_stream(spark, path, TICK, files_per_batch=1), "ts", "1 hour")
    run_once(drop_repeats(stream, ["id"]), append_sink(out), str(tmp_path / "ck"), "append")
    assert spark.read.parquet(out).count() == 20


def test_polling_trigger(spark, tmp_path):
    df, path = ticks(spark, 20), str(tmp_path / "in")
    df.write.parquet(path)
    query = start(file_stream(spark, path, TICK), append_sink(str(tmp_path / "out")), str(tmp_path / "ck"), "append", once=False)
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


GOOD = [{"series": "a", "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 3, "dt": "2025-01-02T09:30:00.250000", "timestamp_in_ms": 5}]


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode_keeps_good_and_bad(spark):
    half = json.dumps([{**GOOD[0], "close": None}, {**GOOD[0], "dt": "yesterday"}, GOOD[0]])
    out = decode_messages(messages(spark, json.dumps(GOOD), "{bad", "[]", half, '"text"'))
    good = good_records(out)
    assert good.count() == 2 and good.first().dt == dt.datetime(2025, 1, 2, 9, 30, 0, 250000)
    reasons = sorted(r.reason for r in bad_records(out).collect())
    assert reasons.count("bad record") == 2 and reasons.count("bad message") == 2
    row = records_to_silver(good.withColumn("dt", F.to_date("dt"))).first()
    assert (row.dt, row.volume) == (dt.date(2025, 1, 2), 3)


def test_encode_then_decode(spark):
    records = good_records(decode_messages(messages(spark, json.dumps(GOOD * 3))))
    sent = encode_records(records.withColumn("batch", F.lit(1)), ["batch"])
    assert sent.count() == 1
    assert good_records(decode_messages(sent.select("value"))).exceptAll(records).isEmpty()


def test_stream_goes_on_after_a_bad_message(spark, tmp_path):
    path = str(tmp_path / "in")
    for m in ("{bad", json.dumps(GOOD)):
        messages(spark, m).coalesce(1).write.mode("append").parquet(path)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    stream = file_stream(spark, path, "value string", files_per_batch=1)
    run_once(stream, decode_sink(append_sink(good), append_sink(bad)), str(tmp_path / "ck"), "append")
    assert spark.read.parquet(good).count() == 1 and spark.read.parquet(bad).count() == 1


def arrivals(spark, n, first=0):
    return spark.range(first, first + n).select(F.lit("a").alias("series"), F.col("id").alias("at"), F.col("id"))


def test_sample_of_a_small_buffer_is_all_of_it(spark):
    assert recency_sample(arrivals(spark, 3), ["at"], "id", 4).count() == 3
    assert recency_sample(arrivals(spark, 3), ["at"], "id", 4, warm_only=True).isEmpty()


def test_sample_holds_the_newest_and_varies_with_the_seed(spark):
    draws = []
    for seed in range(5):
        ids = sorted(r.id for r in recency_sample(arrivals(spark, 300), ["at"], "id", 4, seed * 7_000_003).collect())
        assert len(set(ids)) == 4 and ids[-1] == 299
        draws.append(tuple(ids))
    assert len(set(draws)) > 1


def test_buffer_keeps_the_last_arrivals_and_a_repeat_changes_nothing(spark, tmp_path):
    buffer = ReplayBuffer(str(tmp_path / "b"), ["at"], 5)
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(buffer.update(arrivals(spark, 3), 0)) == [0, 1, 2]
    for _ in range(2):
        assert ids(buffer.update(arrivals(spark, 4, 3), 1)) == [2, 3, 4, 5, 6]
    assert ids(buffer.update(arrivals(spark, 1, 7), 2)) == [3, 4, 5, 6, 7]
    with pytest.raises(RuntimeError, match="ahead"):
        buffer.update(arrivals(spark, 1), 1)


def test_drift_needs_a_full_sample(spark, tmp_path):
    reference = arrivals(spark, 50)
    buffer = ReplayBuffer(str(tmp_path / "b"), ["at"], 20)
    with pytest.raises(ValueError):
        DriftMonitor(str(tmp_path / "d"), buffer, reference, ["id"], "id", rows=21)
    monitor = DriftMonitor(str(tmp_path / "d"), buffer, reference, ["id"], "id", rows=20)
    monitor(arrivals(spark, 10, 1000), 0)
    monitor(arrivals(spark, 10, 1010), 1)
    report = spark.read.parquet(str(tmp_path / "d")).collect()
    assert [(r.batch_id, r.flag, r.n_cur) for r in report] == [(1, "drift", 20)]


def pairs(spark, rows, series="a"):
    return spark.createDataFrame([(series, float(x), float(y)) for x, y in rows], "series string, x double, close double")


def test_one_gradient_step(spark):
    batch = pairs(spark, [(1, 1), (2, 2)])
    assert gradient_step(batch, None, ["x"], rate=0.1).first().weights == pytest.approx([0.5, 0.3])
    clipped = gradient_step(batch, None, ["x"], rate=0.1, clip=1.0).first()
    assert clipped.weights == pytest.approx([0.0857492926, 0.0514495755])
    assert clipped.mse == pytest.approx(2.5) and clipped.forecast == 0.0  # of the weights before the step


def test_a_step_that_is_not_finite_is_skipped(spark):
    r = gradient_step(pairs(spark, [(1, float("inf"))]), None, ["x"]).first()
    assert (r.weights, r.steps) == ([0.0, 0.0], 0)


def test_steps_per_series_and_a_repeated_batch(spark, tmp_path):
    model = OnlineModel(str(tmp_path / "w"), ["x"], rate=0.1)
    model.step(pairs(spark, [(1, 1), (2, 2)]), 0)
    for _ in range(2):
        model.step(pairs(spark, [(1, 3)], "b"), 1)
    now = {r.series: (r.weights, r.steps) for r in model.weights(spark, 1).collect()}
    assert now["a"] == (pytest.approx([0.5, 0.3]), 1) and now["b"] == (pytest.approx([0.6, 0.6]), 1)
    model.step(pairs(spark, [(1, 1)]), 2)
    after = {r.series: r for r in model.weights(spark, 2).collect()}
    # Error is 0.5 + 0.3 - 1, so both move by 0.1 * 2 * 0.2.
    assert after["a"].weights == pytest.approx([0.54, 0.34]) and after["a"].steps == 2
    assert after["b"].steps == 1


def test_learning_from_replayed_bars(spark, tmp_path):
    df, path = ticks(spark, 120), str(tmp_path / "in")
    land_in_parts(df, path, 3)
    silver, gold = (KeyedTable(str(tmp_path / n), ["series", "timestamp_in_ms"]) for n in ("s", "g"))
    bars = bars_to_silver(build_bars(df, "series", "ts", "price", "1 minute", "id"))
    preparation = fit(gold_features(bars, unique_days=False), ["open", "30_day_ma_close"], [], ["timestamp_in_ms"])
    model = OnlineModel(str(tmp_path / "w"), preparation.feature_names, rate=0.1)
    learner = ReplayLearner(gold, ReplayBuffer(str(tmp_path / "b"), ["timestamp_in_ms"], 50), preparation, model, rows=20)
    handle = fan_out(LayerUpdater(silver, gold), learner)
    run_once(bars_to_silver(minute_stream(spark, path)), handle, str(tmp_path / "ck"))
    rows = {(r.series, r.batch_id): r for r in model.history(spark).collect()}
    # 13 cold bars come with each file, so the cold buffer is warm from the second on.
    assert ("cold", 0) not in rows and rows["cold", 1].steps == 1 and rows["cold", 2].steps == 2
    last = max(b for _, b in rows)
    assert [rows["hot", b].steps for b in range(3)] == [1, 2, 3] and rows["hot", last].steps == 3
    assert all(r.rows == 20 for r in rows.values() if r.rows is not None)


def test_batches_of_a_table(spark, tmp_path):
    rows = pairs(spark, [(i / 10, 2 * i / 10 + 1) for i in range(20)]).withColumn("batch_id", (F.col("x") * 10 / 5).cast("long"))
    by_table = fit_batches(OnlineModel(str(tmp_path / "t"), ["x"]), rows).first().weights
    model = OnlineModel(str(tmp_path / "s"), ["x"])
    for i in range(4):
        by_step = model.step(rows.where(F.col("batch_id") == i).drop("batch_id"), i).first().weights
    assert by_table == by_step


def test_consecutive_seeds_draw_differently_and_in_time_order(spark):
    draws = set()
    for seed in range(12):
        rows = recency_sample(arrivals(spark, 300), ["at"], "id", 4, seed).collect()
        assert [r["at"] for r in rows] == sorted(r["at"] for r in rows)
        draws.add(tuple(r.id for r in rows))
    assert len(draws) == 12


def test_a_row_that_is_sent_again_is_held_once_and_late_rows_arrive(spark, tmp_path):
    buffer = ReplayBuffer(str(tmp_path / "again"), ["at"], 4, row_id="id")
    make = lambda rows: spark.createDataFrame([("s", i, a, v) for i, a, v in rows], "series string, id int, at int, value int")
    buffer.update(make([(1, 10, 0), (2, 20, 0), (3, 30, 0)]), 0)
    held = buffer.update(make([(2, 20, 1), (4, 5, 1)]), 1)
    assert sorted((r.id, r.value) for r in held.collect()) == [(1, 0), (2, 1), (3, 0), (4, 1)]
    held = buffer.update(make([(5, 40, 2)]), 2)
    assert sorted(r.id for r in held.collect()) == [2, 3, 4, 5]  # 1 arrived first
