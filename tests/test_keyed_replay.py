import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.streaming.ingest import file_stream, run_once
from tidemark.streaming.keyed_replay import newest_buffers, replay_stream
from tidemark.streaming.replay import ARRIVAL, ReplayBuffer
from tidemark.streaming.sinks import append_sink

SCHEMA = "series string, ts timestamp, id long, value double"
START = dt.datetime(2024, 1, 1)


@pytest.fixture
def stream(spark, tmp_path):
    """land(rows) adds a file; run(...) brings the buffers up to date and returns them as {series: [(id, value)]}."""
    path, checkpoint, out = (str(tmp_path / n) for n in ("in", "ck", "out"))

    def land(*rows):
        made = [(s, START + dt.timedelta(seconds=at) if at is not None else None, i, v) for s, at, i, v in rows]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(path)

    def run(size=4, clock=None, idle_days=30):
        rows = file_stream(spark, path, SCHEMA, files_per_batch=1)
        rows = rows.withWatermark("ts", "1 day") if clock else rows
        run_once(replay_stream(rows, ["ts", "id"], size, row_id="id", clock=clock, idle_days=idle_days), append_sink(out), checkpoint)
        held = {}
        for r in newest_buffers(spark, out).orderBy("series", ARRIVAL, "ts", "id").collect():
            held.setdefault(r.series, []).append((r.id, r.value))
        return held

    return land, run


def test_last_arrivals_and_restart_from_the_checkpoint(stream):
    land, run = stream
    land(*[("a", i, i, 0.0) for i in range(10)], ("b", 0, 1, None))
    assert run() == {"a": [(6, 0.0), (7, 0.0), (8, 0.0), (9, 0.0)], "b": [(1, None)]}
    assert run() == {"a": [(6, 0.0), (7, 0.0), (8, 0.0), (9, 0.0)], "b": [(1, None)]}
    land(("a", 3, 3, 9.0), ("a", 60, 20, 1.0))  # an early time, but a late arrival
    assert run() == {"a": [(8, 0.0), (9, 0.0), (3, 9.0), (20, 1.0)], "b": [(1, None)]}
    land(("a", 8, 8, 5.0))  # sent again
    assert run()["a"] == [(9, 0.0), (3, 9.0), (20, 1.0), (8, 5.0)]


def test_same_as_the_slots(spark, stream, tmp_path):
    land, run = stream
    parts = [[("hot" if i % 4 else None, (i * 37) % 211, (i * 7) % 90, float(i)) for i in range(p * 60, p * 60 + 60)] for p in range(3)]
    buffer = ReplayBuffer(str(tmp_path / "slots"), ["ts", "id"], 12, row_id="id")
    for n, part in enumerate(parts):
        unique = list({(s, i): (s, at, i, v) for s, at, i, v in part}.values())
        land(*unique)
        made = [(s, START + dt.timedelta(seconds=at), i, v) for s, at, i, v in unique]
        held = buffer.update(spark.createDataFrame(made, SCHEMA), n)
    want = {}
    for r in held.orderBy(ARRIVAL, "ts", "id").collect():
        want.setdefault(r.series, []).append((r.id, r.value))
    got = run(size=12)
    assert got["hot"] == want["hot"] and len(want["hot"]) == 12


def test_a_group_that_is_idle_is_forgotten(stream):
    land, run = stream
    day = 86_400
    land(("a", 0, 1, 1.0), ("b", 0, 2, 1.0))
    run(clock="ts", idle_days=10)
    land(("b", 9 * day, 3, 1.0))
    run(clock="ts", idle_days=10)
    land(("b", 20 * day, 4, 1.0))
    run(clock="ts", idle_days=10)
    land(("a", 20 * day, 5, 1.0), ("b", 21 * day, 6, 1.0))
    held = run(clock="ts", idle_days=10)
    assert held == {"a": [(5, 1.0)], "b": [(4, 1.0), (6, 1.0)]} or held == {"a": [(5, 1.0)], "b": [(2, 1.0), (3, 1.0), (4, 1.0), (6, 1.0)]}


def test_null_order_and_empty_files(spark, stream):
    land, run = stream
    land(("a", None, 1, 1.0), ("a", 5, 2, 1.0))
    land()
    assert run() == {"a": [(2, 1.0), (1, 1.0)]} or run() == {"a": [(1, 1.0), (2, 1.0)]}
