import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.gold import affected_gold, gold_features
from tidemark.sinks.log import AppendedTable
from tidemark.sinks.store import DuplicateKeys
from tidemark.streaming.layers import LayerUpdater
from tidemark.streaming.sinks import upsert_sink

MONTHLY = "date_format(dt, 'yyyyMM')"


def closes(df):
    rows = [((r.series, (r.dt - dt.date(2024, 1, 1)).days), r.close) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def files(path):
    return sorted(str(p) for p in path.rglob("*.parquet"))


@pytest.fixture
def table(tmp_path):
    return AppendedTable(str(tmp_path / "t"), period=MONTHLY)


def test_newest_row_of_a_key_and_repeated_batches(spark, bars, table):
    assert not table.exists(spark)
    table.take(bars([("a", 1, 1), ("a", 40, 2), ("b", 1, 7)]), 0)
    for _ in range(2):
        table.take(bars([("a", 40, 9), ("a", 41, 3)]), 1)
        assert closes(table.read(spark)) == {("a", 1): 1.0, ("a", 40): 9.0, ("a", 41): 3.0, ("b", 1): 7.0}
    table.take(bars([("a", 40, 1)]), 2)
    assert closes(table.read(spark))["a", 40] == 1.0
    assert table.writes(spark) == {1: "stream.0", 2: "stream.1", 3: "stream.2"}


def test_compaction_keeps_the_rows_and_the_order(spark, bars, table, tmp_path):
    for i in range(3):
        table.take(bars([("a", d, 10 * i + d) for d in range(i, i + 40)]), i)
    before = closes(table.read(spark))
    assert table.compact(spark, least=4) == 0 and table.compact(spark) == 3 and table.compact(spark) == 0
    assert closes(table.read(spark)) == before and table.writes(spark) == {}
    assert closes(table.base.read(spark)) == before
    table.take(bars([("a", 0, 99)]), 3)
    assert closes(table.read(spark)) == {**before, ("a", 0): 99.0} and list(table.writes(spark)) == [4]
    table.take(bars([("a", 1, 98)]), 0, stream="other")
    assert table.compact(spark) == 2
    assert closes(table.read(spark)) == {**before, ("a", 0): 99.0, ("a", 1): 98.0}
    assert len(list((tmp_path / "t" / "compacted").iterdir())) == 1


def test_compaction_that_fails_half_way_is_run_again(spark, bars, table):
    table.take(bars([("a", 1, 1)]), 0)
    table.take(bars([("a", 1, 2), ("a", 2, 2)]), 1)
    log = table.read(spark)
    table.base.upsert(log)  # the base was written, the log not yet deleted
    assert closes(table.read(spark)) == {("a", 1): 2.0, ("a", 2): 2.0}
    table.compact(spark)
    assert closes(table.read(spark)) == {("a", 1): 2.0, ("a", 2): 2.0}


def test_a_micro_batch_writes_its_own_rows_only(spark, bars, table, tmp_path):
    table.take(bars([("a", d, d) for d in range(100)]), 0)
    table.compact(spark)
    base = files(tmp_path / "t" / "base")
    for path in base:
        with open(path, "wb") as f:
            f.write(b"not to be read")
    table.take(bars([("a", 50, 5), ("a", 99, 5)]), 1)
    assert files(tmp_path / "t" / "base") == base
    written = spark.read.parquet(*files(tmp_path / "t" / "log"))
    assert closes(written) == {("a", 50): 5.0, ("a", 99): 5.0}


def test_spans_and_untouched_periods(spark, bars, table):
    table.take(bars([("a", d, d) for d in range(120)]), 0)
    table.compact(spark)
    table.take(bars([("a", 100, 1000)]), 1)
    assert len(closes(table.since(spark, dt.date(2024, 2, 10)))) == 80 and closes(table.since(spark, None))["a", 100] == 1000.0
    got = closes(table.between(spark, [(None, dt.date(2024, 1, 2)), (dt.date(2024, 4, 9), dt.date(2024, 4, 11))]))
    assert got == {("a", 0): 0.0, ("a", 1): 1.0, ("a", 99): 99.0, ("a", 100): 1000.0, ("a", 101): 101.0}
    march = table.between(spark, [(dt.date(2024, 3, 1), dt.date(2024, 3, 31))])
    assert march.count() == 31 and all("period=202403" in f for f in march.inputFiles())
    assert table.between(spark, [(dt.date(2031, 1, 1), None)]).isEmpty()


def test_repeated_null_and_empty_sources(spark, bars, table):
    none = bars([("a", 1, 1)]).where("false")
    table.take(none, 0)
    assert table.exists(spark) and table.read(spark).isEmpty() and table.read(spark).columns == none.columns
    with pytest.raises(DuplicateKeys):
        table.take(bars([("a", 2, 9), ("a", 2, 8)]), 1)
    table.take(bars([("a", 2, 9)]), 1)
    table.take(none, 2)
    assert closes(table.read(spark)) == {("a", 2): 9.0}


def test_a_stream_that_begins_anew_does_not_replace_older_writes(spark, bars, table):
    table.take(bars([("a", 1, 1)]), 0)
    table.take(bars([("a", 2, 2)]), 1)
    table.take(bars([("a", 3, 3)]), 0)  # batch 0 again, but not the newest write
    assert closes(table.read(spark)) == {("a", 1): 1.0, ("a", 2): 2.0, ("a", 3): 3.0}


def test_sink_compacts_now_and_then(spark, bars, table):
    sink = upsert_sink(table, compact_every=2)
    for i in range(5):
        sink(bars([("a", i, i)]), i)
    assert len(table.writes(spark)) == 1 and len(closes(table.read(spark))) == 5


def test_layers_from_appended_tables(spark, bars, tmp_path):
    silver, gold = (AppendedTable(str(tmp_path / n), period=MONTHLY) for n in ("s", "g"))
    update = LayerUpdater(silver, gold, unique_days=True, compact_every=2)
    whole = bars([("hot", d, (d * 37) % 101 + 1) for d in range(150)] + [("a", 3 * d, d + 1) for d in range(50)])
    late = (F.col("dt") == dt.date(2024, 2, 20)) | (F.col("dt") == dt.date(2024, 4, 4))
    parts = [~late & (F.col("dt") < dt.date(2024, 4, 1)), ~late & (F.col("dt") >= dt.date(2024, 4, 1)), late]
    for i, part in enumerate(parts):
        update(whole.where(part), i)
    want, got = gold_features(whole), gold.read(spark)
    assert got.count() == want.count() == got.join(want, ["series", "dt", "30_day_ma_close"]).count()


def test_one_late_bar_changes_thirty_rows(spark, bars):
    whole = bars([("hot", d, (d * 37) % 101 + 1) for d in range(400)] + [("a", d, d + 1) for d in range(400)])
    late = whole.where("series = 'hot' AND dt = DATE'2024-07-01'")
    seen = []

    def between(spans):
        seen.append(spans)
        return whole if spans is None else whole.where(" OR ".join(f"dt BETWEEN DATE'{a}' AND DATE'{b or '9999-12-31'}'" for a, b in spans))

    got = affected_gold(between, late, unique_days=True)
    want = gold_features(whole).where("series = 'hot' AND dt >= DATE'2024-07-01' AND dt < DATE'2024-07-31'")
    assert got.count() == 30 and got.exceptAll(want).isEmpty()
    assert seen == [[(dt.date(2024, 4, 2), dt.date(2024, 9, 29))]]


def test_sparse_series_are_looked_up_in_all_of_their_history(spark, bars):
    whole = bars([("a", 20 * d, d + 1) for d in range(200)] + [("b", d, d + 1) for d in range(300)])
    late = whole.where("dt = DATE'2024-07-19'")  # the 11th bar of a, the 201st of b
    between = lambda spans: whole if spans is None else whole.where(" OR ".join(
        f"dt BETWEEN DATE'{a or '0001-01-01'}' AND DATE'{b or '9999-12-31'}'" for a, b in spans))
    got = affected_gold(between, late, unique_days=True)
    assert {r.series: r["count"] for r in got.groupBy("series").count().collect()} == {"a": 30, "b": 30}
    assert got.exceptAll(gold_features(whole)).isEmpty()
