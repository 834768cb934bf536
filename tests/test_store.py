import datetime as dt
from pathlib import Path

import pytest

from tidemark.plans.lakehouse import Lakehouse, run_lakehouse
from tidemark.sinks.landing import land_payloads, make_payloads
from tidemark.session import clear_scratch, path_exists, scratch_path, scratch_scope, stage
from tidemark.sinks.store import DuplicateKeys, KeyedTable, read_layer, write_splits
from tidemark.sources.windows import gold_or_build


def closes(df):
    return {(r.series, r.dt.timetuple().tm_yday): r.close for r in df.collect()}


def test_upsert_and_again(spark, bars, tmp_path):
    table = KeyedTable(str(tmp_path / "t"))
    table.upsert(bars([("a", 1, 1), ("a", 2, 2), ("b", 2, 7)]))
    source = bars([("a", 2, 9), ("a", 3, 3)])
    want = {("a", 2): 1.0, ("a", 3): 9.0, ("a", 4): 3.0, ("b", 3): 7.0}
    for _ in range(2):
        table.upsert(source)
        assert closes(table.read(spark)) == want


def test_other_periods_are_not_rewritten(spark, bars, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), period="date_format(dt, 'yyyyMM')")
    table.upsert(bars([("a", d, d) for d in range(0, 120)]))
    files = lambda month: sorted(p.name for p in (tmp_path / "t" / f"period={month}").glob("*.parquet"))
    january, march = files("202401"), files("202403")
    table.upsert(bars([("a", 61, 5)]))
    assert files("202401") == january and files("202403") != march
    assert table.read(spark).count() == 120


def test_rows_since_a_day(spark, bars, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), period="date_format(dt, 'yyyyMM')")
    table.upsert(bars([("a", d, d) for d in range(0, 120)]))
    assert table.since(spark, dt.date(2024, 2, 10)).count() == 120 - 40
    assert table.since(spark, None).count() == 120
    assert all("period=202401" not in f for f in table.since(spark, dt.date(2024, 2, 10)).inputFiles())
    assert table.since(spark, dt.date(2030, 1, 1)).isEmpty()


def test_source_derived_from_the_table_itself(spark, bars, tmp_path):
    table = KeyedTable(str(tmp_path / "t"))
    table.upsert(bars([("a", d, d) for d in range(10)]))
    fives = table.read(spark).selectExpr("series", "dt", "open", "high", "low", "close", "5L AS volume", "timestamp_in_ms")
    table.upsert(fives)
    assert {r.volume for r in table.read(spark).collect()} == {5}


def test_repeated_or_null_source_key(spark, bars, tmp_path):
    table = KeyedTable(str(tmp_path / "t"))
    table.upsert(bars([("a", 1, 1)]))
    with pytest.raises(DuplicateKeys):
        table.upsert(bars([("a", 2, 9), ("a", 2, 8)]))
    with pytest.raises(DuplicateKeys):
        table.upsert(bars([("a", 2, 9)]).selectExpr("CAST(NULL AS STRING) AS series", "dt", "open", "high", "low", "close", "volume", "timestamp_in_ms"))
    assert closes(table.read(spark)) == {("a", 2): 1.0}


def test_missing_table(spark, bars, tmp_path):
    path = str(tmp_path / "none")
    assert not path_exists(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_layer(spark, path)
    table, built = KeyedTable(path), []
    build = lambda: built.append(1) or bars([("a", 1, 1)])
    assert gold_or_build(spark, table, build).count() == 1
    assert gold_or_build(spark, table, build).count() == 1
    assert len(built) == 1
    more = lambda: bars([("a", d, d) for d in (5, 3, 4)])
    ordered = gold_or_build(spark, table, more, refresh=True, order=["dt"]).collect()
    assert [r.close for r in ordered] == [1.0, 3.0, 4.0, 5.0]


def test_empty_upsert_changes_nothing(spark, bars, tmp_path):
    table = KeyedTable(str(tmp_path / "t"))
    table.upsert(bars([("a", 1, 1)]))
    table.upsert(bars([("a", 1, 1)]).where("false"))
    assert table.read(spark).count() == 1


def test_splits_in_folders(spark, bars, tmp_path):
    rows = bars([("a", d, d) for d in range(4)]).selectExpr("*", "IF(close < 2, 'train', 'test') AS split")
    write_splits(rows, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s" / "split=train")).count() == 2


def test_batch_flow_twice(spark, bars, tmp_path):
    lake = Lakehouse(str(tmp_path))
    first = bars([("a", d, d + 1) for d in range(40)])
    assert run_lakehouse(spark, lake, make_payloads(first)).count() == 40
    more = bars([("a", d, d + 1) for d in range(45)] + [("b", 0, 3)])
    gold = run_lakehouse(spark, lake, make_payloads(more))
    assert gold.count() == 46
    assert gold.where("series = 'a'").orderBy("dt").collect()[44]["30_day_ma_close"] == 30.5
    rebuilt = Lakehouse(str(tmp_path / "again"))
    land = spark.read.schema("value string, series string, dt date").option("wholetext", "true").text(lake.bronze)
    land_payloads(land, rebuilt.bronze)
    assert run_lakehouse(spark, rebuilt).exceptAll(gold).isEmpty()
    assert rebuilt.gold.read(spark).count() == 46


def test_scratch_is_given_back(spark, bars):
    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        stage(bars([("a", 0, 1)]), path=inner)
        assert path_exists(spark, inner)
    assert not path_exists(spark, inner)
    outer = scratch_path(spark, "outer")
    stage(bars([("a", 0, 1)]), path=outer)
    clear_scratch(spark)
    assert not path_exists(spark, outer)


def test_upsert_leaves_nothing_in_scratch(spark, bars, tmp_path):
    clear_scratch(spark)
    table = KeyedTable(str(tmp_path / "t"))
    for _ in range(2):
        table.upsert(bars([("a", 1, 1)]))
    root = scratch_path(spark, "x").rsplit("/", 1)[0]
    assert not path_exists(spark, root) or not any(Path(root).iterdir())


def test_a_table_that_begins_empty(spark, tmp_path, bars):
    table = KeyedTable(str(tmp_path / "t"))
    none = bars([("a", 0, 1.0)]).where("false")
    table.upsert(none)
    assert table.exists(spark) and table.read(spark).count() == 0 and table.read(spark).schema.fieldNames() == none.columns
    table.upsert(none)
    table.upsert(bars([("a", 0, 1.0), ("a", 1, 2.0)]))
    table.upsert(bars([("a", 1, 3.0)]))
    assert sorted(r.close for r in table.read(spark).collect()) == [1.0, 3.0]


def test_what_a_failed_first_write_leaves_is_no_table(spark, tmp_path, bars):
    (tmp_path / "t" / "_temporary").mkdir(parents=True)
    table = KeyedTable(str(tmp_path / "t"))
    assert not table.exists(spark)
    table.upsert(bars([("a", 0, 1.0)]))
    assert table.read(spark).count() == 1
