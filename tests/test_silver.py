import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.silver import accepted, enforce_schema, rejected, type_bars
from tidemark.schema import SILVER
from tidemark.sinks.landing import land_payloads, latest_entry, make_payloads, sweep
from tidemark.sources.messages import rows_to_table
from tidemark.sources.payload import explode_payloads, explode_wide, read_payloads

BAR3 = '"2025-01-03": {"1. open": "10.0", "2. high": "12.0", "3. low": "9.0", "4. close": "11.0", "5. volume": "500"}'
BAR2 = '"2025-01-02": {"1. open": "9.0", "2. high": "10.5", "3. low": "8.5", "4. close": "10.0", "5. volume": "700"}'
BARE = "{" + BAR3 + ", " + BAR2 + "}"
WRAPPED = '{"Time Series (Daily)": ' + BARE + "}"


def typed(spark, *values):
    return type_bars(explode_payloads(spark.createDataFrame([("a", v) for v in values], "series string, value string")))


@pytest.mark.parametrize("payload", [BARE, WRAPPED])
def test_unpivot(spark, payload):
    rows = accepted(typed(spark, payload)).orderBy("dt").collect()
    assert [r.dt for r in rows] == [dt.date(2025, 1, 2), dt.date(2025, 1, 3)]
    assert (rows[0].close, rows[0].volume, rows[0].timestamp_in_ms) == (10.0, 700, 1735776000000)


def test_rejects_keep_everything(spark):
    damaged = WRAPPED.replace('"3. low": "9.0", ', "").replace(BAR2, BAR2 + ', "junk": "text", "2025-13-45": {}')
    df = typed(spark, damaged, "{bad", "{}")
    assert accepted(df).count() == 1
    reasons = sorted(r.reason for r in rejected(df).collect())
    assert reasons == ["bad date", "bad date", "missing or bad field", "no readable entry", "no readable entry"]


def test_large_volume(spark):
    row = accepted(typed(spark, BARE.replace('"500"', '"3000000000"'))).orderBy(F.desc("dt")).first()
    assert row.volume == 3000000000


def test_wide_table_with_unequal_structs(spark):
    full = "named_struct('1. open', '1', '2. high', '2', '3. low', '0.5', '4. close', '1.5', '5. volume', '7')"
    wide = spark.sql(f"SELECT {full} AS `2025-01-02`, named_struct('1. open', '1') AS `2025-01-03`")
    df = type_bars(explode_wide(wide, "a"))
    assert [r.dt for r in accepted(df).collect()] == [dt.date(2025, 1, 2)]
    assert rejected(df).count() == 1


def test_pivot_then_unpivot_is_the_input(spark, bars, tmp_path):
    rows = bars([(s, d, d + 1.25) for s in "ab" for d in range(0, 800, 3)])
    land_payloads(make_payloads(rows), str(tmp_path / "bronze"))
    back = accepted(type_bars(explode_payloads(read_payloads(spark, str(tmp_path / "bronze")))))
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_landing_again_and_replacing(spark, tmp_path):
    path = str(tmp_path / "bronze")
    frame = lambda rows: spark.createDataFrame(rows, "series string, dt date, value string")
    day = lambda d: dt.date(2025, 1, d)
    land_payloads(frame([("a", day(1), "1"), ("b", day(1), "2")]), path)
    land_payloads(frame([("a", day(1), "3"), ("a", day(2), "4")]), path)
    read = lambda: sorted((r.series, r.dt.day, r.value) for r in read_payloads(spark, path).collect())
    assert read() == [("a", 1, "3"), ("a", 2, "4"), ("b", 1, "2")]
    land_payloads(frame([("a", day(3), "5")]), path, replace=True)
    assert read() == [("a", 3, "5"), ("b", 1, "2")]
    land_payloads(frame([("a", day(1), "6"), ("c", day(1), "7")]), path)  # a replaced day is landed again
    assert read() == [("a", 1, "6"), ("a", 3, "5"), ("b", 1, "2"), ("c", 1, "7")]
    days = lambda series: sorted(p.name for p in (tmp_path / "bronze" / f"series={series}").iterdir())
    assert len(days("a")) == 3 and sweep(spark, path) == 1 and len(days("a")) == 2
    assert read() == [("a", 1, "6"), ("a", 3, "5"), ("b", 1, "2"), ("c", 1, "7")] and sweep(spark, path) == 0


def test_a_landing_deletes_no_landed_folder(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    frame = lambda rows: spark.createDataFrame(rows, "series string, dt date, value string")
    land_payloads(frame([(f"s{i}", dt.date(2025, 1, d), "{}") for i in range(3) for d in (1, 2, 3)]), path)
    asked = []
    monkeypatch.setattr("tidemark.sinks.landing.delete_folder", lambda spark, p: asked.append(p))
    for d in (10, 11, 12):
        land_payloads(frame([(f"s{i}", dt.date(2025, 1, d), "{}") for i in range(3)]), path, replace=True)
    assert all("/_stale/v=" in p for p in asked) and len(asked) <= 3
    assert sorted((r.series, r.dt.day) for r in read_payloads(spark, path).collect()) == [("s0", 12), ("s1", 12), ("s2", 12)]


def test_latest_is_the_greatest_key(spark):
    swapped = "{" + BAR2 + ", " + BAR3 + "}"
    df = spark.createDataFrame([(swapped,)], "value string")
    assert df.select(latest_entry(F.col("value")).alias("d")).first().d == "2025-01-03"


def test_schema_is_enforced(spark):
    with pytest.raises(Exception, match="null in non-null column close"):
        enforce_schema(spark.sql("SELECT 'a' series, date'2025-01-01' dt, 1f open, 1f high, 1f low, CAST(NULL AS FLOAT) close, 1L volume, 1L timestamp_in_ms"), SILVER).collect()
    with pytest.raises(Exception):
        rows_to_table(spark, [("a", dt.date(2025, 1, 1), 1.0, 1.0, 1.0, None, 1, 1)])


def test_prices_that_are_no_numbers_are_rejected(spark):
    payload = '{"2025-01-02": {"1. open": "NaN", "2. high": "1", "3. low": "1", "4. close": "1", "5. volume": "1"}, "2025-01-03": {"1. open": "1", "2. high": "Infinity", "3. low": "1", "4. close": "1", "5. volume": "1"}}'
    typed = type_bars(explode_payloads(spark.createDataFrame([("a", payload)], "series string, value string")))
    assert {r.reason for r in typed.collect()} == {"missing or bad field"}
