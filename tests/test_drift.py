import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalar import is_finite, local_clock
from tidemark.operators.drift import as_table, chi_square_drift, chi_square_p, kolmogorov_p, ks_drift
from tidemark.sources.windows import newest_record, normalise_provider, reference_window


def column(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


@pytest.mark.parametrize("limit", [1, 1000])
def test_ks_statistic(spark, limit):
    r = ks_drift(column(spark, [1, 2, 3, 4]), column(spark, [3, 4, 5, 6]), limit=limit).first()
    assert (r.statistic, r.n_ref, r.n_cur) == (0.5, 4, 4)


def test_ks_ties_and_one_hot_value(spark):
    r = ks_drift(column(spark, [1] * 50 + [2] * 50), column(spark, [1] * 90 + [2] * 10)).first()
    assert r.statistic == pytest.approx(0.4) and r.flag == "drift"


def test_same_sample_is_stable(spark):
    r = ks_drift(column(spark, range(20)), column(spark, range(20))).first()
    assert (r.statistic, r.p_value, r.flag) == (0.0, 1.0, "stable")


def test_kolmogorov_tail(spark):
    # lambda = 1.358 is the well-known 5 % point.
    p = spark.range(1).select(kolmogorov_p(F.lit(1.358), F.lit(2.0), F.lit(2.0)).alias("p")).first().p
    assert p == pytest.approx(0.05, abs=2e-4)


def test_counts_beyond_a_bigint_product(spark):
    many = F.lit(10**12)
    p = spark.range(1).select(kolmogorov_p(F.lit(1e-6), many, many).alias("p")).first().p
    assert p == pytest.approx(0.6994, abs=1e-3)


def test_clock_columns_are_left_out_and_lists_accepted(spark):
    rows = as_table(spark, [{"close": 1.0, "timestamp_in_ms": 5}])
    assert [r["column"] for r in ks_drift(rows, rows).collect()] == ["close"]


def test_chi_square(spark):
    ref = spark.createDataFrame([("a",)] * 30 + [("b",)] * 10, "c string")
    cur = spark.createDataFrame([("a",)] * 10 + [("b",)] * 30, "c string")
    r = chi_square_drift(ref, cur, ["c"]).first()
    assert (r.freedom, r.flag) == (1, "drift") and r.statistic == pytest.approx(20.0)
    # Tabulated 5 % points.
    points = spark.createDataFrame([(3.841459, 1), (5.991465, 2), (18.307038, 10), (124.342113, 100)], "x double, k long")
    for p in points.select(chi_square_p("x", "k").alias("p")).collect():
        assert p.p == pytest.approx(0.05, abs=1e-6)


def test_provider_columns(spark):
    df = spark.sql("SELECT timestamp'2025-01-01 12:00:00' Datetime, 1.0 Open, 2.0 High, 5 Volume, 0.0 Dividends, 1 Other")
    out = normalise_provider(df, "America/New_York")
    assert out.columns == ["open", "high", "volume", "dt"]
    assert out.first().dt == dt.datetime(2025, 1, 1, 7) and dict(out.dtypes)["dt"] == "timestamp_ntz"


def test_reference_window_is_per_series(spark):
    df = spark.sql("SELECT s series, timestamp'2025-01-20 00:00:00' - make_interval(0,0,0,d + if(s='b', 100, 0)) ts FROM (SELECT explode(array('a','b')) s), (SELECT explode(sequence(0, 9)) d)")
    assert {(r.series, r["count"]) for r in reference_window(df).groupBy("series").count().collect()} == {("a", 4), ("b", 4)}


def test_newest_record_fills_missing_values(spark):
    df = spark.sql("SELECT 'a' series, timestamp'2025-01-02 00:00:00' ts, 1.0D open, CAST(NULL AS DOUBLE) high, 1.0D low, 2.0D close, CAST(NULL AS BIGINT) volume UNION ALL SELECT 'a', timestamp'2025-01-01 00:00:00', 9D, 9D, 9D, 9D, 9L")
    r = newest_record(df).first()
    assert (r.open, r.high, r.close, r.volume, r.dt) == (1.0, 0.0, 2.0, 0, dt.datetime(2025, 1, 2))
    assert r.timestamp_in_ms > 1_700_000_000_000


def test_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "v double")
    assert [r[0] for r in df.select(is_finite(F.col("v"))).collect()] == [True, False, False, False, False]
    ts = spark.sql("SELECT timestamp'2025-07-01 12:00:00' t").select(local_clock(F.col("t"), "Europe/Paris")).first()[0]
    assert ts == dt.datetime(2025, 7, 1, 14)


def test_a_sample_without_values_is_untested(spark):
    reference = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string")
    none = reference.where("false")
    for row in (ks_drift(reference, none, ["x"]).first(), chi_square_drift(reference, none, ["c"]).first()):
        assert row.statistic is None and row.p_value is None and row.flag == "untested"
