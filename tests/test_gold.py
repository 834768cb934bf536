import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators.gold import gold_features
from tidemark.operators.ordering import last_rows, recent_enough, row_index, running_sums, trailing
from tidemark.schema import GOLD

MA = "30_day_ma_close"


def test_two_rows(bars):
    rows = gold_features(bars([("a", 0, 10), ("a", 1, 11)])).orderBy("dt").collect()
    assert [r.close for r in rows] == pytest.approx([math.log1p(10), math.log1p(11)])
    assert [r[MA] for r in rows] == [10.0, 10.5]
    assert rows[0].ave_close == rows[0].close and rows[0].total_volume == 1
    assert (rows[1].year, rows[1].month, rows[1].date) == (2024, 1, 2)


def test_moving_mean_is_over_rows(bars):
    rows = gold_features(bars([("a", 3 * d, d + 1) for d in range(31)])).orderBy("dt").collect()
    assert (rows[0][MA], rows[29][MA], rows[30][MA]) == (1.0, 15.5, 16.5)


def test_empty_input_has_the_gold_schema(bars):
    empty = gold_features(bars([("a", 0, 1)]).where("false"))
    assert empty.isEmpty()
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in GOLD]


@pytest.mark.parametrize("limit", [1, 7, 40, 100])
def test_split_window_is_the_plain_window(bars, limit):
    # One series holds most of the rows.
    rows = bars([("hot", d, (d * 37) % 101) for d in range(300)] + [("a", d, d) for d in range(20)] + [("b", 0, 5)])
    plain = gold_features(rows)
    split = gold_features(rows, unique_days=False, limit=limit)
    pairs = plain.alias("p").join(split.alias("s"), ["series", "dt"])
    assert split.count() == pairs.count() == 321
    assert pairs.where(F.abs(F.col(f"p.`{MA}`") - F.col(f"s.`{MA}`")) > 1e-9).isEmpty()


def test_latest_is_the_last_row_of_all(bars):
    rows = bars([("hot", d, d * d % 57) for d in range(100)] + [("a", d, d) for d in range(4)])
    latest = gold_features(rows, latest_only=True)
    assert latest.exceptAll(gold_features(rows)).isEmpty()
    assert sorted((r.series, r.dt.timetuple().tm_yday) for r in latest.collect()) == [("a", 4), ("hot", 100)]


@pytest.mark.parametrize("limit", [1, 13, 1000])
def test_index_and_running_sums(spark, limit):
    df = spark.range(500).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, F.lit(None).cast("string")).otherwise("x").alias("k"),
        (F.col("id") * 7919 % 501).alias("at"), (F.col("id") % 5).alias("v"),
    )
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.at):
        index, total = want.get(r.k, [(-1, 0)])[-1][:2] if r.k in want else (-1, 0)
        want.setdefault(r.k, []).append((index + 1, total + r.v, r.at))
    out = running_sums(row_index(df, ["k"], ["at"], limit=limit), ["k"], ["at"], {"sum": "v"}, limit=limit)
    got = {}
    for r in sorted(out.collect(), key=lambda r: r.at):
        got.setdefault(r.k, []).append((r.row_idx, r["sum"], r.at))
    assert got == want


def test_trailing_takes_any_aggregate(spark):
    df = spark.range(50).select(F.lit("a").alias("k"), F.col("id").alias("at"))
    out = trailing(df, ["k"], ["at"], 3, {"low": F.min("at"), "n": F.count("at")}, limit=5).orderBy("at").collect()
    assert [r.low for r in out[:4]] == [0, 0, 0, 1] and out[-1].n == 3


def test_last_rows_large_and_small(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"))
    for n in (3, 150):
        kept = [r.at for r in last_rows(df, ["k"], ["at"], n).where("k = 1").collect()]
        assert sorted(kept) == list(range(999, 0, -2))[:n][::-1]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "int"])
@pytest.mark.parametrize("n", [1, 30, 500])
def test_pruning_keeps_the_newest_rows(spark, kind, n):
    at = {"int": "CAST(id AS INT)", "date": "date_add(DATE'2024-01-01', CAST(id AS INT))"}.get(
        kind, f"CAST(TIMESTAMP'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT) * 5) AS {kind})")
    df = spark.range(400).selectExpr("IF(id % 4 = 0, 'a', 'hot') AS k", f"{at} AS at", "id")
    df = df.unionByName(spark.sql(f"SELECT 'late' AS k, CAST(NULL AS {kind}) AS at, 1000L AS id"))
    pruned = recent_enough(df, ["k"], ["at"], n, from_bytes=0)
    ids = lambda rows: sorted(r.id for r in last_rows(rows, ["k"], ["at"], n).collect())
    assert ids(pruned) == ids(df)
    if n == 1 and kind != "int":
        assert pruned.count() < 60
