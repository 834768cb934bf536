import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators.prepare import Preparation, fit, fit_numeric
from tidemark.operators.quality import QualityError, quality_gate, quality_report
from tidemark.operators.quantile import exact_medians
from tidemark.operators.splits import chronological_split, ordered_batches, row_slice, walk_forward_folds
from tidemark.operators.ordering import row_index


def rows(spark, n, series="a"):
    return spark.range(n).select(F.lit(series).alias("series"), F.col("id").alias("dt"))


def test_split(spark):
    out = chronological_split(rows(spark, 10), ["series"], ["dt"], 2).orderBy("dt").collect()
    assert [r.split for r in out] == ["train"] * 6 + ["validation"] * 2 + ["test"] * 2


def test_split_of_a_hot_series(spark):
    df = rows(spark, 900, "hot").unionByName(rows(spark, 301))
    out = chronological_split(df, ["series"], ["dt"], 150).groupBy("series", "split").count()
    assert {(r.series, r.split): r["count"] for r in out.collect()} == {
        ("hot", "train"): 600, ("hot", "validation"): 150, ("hot", "test"): 150,
        ("a", "train"): 1, ("a", "validation"): 150, ("a", "test"): 150,
    }


def test_split_too_short(spark):
    with pytest.raises(ValueError, match="4 rows"):
        chronological_split(rows(spark, 4), ["series"], ["dt"], 2)


def test_folds_of_twenty_rows(spark):
    out = walk_forward_folds(rows(spark, 20), ["series"], ["dt"], 6, 3, 2).collect()
    members = lambda fold, role: sorted(r.row_idx for r in out if r.fold == fold and r.role == role)
    assert {r.fold for r in out} == {0, 1, 2, 3}
    assert members(0, "train") == list(range(6)) and members(0, "validation") == [8, 9, 10]
    assert members(3, "train") == list(range(9, 15)) and members(3, "validation") == [17, 18, 19]


def test_no_fold_is_an_error(spark):
    with pytest.raises(ValueError):
        walk_forward_folds(rows(spark, 10), ["series"], ["dt"], 6, 3, 2)


def test_folds_against_brute_force(spark):
    rng = random.Random(5)
    for _ in range(6):
        t, v, g = rng.randint(1, 9), rng.randint(1, 6), rng.randint(0, 4)
        n = t + v + g + rng.randint(0, 25)
        want = set()
        for f in range((n - (t + g + v)) // v + 1):
            want |= {(f, "train", i) for i in range(f * v, f * v + t)}
            want |= {(f, "validation", i) for i in range(f * v + t + g, f * v + t + g + v)}
        got = [(r.fold, r.role, r.row_idx) for r in walk_forward_folds(rows(spark, n), ["series"], ["dt"], t, v, g, limit=5).collect()]
        assert len(got) == len(want) and set(got) == want


def test_batches_and_slices(spark):
    out = ordered_batches(rows(spark, 5), ["series"], ["dt"], 2).orderBy("dt").collect()
    assert [r.batch_id for r in out] == [0, 0, 1, 1, 2]
    indexed = row_index(rows(spark, 9), ["series"], ["dt"])
    assert sorted(r.dt for r in row_slice(indexed, 2, 5).collect()) == [2, 3, 4]


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{name} double, i int")


def test_median_fill_and_scale(spark):
    stats = fit_numeric(numbers(spark, [1.0, 2.0, 3.0, 4.0, None]), ["x"]).first()
    filled = [1, 2, 3, 4, 2.5]
    assert (stats["median"], stats["mean"]) == (2.5, 2.5)
    assert stats["std"] == pytest.approx(statistics.pstdev(filled)) == 1.0


def test_constant_column(spark):
    df = numbers(spark, [5.0, 5.0, 5.0])
    fitted = fit(df, ["x"], [], ["i"])
    assert fitted.numeric.first()["std"] == 1.0
    assert [r.x for r in fitted.apply(df).collect()] == [0.0] * 3


def test_binary_code(spark, tmp_path):
    train = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "a")], "i int, c string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None)], "i int, c string")
    fitted = fit(train, [], ["c"], ["i"], path=str(tmp_path / "p"))
    assert fitted.feature_names == ["c_0", "c_1"]
    for p in (fitted, Preparation.load(spark, str(tmp_path / "p"))):
        got = [(r.c_0, r.c_1) for r in p.apply(new).orderBy("i").collect()]
        assert got == [(0, 1), (1, 0), (1, 1), (0, 0), (0, 0)]


def test_block_order_and_missing_column(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 7)], "rest int, n double, c string, i int")
    fitted = fit(df, ["n"], ["c"], ["i"])
    assert fitted.apply(df).columns == ["n", "c_0", "rest", "i"]
    with pytest.raises(Exception):
        fitted.apply(df.drop("n")).collect()


def test_statistics_by_group(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 2), ("b", 10.0, 1), ("b", None, 2)], "s string, x double, i int")
    out = {(r.s, r.i): r.x for r in fit(df, ["x"], [], ["i"], by=["s"]).apply(df).collect()}
    assert out == {("a", 1): -1.0, ("a", 2): 1.0, ("b", 1): 0.0, ("b", 2): 0.0}


@pytest.mark.parametrize("by", [(), ("g",)])
def test_medians_in_brackets(spark, by):
    rng = random.Random(3)
    data = [(rng.choice("pq"), rng.choice([1.0, 1.0, 7.5, None]), rng.gauss(0, 1e6), None) for _ in range(1501)]
    df = spark.createDataFrame(data, "g string, ties double, wide double, nothing double")
    got = exact_medians(df, ["ties", "wide", "nothing"], by, limit=0).collect()
    for r in got:
        mine = [d for d in data if not by or d[0] == r.g]
        assert r.ties == statistics.median(d[1] for d in mine if d[1] is not None)
        assert r.wide == statistics.median(d[2] for d in mine)
        assert r.nothing is None
    assert len(got) == (2 if by else 1)


def test_quality(spark):
    df = spark.createDataFrame([(-1.0, None, 5), (2.0, 3.0, 6)], "open double, close double, volume long")
    report = quality_report(df)
    status = {(r.constraint, r.column): r.status for r in report.collect()}
    assert status == {
        ("size", None): "Success", ("completeness", "close"): "Failure", ("completeness", "volume"): "Success",
        ("min", "open"): "Failure", ("max", "volume"): "Success",
    }
    with pytest.raises(QualityError, match="completeness\\(close\\) = 0.5"):
        quality_gate(report)
    quality_gate(quality_report(df.where("open > 0")))
    with pytest.raises(QualityError):
        quality_gate(quality_report(df.where("open > 100")))
