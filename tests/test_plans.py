"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark import queries as Q
from tidemark.operators.bars import build_daily_bars, newest
from tidemark.operators.gold import gold_features
from tidemark.operators.ordering import last_rows
from tidemark.operators.quality import quality_report
from tidemark.operators.silver import accepted, type_bars
from tidemark.operators.splits import chronological_split
from tidemark.session import stage
from tidemark.sources.messages import decode_messages, good_records
from tidemark.sources.payload import explode_payloads
from tidemark.sources.windows import reference_window


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"\bExchange\b", plan(df)))


@pytest.fixture
def daily(spark, sf):
    return build_daily_bars(Q.table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey")


def test_bars_are_hashed_and_read_four_columns(daily):
    text = plan(daily)
    assert "SortAggregate" not in text and shuffles(daily) == 1 and "partial_min_by" in text
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {f.split(":")[0] for f in schema.split(",")} == {"o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"}


def test_gold_adds_one_shuffle(daily):
    assert shuffles(gold_features(daily)) == shuffles(daily) + 1
    assert shuffles(gold_features(stage(daily))) == 1


def test_last_rows_are_cut_before_the_shuffle(daily):
    text = plan(last_rows(stage(daily), ["series"], ["dt"], 30))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_split_does_not_shuffle_the_table(daily):
    df = chronological_split(stage(daily), ["series"], ["dt"], 50)
    assert shuffles(df) == 0 and "BroadcastHashJoin" in plan(df)


def test_reference_window_skips_old_row_groups(spark, sf):
    bars = stage(Q.minutes(spark, sf))
    assert "GreaterThanOrEqual(ts" in plan(reference_window(bars))


def test_json_is_parsed_once_per_level(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "{}")], "series string, value string").write.parquet(path)
    raw = spark.read.parquet(path)
    # Two branches of one CASE for a payload, one parse for each bar.
    assert plan(accepted(type_bars(explode_payloads(raw)))).count("from_json(") == 3
    assert plan(good_records(decode_messages(raw))).count("from_json(") == 1


def test_quality_is_one_pass(daily):
    report = quality_report(gold_features(stage(daily)))
    assert plan(report).count("FileScan") == 1


@pytest.mark.parametrize("name", ["minute_bars", "fold_scores", "online_step", "score_forecast", "quality_by_series"])
def test_no_row_by_row_python_and_no_cross_product(spark, sf, name):
    text = plan(Q.QUERIES[name](spark, sf))
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_newest_rows_are_hashed(spark):
    rows = spark.createDataFrame([("a", 1, 2.0), ("a", 3, None), ("b", 2, 5.0)], "series string, at int, value double")
    got = newest(rows, ["series"], "at")
    assert "SortAggregate" not in plan(got)
    assert sorted(map(tuple, got.collect())) == [("a", 3, None), ("b", 2, 5.0)]
