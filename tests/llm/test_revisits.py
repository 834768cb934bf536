import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.llm import revisits

SCHEMA = "record_id long, kind string, url string, date timestamp, status int, headers string, payload string, outcome string"
T0 = dt.datetime(2024, 1, 1)


def record(i, kind, url, minute, headers="", payload=None, status=None):
    at = None if minute is None else T0 + dt.timedelta(minutes=minute)
    return (i, kind, url, at, status if status is not None else (200 if kind == "response" else 304), headers, payload, "old")


def resolve(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return {r.record_id: r for r in revisits.resolve_revisits(df).collect()}


def test_outcomes_and_headers(spark):
    old = "HTTP/1.1 200 OK\r\nETag: \"v1\"\r\nContent-Type: text/html\r\nCache-Control: no-cache\r\nContent-Length: 3\r\nX-Keep: a"
    new = "HTTP/1.1 200 OK\r\nETag: \"v2\"\r\nLast-Modified: Mon\r\n"
    rows = [
        record(1, "response", "HTTP://User@Host.example:80/a/?utm_source=x&b=2&a=1#top", 0, old, "abc"),
        record(2, "revisit", "https://host.example/a?a=1&b=2&ref=z", 5, "HTTP/1.1 304\r\netag: W/\"v1\"\r\nCache-Control: max-age=1\r\nContent-Length: 0\r\nContent-Type: x"),
        record(3, "response", "host.example/a?a=1&b=2", 7, new, "defg"),
        record(4, "revisit", "http://host.example/a?b=2&a=1", 9, "ETag: \"v1\""),
        record(5, "revisit", "http://host.example/a?b=2&a=1", 9, "Last-Modified: Mon"),
        record(6, "revisit", "http://host.example/a?b=2&a=1", 9, "Age: 3"),
        record(7, "revisit", "http://host.example/other", 9, "ETag: \"v1\""),
        record(8, "revisit", "http://host.example/a?b=2&a=1", 3, None),
        record(9, "revisit", None, 9), record(10, "revisit", "http://host.example/a?b=2&a=1", None), record(11, "request", "host.example/a", 0),
        record(12, "response", "host.example/gone", 0, "ETag: \"v1\"", "x", 404), record(13, "revisit", "host.example/gone", 5, "ETag: \"v1\""),
        record(14, "response", "host.example/b", 0, "", "no tag"), record(15, "revisit", "host.example/b", 5, "ETag: \"v1\""),
    ]
    got = resolve(spark, rows)
    assert {i: (r.outcome, r.response_id) for i, r in got.items()} == {
        2: ("resolved", 1), 4: ("mismatch", 3), 5: ("resolved", 3), 6: ("unverifiable", 3), 7: ("no_response", None), 8: ("unverifiable", 1),
        9: ("no_response", None), 10: ("no_response", None), 13: ("no_response", None), 15: ("unverifiable", 14),
    }
    assert got[2].payload == "abc" and got[5].payload == "defg" and got[4].payload is None
    assert got[2].headers == {"etag": "W/\"v1\"", "content-type": "text/html", "cache-control": "max-age=1", "content-length": "3", "x-keep": "a"}
    assert got[4].headers == {"etag": "\"v1\""} and got[8].headers == {}


@pytest.mark.parametrize("rows_per_range", [3, 1000])
def test_ranges_of_a_hot_url(spark, rows_per_range):
    """Captures of one URL cut into ranges, with ties in time, against a plain loop."""
    import random

    rng = random.Random(5)
    events = [(i, rng.choice(["hot", "hot", "hot", f"u{i % 4}"]), rng.randint(0, 40), rng.random() < 0.3) for i in range(120)]
    df = spark.createDataFrame([(i, u, T0 + dt.timedelta(minutes=m), f) for i, u, m, f in events], "id long, url string, date timestamp, full boolean")
    got = {r.id: r.response for r in revisits.latest_earlier(df, rows_per_range).collect()}
    for i, u, m, full in events:
        if not full:
            before = [(b, j) for j, v, b, f in events if f and v == u and (b, j) < (m, i)]
            assert got[i] == (max(before)[1] if before else None)
    assert len(got) == sum(not e[3] for e in events)


def test_empty_table(spark):
    assert resolve(spark, []) == {}


def test_canonical_url_and_headers(spark):
    df = spark.createDataFrame([("a", "https://EXAMPLE.com:443/"), ("b", "http://example.com?fbclid=1&z&y="), ("c", ""), ("d", None), ("e", "http://m.example.com:8080/P/?q=http://x/y")], "k string, u string")
    got = {r.k: r.c for r in df.select("k", revisits.canonical_url(F.col("u")).alias("c")).collect()}
    assert got == {"a": "example.com", "b": "example.com?y=&z", "c": "", "d": None, "e": "m.example.com:8080/P?q=http://x/y"}
    block = "HTTP/1.1 200 OK\nA: 1\r\na:2\r\n bad line\r\nB:\r\n"
    row = spark.createDataFrame([(block,)], "h string").select(revisits.parse_headers(F.col("h")).alias("m")).first()
    assert row.m == {"a": "1, 2", "b": ""}
