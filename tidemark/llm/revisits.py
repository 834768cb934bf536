"""Resolution of WARC revisit records (HTTP 304, not modified) to the response they confirm.

A revisit is joined, as of its date, to the latest earlier full response with the same canonical
URL. The validators are then checked, and if they agree the revisit takes the response's payload,
and its headers updated by those that a 304 answer may change.

The as-of join works on narrow rows without payloads: they are sorted into ranges whose bounds cut
through a URL with many captures; the last response of each range is carried to the next ones.
Payloads move once, in the final join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import sorted_ranges
from tidemark.session import small_or_not, stage

RANGE_ROWS = 200_000
# fixed: fields of a 304 answer that describe the transfer or the stored body, which must not replace stored ones
NOT_UPDATED = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
# fixed: query parameters that only track where a visitor came from
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, user, default port; path without a slash at its end; sorted parameters.

    Fragments and tracking parameters are dropped. Text without a scheme is taken as host and path.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_join(F.sort_array(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(url.isNotNull(), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def parse_headers(block: Column) -> Column:
    """map of lower-case names to values of an HTTP header block; the status line is skipped, repeated fields are joined by ', '."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: x.rlike(r"^[^\s:]+:"))
    fields = F.transform(
        lines,
        lambda x: F.struct(F.lower(F.regexp_extract(x, r"^([^\s:]+):", 1)).alias("name"), F.trim(F.regexp_extract(x, r"^[^\s:]+:(.*)$", 1)).alias("value")),
    )
    names = F.array_distinct(F.transform(fields, lambda f: f["name"]))
    values = F.transform(names, lambda n: F.array_join(F.transform(F.filter(fields, lambda f: f["name"] == n), lambda f: f["value"]), ", "))
    return F.map_from_arrays(names, values)


def merged_headers(stored: Column, answer: Column) -> Column:
    """Stored headers, with those of the 304 answer that it may update."""
    updates = F.map_filter(answer, lambda name, _: ~name.isin(NOT_UPDATED))
    kept = F.map_filter(stored, lambda name, _: ~F.map_contains_key(updates, name))
    return F.map_concat(kept, updates)


def latest_earlier(records: DataFrame, rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """(id, response): the revisits among (id, url, date, full) and the last full record before each, null if none.

    Order is by date, then id; a null url or date matches nothing.
    """
    total = records.count()
    ranges = sorted_ranges(records.where("url IS NOT NULL AND date IS NOT NULL"), ["url"], ["date", "id"], rows_per_range, total)
    full = F.when(F.col("full"), F.col("id"))
    here = Window.partitionBy("url", "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    local = ranges.withColumn("_here", F.last(full, ignorenulls=True).over(here)).where("NOT full")
    ends = ranges.where("full").groupBy("url", "_part").agg(F.max_by("id", "_pos").alias("_end"))
    spans = ranges.select("url", "_part").distinct().join(ends, ["url", "_part"], "left")
    before = Window.partitionBy("url").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = stage(spans.select("url", "_part", F.last("_end", ignorenulls=True).over(before).alias("_carried")).where("_carried IS NOT NULL"), "carried")
    found = local.join(small_or_not(carried), ["url", "_part"], "left").select("id", F.coalesce("_here", "_carried").alias("response"))
    unknown = records.where("NOT full AND (url IS NULL OR date IS NULL)").select("id", F.lit(None).cast("long").alias("response"))
    return found.unionByName(unknown)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Revisits of (record_id, kind, url, date, status, headers, payload) with what they resolve to.

    `kind` is response or revisit (others are ignored), `headers` an HTTP header block, `record_id`
    a unique whole number. A response is full if its status is 200 and its payload is not null.
    Returns (record_id, url, date, outcome, response_id, headers, payload); `headers` is a map.

    - resolved: the answer's ETag equals the response's (a weak mark aside); without an ETag in the
      answer, its Last-Modified does. Payload and merged headers follow.
    - mismatch: they differ; a newer version was not captured. No payload, the answer's own headers.
    - unverifiable: the answer has no validator, or the response lacks the one it has. As mismatch.
    - no_response: there is no earlier full response; `response_id` is null.
    """
    base = records.select(
        F.col("record_id").cast("long").alias("record_id"), F.lower("kind").alias("kind"), "url", "date",
        F.col("status").cast("int").alias("status"), "headers", "payload",
    ).where("kind IN ('response', 'revisit')")
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200) & F.col("payload").isNotNull(), F.lit(False))
    narrow = base.where(full | (F.col("kind") == "revisit")).select(
        F.col("record_id").alias("id"), canonical_url(F.col("url")).alias("url"), "date", full.alias("full")
    )
    narrow = stage(narrow, "captures")
    pairs = stage(latest_earlier(narrow), "pairs")
    answers = base.where("kind = 'revisit'").select("record_id", "url", "date", parse_headers(F.col("headers")).alias("_answer"))
    answers = answers.join(pairs.withColumnRenamed("id", "record_id"), "record_id")
    stored = base.where(full).select(F.col("record_id").alias("response"), parse_headers(F.col("headers")).alias("_stored"), "payload")
    joined = answers.join(stored, "response", "left")

    def tag(headers: str) -> Column:
        return F.regexp_replace(F.element_at(headers, "etag"), r"^W/", "")

    def modified(headers: str) -> Column:
        return F.element_at(headers, "last-modified")

    same = F.when(tag("_answer").isNotNull(), tag("_answer") == tag("_stored")).otherwise(modified("_answer") == modified("_stored"))
    outcome = F.when(F.col("response").isNull(), "no_response").when(same.isNull(), "unverifiable").when(same, "resolved").otherwise("mismatch")
    resolved = F.col("outcome") == "resolved"
    return joined.withColumn("outcome", outcome).select(
        "record_id", "url", "date", "outcome", F.col("response").alias("response_id"),
        F.when(resolved, merged_headers(F.col("_stored"), F.col("_answer"))).otherwise(F.col("_answer")).alias("headers"),
        F.when(resolved, F.col("payload")).alias("payload"),
    )
