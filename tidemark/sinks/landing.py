"""Bronze: raw payload text under `series=<key>/dt=<latest day>`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import PAYLOAD_FIELDS
from tidemark.session import delete_folder, join_on, path_exists, scratch_scope, stage
from tidemark.sources.payload import STALE, payload_entries, read_payloads, stale_days, stale_versions


def latest_entry(value):
    """Greatest date key of a payload; not simply its first key."""
    return F.array_max(F.map_keys(payload_entries(value)))


def make_payloads(bars: DataFrame) -> DataFrame:
    """(series, dt, value): one JSON object per series and year, so at most 366 bars in one cell."""
    entry = F.struct(
        F.date_format("dt", "yyyy-MM-dd").alias("key"),
        F.struct(*[F.col(c).cast("string").alias(f) for c, f in PAYLOAD_FIELDS.items()]).alias("value"),
    )
    by_year = bars.groupBy("series", F.year("dt").alias("_year")).agg(
        F.max("dt").alias("dt"), F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value")
    )
    return by_year.select("series", "dt", "value")


def land_payloads(payloads: DataFrame, path: str, replace: bool = False) -> None:
    """Write (series, dt, value) as text files, one object per file when (series, dt) is unique.

    Landing the same day again replaces that day. `replace` also replaces the earlier days of the
    series that are landed now; other series are left alone. Replaced days are listed in a small table that readers leave
    out, of which each landing writes a new version: nothing is deleted here, and `sweep` gives the space back.
    """
    spark = payloads.sparkSession
    with scratch_scope(spark):
        old = stale_days(spark, path)
        before = None
        if replace and path_exists(spark, path):
            before = stage(read_payloads(spark, path).select("series", "dt").distinct(), "landed")
        if replace or old is not None:
            payloads = stage(payloads.select("series", "dt", "value"), "payloads")
        payloads.select("series", "dt", "value").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("series", "dt").text(path)
        gone = old
        if before is not None:
            again = join_on(before, payloads.select("series").distinct(), ["series"], "left_semi")
            gone = again if gone is None else gone.unionByName(again)
        if gone is not None:
            _list_stale(spark, path, join_on(gone, payloads.select("series", "dt"), ["series", "dt"], "left_anti").distinct())


def _list_stale(spark: SparkSession, path: str, days: DataFrame) -> None:
    """The next version of the list; the one before it stays for readers that are under way."""
    versions = stale_versions(spark, path)
    stage(days, path=f"{path}/{STALE}/v={versions[-1] + 1 if versions else 0}")
    for n in versions[:-1]:
        delete_folder(spark, f"{path}/{STALE}/v={n}")


def sweep(spark: SparkSession, path: str) -> int:
    """Delete the folders of replaced days; how many there were.

    A maintenance job for when nobody reads: the store is asked once per folder, so the days are passed one by one.
    """
    days = stale_days(spark, path)
    if days is None:
        return 0
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    swept = 0
    for row in days.toLocalIterator():
        delete_folder(spark, f"{path}/series={escape(row.series)}/dt={row.dt}")
        swept += 1
    _list_stale(spark, path, days.limit(0))
    return swept
