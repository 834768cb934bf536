"""Gold: features per bar. Output always has the gold schema, also for an empty input."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import last_rows, recent_enough, trailing
from tidemark.schema import GOLD, SERIES_KEY, TRAILING_ROWS
from tidemark.session import DATE_DOMAIN_ROWS, TASK_ROWS, join_on, known_empty, small_or_not, stage

_MA = "30_day_ma_close"
_AT = "timestamp_in_ms"


def project_gold(with_mean: DataFrame, passing=()) -> DataFrame:
    """Calendar parts, logged close and the copies, in schema order. `passing` columns go along."""
    logged = F.log1p("close")
    derived = {
        "close": logged, "ave_open": F.col("open"), "ave_high": F.col("high"), "ave_low": F.col("low"),
        "ave_close": logged, "total_volume": F.col("volume"),
        "year": F.year("dt"), "month": F.month("dt"), "date": F.dayofmonth("dt"),
    }
    columns = [
        derived.get(f.name, F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in GOLD.fields
    ]
    return with_mean.select(*columns, *passing)


def gold_features(
    silver: DataFrame, unique_days: bool = True, latest_only: bool = False, ordered: bool = False,
    limit: int = TASK_ROWS,
) -> DataFrame:
    """Gold rows of a silver table.

    The mean is over 30 rows, not days, of the raw close. `unique_days` states the silver key
    (series, dt): a series then has at most as many rows as a DATE has values, which one keyed
    window can hold. Without it (bars within a day) rows are ordered by (dt, timestamp_in_ms)
    and a series above `limit` rows is split with a halo.
    """
    order = ["dt"] if unique_days else ["dt", "timestamp_in_ms"]
    if latest_only:
        return _latest_gold(silver, order)
    bound = DATE_DOMAIN_ROWS if unique_days else None
    with_mean = trailing(silver, SERIES_KEY, order, TRAILING_ROWS, {_MA: F.avg("close")}, limit, bound)
    gold = project_gold(with_mean)
    return gold.orderBy(*order, "series") if ordered else gold


def _latest_gold(silver: DataFrame, order) -> DataFrame:
    """Newest row per series. Old files are left out, and history is cut to 30 rows per series in
    every task before anything is shuffled."""
    recent = recent_enough(silver, SERIES_KEY, order, TRAILING_ROWS)
    recent = last_rows(recent, SERIES_KEY, order, TRAILING_ROWS, rank="_rank")
    newest = F.struct(*[c for c in silver.columns if c not in SERIES_KEY])
    top = recent.groupBy(*SERIES_KEY).agg(
        F.avg("close").alias(_MA), F.min_by(newest, "_rank").alias("row")
    )
    return project_gold(top.select(*SERIES_KEY, "row.*", F.col(f"`{_MA}`")))


def _islands(bars: DataFrame, reach_days: int) -> DataFrame:
    """(series, _island, _first, _last): days at most `reach_days` around the bars, neighbourhoods that touch merged."""
    by_day = Window.partitionBy(*SERIES_KEY).orderBy("dt")
    apart = F.coalesce(F.datediff("dt", F.lag("dt").over(by_day)) > 2 * reach_days + 1, F.lit(False))
    days = bars.select(*SERIES_KEY, "dt").distinct().withColumn("_apart", apart.cast("int"))
    return days.withColumn("_island", F.sum("_apart").over(by_day)).groupBy(*SERIES_KEY, "_island").agg(
        F.date_sub(F.min("dt"), reach_days).alias("_first"), F.date_add(F.max("dt"), reach_days).alias("_last")
    )


def _spans(islands: DataFrame):
    """Merged spans (first day, last day) of all islands; at most one row per month comes to the driver."""
    months = islands.groupBy(F.trunc("_first", "MM")).agg(F.min("_first").alias("a"), F.max("_last").alias("b")).collect()
    out = []
    for a, b in sorted((r.a, r.b) for r in months):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def affected_gold(between, bars: DataFrame, unique_days: bool, reach_days: int = 90) -> DataFrame:
    """Gold rows that change when `bars` (a stored table, keys unique) have come into silver: each new bar and the 29 after it.

    `between(spans)` gives the silver rows whose day lies in one of the spans, or all for None. Only days
    at most `reach_days` around a new bar are read; overlapping neighbourhoods of a series are merged into islands, and every island is
    computed for itself. A series with too few bars there (and more of them outside) is looked up in all of
    its history, from its first new bar on.
    """
    place = [*SERIES_KEY, "_island"]
    fresh = bars.select(*SERIES_KEY, "dt", _AT)
    islands = stage(_islands(bars, reach_days), "islands")
    spans = _spans(islands)
    if not spans:
        return gold_features(between(None).where(F.lit(False)), unique_days)
    rows = join_on(between(spans), small_or_not(islands), SERIES_KEY).where(F.col("dt").between(F.col("_first"), F.col("_last")))
    seen = stage(_means_and_hits(rows, fresh, place, unique_days), "seen")
    ends = seen.groupBy(*place, "_first", "_last").agg(
        F.bool_or(F.col("_hit") & (F.col("_rows") < TRAILING_ROWS)).alias("_thin"), F.max_by("_hit", _AT).alias("_open")
    )
    edges = ends.agg(F.max(F.when(F.col("_thin"), F.col("_first"))), F.min(F.when(F.col("_open"), F.col("_last")))).first()
    outside = []
    if edges[0] is not None:
        outside.append((None, edges[0] - timedelta(days=1)))
    if edges[1] is not None:
        outside.append((edges[1] + timedelta(days=1), None))
    result = seen.where("_hit")
    beyond = between(outside) if outside else None
    if beyond is not None and not known_empty(beyond):
        there = join_on(beyond.select(*SERIES_KEY, F.col("dt").alias("_dt")), small_or_not(stage(ends, "ends")), SERIES_KEY)
        there = there.where("(_thin AND _dt < _first) OR (_open AND _dt > _last)")
        wide = stage(there.select(*SERIES_KEY).distinct(), "wide")
        if not wide.isEmpty():
            narrow = project_gold(join_on(result, small_or_not(wide), SERIES_KEY, "left_anti"))
            of_wide = stage(join_on(fresh, small_or_not(wide), SERIES_KEY, "left_semi"), "fresh")
            return narrow.unionByName(_gold_since(between, of_wide, unique_days))
    return project_gold(result)


def _means_and_hits(rows: DataFrame, fresh: DataFrame, place, unique_days: bool) -> DataFrame:
    """Rows with the mean, the number of bars in it, and whether one of these is new."""
    order = ["dt", _AT]
    marked = join_on(rows, small_or_not(fresh.withColumn("_new", F.lit(True))), [*SERIES_KEY, *order], "left")
    return trailing(marked, place, order, TRAILING_ROWS, {
        _MA: F.avg("close"), "_rows": F.count(F.lit(1)), "_hit": F.max(F.coalesce("_new", F.lit(False))),
    }, bound=DATE_DOMAIN_ROWS if unique_days else None)


def _gold_since(between, fresh: DataFrame, unique_days: bool) -> DataFrame:
    """The same rows for the new bars `fresh`, from all rows since the first of a series and the 29 before it."""
    starts = stage(fresh.groupBy(*SERIES_KEY).agg(F.min(_AT).alias("_since"), F.min("dt").alias("_day")), "starts")
    first = starts.agg(F.min("_day")).first()[0]
    starts = small_or_not(starts.drop("_day"))
    before = join_on(between(None), starts, SERIES_KEY).where(F.col(_AT) < F.col("_since")).drop("_since")
    before = last_rows(before, SERIES_KEY, ["dt", _AT], TRAILING_ROWS - 1)
    since = join_on(between([(first, None)]), starts, SERIES_KEY).where(F.col(_AT) >= F.col("_since")).drop("_since")
    return project_gold(_means_and_hits(since.unionByName(before), fresh, SERIES_KEY, unique_days).where("_hit"))


def latest_days(df: DataFrame) -> DataFrame:
    """Newest date per series."""
    return df.groupBy(*SERIES_KEY).agg(F.max("dt").alias("latest_dt"))
