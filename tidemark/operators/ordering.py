"""Order-dependent operators that hold when one group has most of the rows.

Every operator has a plain form (one keyed window, one shuffle) for groups of at most
`TASK_ROWS` rows and a ranged form for larger ones. The ranged form sorts by range
partitions, whose bounds come from a sample of (keys, order) and so cut through a hot
key, writes them once, and carries per-range totals forward; no task sees a whole group.

`order` must make rows unique within their group, else ties are numbered arbitrarily.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import TASK_ROWS, estimated_bytes, group_sizes, join_on, named, small_or_not, stage

PRUNE_FROM_BYTES = 1 << 30
_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def _too_large(df, keys, limit, bound) -> int:
    """0 when one task can take any group, else the number of all rows."""
    if bound is not None and bound <= limit:
        return 0
    largest, total = group_sizes(df, keys)
    return total if largest > limit else 0


def sorted_ranges(df: DataFrame, keys, order, rows_per_range: int, total: int) -> DataFrame:
    """Rows sorted by (keys, order) and staged with their range `_part` and position `_pos`.

    A lost task sorts again between the same bounds; a second job reads the staged files. So
    all that is derived from the ranges sees the same ones.
    """
    ranges = max(1, -(-total // rows_per_range))
    by = [named(c) for c in [*keys, *order]]
    at = F.col("_at")
    ranged = (
        df.repartitionByRange(ranges, *by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright(at, _POSITION_BITS).cast("int"))
        .withColumn("_pos", at.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_at")
    )
    return stage(ranged, "ranges")


def _carried(spans: DataFrame, keys, totals: dict[str, str]) -> DataFrame:
    """Sum of each total over the earlier ranges of the same group; one row per (group, range)."""
    before = (
        Window.partitionBy(*[named(k) for k in keys])
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return spans.withColumns(
        {carry: F.coalesce(F.sum(total).over(before), F.lit(0)) for carry, total in totals.items()}
    )


def row_index(
    df: DataFrame, keys, order, name: str = "row_idx", limit: int = TASK_ROWS, bound: int | None = None
) -> DataFrame:
    """Zero-based position of each row in its group. `bound` is a proven group size, if known."""
    total = _too_large(df, keys, limit, bound)
    if not total:
        w = Window.partitionBy(*[named(k) for k in keys]).orderBy(*[named(c) for c in order])
        return df.withColumn(name, F.row_number().over(w).cast("long") - 1)

    return _ranged_index(df, keys, order, name, limit, total)


def _ranged_index(df, keys, order, name, limit, total):
    ranges = sorted_ranges(df, keys, order, limit, total)
    spans = ranges.groupBy(*[named(k) for k in keys], "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")
    )
    spans = stage(_carried(spans, keys, {"_before": "_n"}).drop("_n"), "spans")
    return (
        join_on(ranges, small_or_not(spans), [*keys, "_part"])
        .withColumn(name, F.col("_before") + F.col("_pos") - F.col("_first"))
        .drop("_part", "_pos", "_before", "_first")
    )


def running_sums(
    df: DataFrame, keys, order, sums: dict[str, str], limit: int = TASK_ROWS, bound: int | None = None
) -> DataFrame:
    """Cumulative sums within each group; `sums` maps new column to summed column."""
    by = [named(k) for k in keys]
    total = _too_large(df, keys, limit, bound)
    if not total:
        w = (
            Window.partitionBy(*by)
            .orderBy(*[named(c) for c in order])
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        return df.withColumns({new: F.sum(named(old)).over(w) for new, old in sums.items()})

    ranges = sorted_ranges(df, keys, order, limit, total)
    spans = ranges.groupBy(*by, "_part").agg(*[F.sum(named(old)).alias(f"_t_{new}") for new, old in sums.items()])
    spans = _carried(spans, keys, {f"_c_{new}": f"_t_{new}" for new in sums})
    spans = stage(spans.drop(*[f"_t_{new}" for new in sums]), "spans")
    w = Window.partitionBy(*by, "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    local = ranges.withColumns({new: F.sum(named(old)).over(w) for new, old in sums.items()})
    out = join_on(local, small_or_not(spans), [*keys, "_part"])
    out = out.withColumns({new: named(new) + named(f"_c_{new}") for new in sums})
    return out.drop("_part", "_pos", *[f"_c_{new}" for new in sums])


def trailing(
    df: DataFrame, keys, order, rows: int, aggregates: dict[str, Column], limit: int = TASK_ROWS, bound: int | None = None
) -> DataFrame:
    """Aggregates over the current row and the `rows - 1` before it; short frames at the start.

    A group above `limit` is cut into chunks of consecutive rows; the last `rows - 1` rows of a
    chunk are also sent to the next one as a halo, which is dropped after the window.
    """
    total = _too_large(df, keys, limit, bound)
    if not total:
        w = (
            Window.partitionBy(*[named(k) for k in keys])
            .orderBy(*[named(c) for c in order])
            .rowsBetween(1 - rows, 0)
        )
        return df.withColumns({new: agg.over(w) for new, agg in aggregates.items()})

    indexed = _ranged_index(df, keys, order, "_idx", limit, total)
    return chunked_trailing(indexed, keys, "_idx", rows, aggregates, limit).drop("_idx")


def chunked_trailing(df: DataFrame, keys, index: str, rows: int, aggregates: dict[str, Column], chunk_rows: int) -> DataFrame:
    """The halo form of `trailing` on rows that already carry their position."""
    chunk_rows = max(chunk_rows, rows)
    own = F.expr(f"`{index}` div {chunk_rows}")
    in_tail = F.col(index) % chunk_rows > chunk_rows - rows
    spread = df.withColumn("_chunk", F.explode(F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy(*[named(k) for k in keys], "_chunk").orderBy(index).rowsBetween(1 - rows, 0)
    return (
        spread.withColumns({new: agg.over(w) for new, agg in aggregates.items()})
        .where(F.col("_chunk") == own)
        .drop("_chunk")
    )


def last_rows(df: DataFrame, keys, order, n: int, rank: str | None = None) -> DataFrame:
    """The newest `n` rows per group.

    Spark cuts every task's input to `n` rows per group before the shuffle. That still sends
    tasks x n rows of a hot group to one task, so for a large `n` a round over salted groups
    comes first and leaves partitions x n rows at most.
    """
    by, newest_first = [named(k) for k in keys], [named(c).desc() for c in order]
    rank_name = rank or "_rank"
    if n > 100:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.hash(*[named(c) for c in order]), F.lit(salts))
        w = Window.partitionBy(*by, salt).orderBy(*newest_first)
        df = df.withColumn(rank_name, F.row_number().over(w)).where(named(rank_name) <= n).drop(rank_name)
    w = Window.partitionBy(*by).orderBy(*newest_first)
    kept = df.withColumn(rank_name, F.row_number().over(w)).where(named(rank_name) <= n)
    return kept if rank else kept.drop(rank_name)


def recent_enough(table: DataFrame, keys, order, n: int, from_bytes: int = PRUNE_FROM_BYTES) -> DataFrame:
    """Rows of a stored table that can be among the newest `n` of their group, and few others.

    Counts per group and month (per day for instants) show how far back the n-th newest row can
    lie. The oldest such bound goes to the scan as a literal, so older row groups are skipped
    and `last_rows` need not sort all of history. Tables below `from_bytes` pass through, as one
    pass over them is cheaper than two; so do other order types.
    """
    clock = order[0]
    kind = dict(table.dtypes)[clock]
    if kind not in ("date", "timestamp", "timestamp_ntz") or estimated_bytes(table) < from_bytes:
        return table
    by, at = [named(k) for k in keys], named(clock)
    bucket = F.date_trunc("month" if kind == "date" else "day", at)
    counts = table.groupBy(*by, bucket.alias("_bucket")).count()
    newest_first = (
        Window.partitionBy(*by).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = counts.withColumn("_rows", F.sum("count").over(newest_first))
    cuts = reached.groupBy(*by).agg(
        F.coalesce(F.max(F.when(F.col("_rows") >= n, F.col("_bucket"))), F.min("_bucket")).alias("_cut")
    )
    cuts = stage(cuts, "cuts")
    oldest = cuts.agg(F.min("_cut")).first()[0]
    if oldest is None:
        return table
    recent = table.where(at.isNull() | (at >= F.lit(oldest).cast(kind)))
    return join_on(recent, small_or_not(cuts), keys).where(at.isNull() | (bucket >= F.col("_cut"))).drop("_cut")
