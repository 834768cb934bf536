"""Chronological splits, ordered batches and walk-forward folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import last_rows, recent_enough, row_index
from tidemark.schema import BATCH_ROWS, FOLD_GAP, TEST_ROWS, TRAIN_WINDOW, VALIDATION_WINDOW
from tidemark.session import TASK_ROWS, join_on, named, small_or_not, stage


SHORT = ("raise", "leave_out")


def _check_short(short: str) -> str:
    if short not in SHORT:
        raise ValueError(f"short must be one of {', '.join(SHORT)}, not {short!r}")
    return short


def short_groups(df: DataFrame, keys, needed: int) -> DataFrame:
    """(keys..., rows, needed): the groups with less than `needed` rows, which a split or folds leave out."""
    sizes = df.groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.where(F.col("rows") < needed).withColumn("needed", F.lit(needed).cast("long"))


def chronological_split(df: DataFrame, keys, order, test_rows: int = TEST_ROWS, short: str = "raise") -> DataFrame:
    """Adds `split`: the newest `test_rows` rows are test, as many before them validation, the rest train.

    `order` must tell the rows of a group apart; ties among the newest ones raise. Only the two cut rows per group are looked for (key columns, newest rows); the table itself
    is labelled by comparing with them, without being sorted or shuffled. A group without train rows raises, or with
    `short="leave_out"` has no rows in the result; `short_groups(df, keys, 2 * test_rows + 1)` lists these groups.
    """
    _check_short(short)
    needed = 2 * test_rows + 1
    recent = recent_enough(df.select(*[named(c) for c in [*keys, *order]]), keys, order, needed)
    tail = last_rows(recent, keys, order, needed, rank="_rank")
    at = F.struct(*[named(c) for c in order])
    cuts = tail.groupBy(*[named(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_seen"),
        F.count_distinct(at).alias("_places"),
        F.max(F.when(F.col("_rank") == test_rows, at)).alias("_test_from"),
        F.max(F.when(F.col("_rank") == 2 * test_rows, at)).alias("_validation_from"),
    )
    cuts = stage(cuts, "cuts")
    if short == "raise":
        one = cuts.where(F.col("_seen") <= 2 * test_rows).first()
        if one:
            raise ValueError(f"group {[one[k] for k in keys]} has {one['_seen']} rows, needs more than {2 * test_rows}")
    cuts = cuts.where(F.col("_seen") > 2 * test_rows)
    tied = cuts.where(F.col("_places") < F.col("_seen")).first()
    if tied:
        raise ValueError(f"{list(order)} does not order the rows of group {[tied[k] for k in keys]}: add a column that breaks ties")
    label = (
        F.when(at >= F.col("_test_from"), "test")
        .when(at >= F.col("_validation_from"), "validation")
        .otherwise("train")
    )
    return join_on(df, small_or_not(cuts), keys).withColumn("split", label).drop("_seen", "_places", "_test_from", "_validation_from")


def ordered_batches(
    df: DataFrame, keys, order, batch_rows: int = BATCH_ROWS, limit: int = TASK_ROWS, bound: int | None = None
) -> DataFrame:
    """Adds `batch_id`: consecutive runs of `batch_rows` rows in time order, no shuffling of rows."""
    indexed = row_index(df, keys, order, "_idx", limit, bound)
    return indexed.withColumn("batch_id", F.expr(f"_idx div {batch_rows}")).drop("_idx")


def row_slice(indexed: DataFrame, start: int, stop: int, index: str = "row_idx") -> DataFrame:
    """Rows at positions [start, stop) of each group."""
    return indexed.where((F.col(index) >= start) & (F.col(index) < stop))


def fold_count(rows, train: int = TRAIN_WINDOW, validation: int = VALIDATION_WINDOW, gap: int = FOLD_GAP):
    """Number of folds of a group; not positive when it is too short for one."""
    return F.floor((rows - (train + gap + validation)) / validation) + 1


def walk_forward_folds(
    df: DataFrame, keys, order, train: int = TRAIN_WINDOW, validation: int = VALIDATION_WINDOW,
    gap: int = FOLD_GAP, limit: int = TASK_ROWS, bound: int | None = None, short: str = "raise",
) -> DataFrame:
    """Adds `row_idx`, `fold` and `role` (train or validation); a row comes once per fold it is in.

    Fold i trains on [i*v, i*v+t) and validates on [i*v+t+g, i*v+t+g+v). The folds of a row follow
    from its position, so there is no range join, and a row lies in at most ceil(t/v)+1 of them. A group without a
    fold raises, or with `short="leave_out"` has no rows in the result (`short_groups` lists it); no group with one raises always.
    """
    _check_short(short)
    t, v, g = train, validation, gap
    sizes = df.groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = stage(sizes.select(*[named(k) for k in keys], fold_count(F.col("_rows"), t, v, g).alias("_folds")), "sizes")
    long_ = sizes.where(F.col("_folds") >= 1)
    if short == "raise" and not sizes.where(F.col("_folds") < 1).isEmpty() or long_.isEmpty():
        raise ValueError(f"a group is shorter than one fold ({t} + {g} + {v} rows)")

    indexed = join_on(row_index(df, keys, order, "row_idx", limit, bound), small_or_not(long_), keys)
    first = F.expr(f"greatest(0L, (row_idx - {t} + {v}) div {v})")
    last = F.expr(f"least(row_idx div {v}, _folds - 1)")
    in_train = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    validates = F.expr(f"(row_idx - {t + g}) div {v}")
    in_validation = F.when(
        (F.col("row_idx") >= t + g) & (validates < F.col("_folds")), F.array(validates)
    ).otherwise(F.array().cast("array<bigint>"))
    tag = lambda folds, role: F.transform(folds, lambda f: F.struct(f.alias("fold"), F.lit(role).alias("role")))
    return indexed.select("*", F.inline(F.concat(tag(in_train, "train"), tag(in_validation, "validation")))).drop("_folds")
