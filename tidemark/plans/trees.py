"""Boosted regression trees grown from gradient histograms, for all groups of rows and all depths at a time.

Features are cut into at most `BINS` bins once, at quantiles of all rows, and the rows of a group (a fold, or
all train rows) are packed into chunks: one row of the table holds up to `CHUNK_ROWS` data rows as arrays.
A split needs the rows of a node only as count and residual sum per (feature, bin).

A group of at most `LOCAL_ROWS` rows is one task per depth, which grows all of its trees. Larger groups grow
level by level: every task sums the histograms of the open nodes over its chunks, one shuffle adds
them up per (group, depth), and the splits found come back by a join with the chunks. Both forms
use the same steps and give the same trees. All groups and depths share each pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import PATIENCE, TOLERANCE
from tidemark.session import join_on, named, ship_with_tasks, small_or_not, stage

ship_with_tasks(__name__)

BINS = 32
SHRINKAGE = 0.1  # weight of every tree but the first
CHUNK_ROWS = 50_000
LOCAL_ROWS = 250_000
KEPT_TREES = 16  # the level form writes predictions again after so many of the deepest trees
HELD_SUMS = 64  # sums that a task holds before it sends them on
EDGE_ACCURACY = 100_000  # edges are exact for fewer rows, else off by one in so many ranks
ALIKE = 1e-9  # gains that differ by less count as equal; the smaller feature and bin win
NODE = np.dtype([("feature", "<i2"), ("bin", "<i2"), ("value", "<f8")])


# --- steps on arrays --------------------------------------------------------------------


def binned(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bin of each value: the number of edges below it."""
    out = np.empty(values.shape, np.uint8)
    for i, cuts in enumerate(edges):
        out[:, i] = np.searchsorted(np.asarray(cuts), values[:, i], side="left")
    return out


def leaves(tree: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
    """Number of the node in which each row ends; node i has the children 2i + 1 and 2i + 2."""
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        feature = tree["feature"][at]
        right = bins[rows, np.maximum(feature, 0)] > tree["bin"][at]
        at = np.where(feature >= 0, 2 * at + 1 + right, at)
    return at


def ensemble(trees: list[np.ndarray], bins: np.ndarray, depth: int, first: int = 0) -> np.ndarray:
    """Sum of the weighted trees, the earliest of which is the `first` of its ensemble."""
    total = np.zeros(len(bins))
    for i, tree in enumerate(trees):
        total += tree["value"][leaves(tree, bins, depth)] * (SHRINKAGE if first + i else 1.0)
    return total


def histograms(bins: np.ndarray, node: np.ndarray, residual: np.ndarray, width: int) -> np.ndarray:
    """(count, sum of residuals) per node, feature and bin; rows of a negative node count nowhere."""
    open_ = node >= 0
    if not open_.all():
        bins, node, residual = bins[open_], node[open_], residual[open_]
    n_features = bins.shape[1]
    at = ((node[:, None] * n_features + np.arange(n_features)) * BINS + bins).ravel()
    size = width * n_features * BINS
    out = np.empty((width, n_features, BINS, 2))
    out[..., 0] = np.bincount(at, minlength=size).reshape(width, n_features, BINS)
    out[..., 1] = np.bincount(at, np.repeat(residual, n_features), size).reshape(width, n_features, BINS)
    return out


def split_nodes(tree: np.ndarray, level: int, sums: np.ndarray) -> None:
    """Give every open node of a level its best split, and values to its children; level 0 gets its own value."""
    first = (1 << level) - 1
    upto = sums.cumsum(axis=2)
    whole = upto[:, 0, -1, :]
    if level == 0:
        tree["value"][0] = whole[0, 1] / whole[0, 0] if whole[0, 0] else 0.0
    left = upto[:, :, :-1, :]
    right = whole[:, None, None, :] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - (whole[:, 1] ** 2 / whole[:, 0])[:, None, None]
    gain = np.where((left[..., 0] > 0) & (right[..., 0] > 0), gain, -np.inf).reshape(len(sums), -1)
    best = gain.max(axis=1, initial=-np.inf)
    for i in np.flatnonzero(np.isfinite(best) & (best > 0)):
        at = int(np.argmax(gain[i] >= best[i] * (1 - ALIKE)))
        feature, cut = divmod(at, BINS - 1)
        node = first + i
        tree["feature"][node], tree["bin"][node] = feature, cut
        for child, side in ((2 * node + 1, left), (2 * node + 2, right)):
            tree["value"][child] = side[i, feature, cut, 1] / side[i, feature, cut, 0]


def open_slots(tree: np.ndarray, bins: np.ndarray, level: int) -> np.ndarray:
    """Number within the level of the node of each row; -1 where its branch ended above."""
    at = leaves(tree, bins, level) - ((1 << level) - 1)
    return np.where(at >= 0, at, -1)


def new_tree(depth: int) -> np.ndarray:
    tree = np.zeros((2 << depth) - 1, NODE)
    tree["feature"] = -1
    return tree


def errors(y: np.ndarray, pred: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(rows, sum of squared errors, sum of absolute errors)."""
    apart = y[rows] - pred[rows]
    return np.array([len(apart), float(apart @ apart), float(np.abs(apart).sum())])


class Progress:
    """Losses of an ensemble by tree; ends after `patience` trees in a row without one lower by more than `tol`."""

    def __init__(self, patience: int, tol: float, losses=()):
        self.patience, self.tol = patience, tol
        self.losses, self.maes, self.best, self.misses, self.best_at = [], [], np.inf, 0, 0
        for mse, mae in losses:
            self.add(mse, mae)

    def add(self, mse: float, mae: float) -> None:
        self.losses.append(mse)
        self.maes.append(mae)
        if mse + self.tol < self.best:
            self.best, self.misses, self.best_at = mse, 0, len(self.losses)
        else:
            self.misses += 1

    @property
    def ended(self) -> bool:
        return self.misses >= self.patience


def _judged(of_validation: np.ndarray, of_train: np.ndarray) -> tuple[float, float]:
    """MSE and MAE on the validation rows, on the train rows where there are none."""
    n, squares, absolute = of_validation if of_validation[0] else of_train
    return squares / n, absolute / n


# --- tables -----------------------------------------------------------------------------


def bin_edges(rows: DataFrame, features, accuracy: int = EDGE_ACCURACY) -> list[list[float]]:
    """Per feature, its distinct quantiles of `BINS` equal shares (at most BINS - 1 numbers); null and NaN are left out."""
    shares = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    number = lambda c: F.when(~F.isnan(named(c).cast("double")), named(c).cast("double"))
    found = rows.agg(*[F.percentile_approx(number(c), shares, accuracy).alias(f"_e{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(found[f"_e{i}"] or [])) for i in range(len(features))]


def pack(rows: DataFrame, groups, features, target: str, edges, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(groups..., n, n_train, bins, y, train): chunks of binned rows as binary arrays, staged.

    Rows with a null or NaN feature or target are left out. `role` tells train rows from validation rows. A group above
    `chunk_rows` is dealt out by a hash of the row, so that no task packs all of it.
    """
    by = [named(k) for k in groups]
    whole = F.lit(True)
    for c in [*features, target]:
        whole = whole & named(c).isNotNull() & ~F.isnan(named(c).cast("double"))
    spread = F.xxhash64(*[named(c) for c in rows.columns])
    kept = rows.where(whole).select(
        *by, (F.col("role") == "train").alias("_train"), named(target).cast("double").alias("_y"),
        *[named(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)], spread.alias("_spread"),
    )
    sizes = stage(kept.groupBy(*by).agg(F.expr(f"count(1) div {chunk_rows} + 1").alias("_chunks")), "sizes")
    kept = join_on(kept, small_or_not(sizes), groups) if groups else kept.withColumn("_chunks", F.lit(sizes.first()[0]))
    dealt = kept.withColumn("_salt", F.pmod("_spread", F.col("_chunks"))).drop("_spread", "_chunks")
    dealt = dealt.repartition(*by, "_salt").sortWithinPartitions(*by, "_salt")
    keys = [f for f in kept.schema if f.name in groups]
    out = T.StructType([*keys, T.StructField("n", T.LongType()), T.StructField("n_train", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in ("bins", "y", "train")]])
    names = [f"_x{i}" for i in range(len(features))]
    of_group = [*groups, "_salt"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None

        def chunks(part):
            for at in range(0, len(part), chunk_rows):
                one = part.iloc[at:at + chunk_rows]
                made = {k: [one[k].iloc[0]] for k in groups}
                made |= {
                    "n": [len(one)], "n_train": [int(one["_train"].sum())], "bins": [binned(one[names].to_numpy(float), edges).tobytes()],
                    "y": [one["_y"].to_numpy(float).tobytes()], "train": [one["_train"].to_numpy(bool).tobytes()],
                }
                yield pd.DataFrame(made)

        for batch in batches:
            if batch.empty:
                continue
            rows_now = batch if held is None else pd.concat([held, batch], ignore_index=True)
            key = rows_now[of_group]
            same = ((key == key.shift()) | (key.isna() & key.shift().isna())).all(axis=1)
            starts = [0, *(i for i in np.flatnonzero(~same.to_numpy()) if i), len(rows_now)]
            for a, b in zip(starts[:-2], starts[1:-1]):
                yield from chunks(rows_now.iloc[a:b])
            held = rows_now.iloc[starts[-2]:]
            full = len(held) // chunk_rows * chunk_rows
            if full:
                yield from chunks(held.iloc[:full])
                held = held.iloc[full:] if full < len(held) else None
        if held is not None:
            yield from chunks(held)

    return stage(dealt.mapInPandas(run, out), "chunks")


def _unpacked(n: int, bins: bytes, y: bytes, train: bytes):
    return np.frombuffer(bins, np.uint8).reshape(n, -1), np.frombuffer(y, float), np.frombuffer(train, bool)


_FITTED = [
    T.StructField("max_depth", T.IntegerType()), T.StructField("epoch", T.LongType()), T.StructField("mse", T.DoubleType()),
    T.StructField("mae", T.DoubleType()), T.StructField("losses", T.ArrayType(T.DoubleType())), T.StructField("maes", T.ArrayType(T.DoubleType())),
    T.StructField("trees", T.BinaryType()),
]


def _fitted_row(depth: int, progress: Progress, trees: list[np.ndarray]) -> dict:
    best = progress.best_at
    return {
        "max_depth": depth, "epoch": len(progress.losses), "mse": progress.losses[best - 1] if best else None,
        "mae": progress.maes[best - 1] if best else None, "losses": progress.losses, "maes": progress.maes,
        "trees": b"".join(t.tobytes() for t in trees[:best]),
    }


def grow(bins, y, train, depth: int, budget: int, patience: int, tol: float) -> tuple[Progress, list[np.ndarray]]:
    """All trees of a group whose rows are at hand."""
    progress, trees, pred = Progress(patience, tol), [], np.zeros(len(y))
    fitted_bins, validation = bins[train], ~train
    while len(trees) < budget and not progress.ended:
        tree, residual = new_tree(depth), (y - pred)[train]
        for level in range(depth):
            split_nodes(tree, level, histograms(fitted_bins, open_slots(tree, fitted_bins, level), residual, 1 << level))
        pred += tree["value"][leaves(tree, bins, depth)] * (SHRINKAGE if trees else 1.0)
        trees.append(tree)
        progress.add(*_judged(errors(y, pred, validation), errors(y, pred, train)))
    return progress, trees


def fit_trees(
    chunks: DataFrame, groups, depths, budget: int, patience: int = PATIENCE, tol: float = TOLERANCE, local_rows: int = LOCAL_ROWS
) -> DataFrame:
    """(groups..., max_depth, epoch, mse, mae, losses, maes, trees) per group and depth, staged.

    `losses` and `maes` have the validation MSE and MAE (of the train rows, where there are no others) after every tree, `epoch` is the
    last one tried; `mse`, `mae` and `trees` are of the best one. Groups without train rows give none.
    """
    depths = sorted({int(d) for d in depths})
    if not depths or depths[0] < 1:
        raise ValueError(f"depths {depths}: at least one, each from 1 on")
    by = [named(k) for k in groups]
    sizes = chunks.groupBy(*by).agg(F.sum("n").alias("_rows"), F.sum("n_train").alias("_learned"))
    sizes = stage(sizes.where("_learned > 0").drop("_learned"), "sizes")
    largest = sizes.agg(F.max("_rows")).first()[0] or 0
    schema = T.StructType([*[f for f in chunks.schema if f.name in groups], *_FITTED])
    marked = join_on(chunks, small_or_not(sizes), groups) if groups else chunks.withColumn("_rows", F.lit(largest))
    if not largest:
        return chunks.sparkSession.createDataFrame([], schema)
    small = marked.where(F.col("_rows") <= local_rows).drop("_rows")
    tried = small.withColumn("max_depth", F.explode(F.array(*[F.lit(d) for d in depths])))

    def whole_group(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(*row) for row in group[["n", "bins", "y", "train"]].itertuples(index=False)]
        bins, y, train = (np.concatenate([p[i] for p in parts]) for i in range(3))
        depth = int(group["max_depth"].iloc[0])
        made = _fitted_row(depth, *grow(bins, y, train, depth, budget, patience, tol))
        return pd.DataFrame([{**{k: group[k].iloc[0] for k in groups}, **made}], columns=schema.names)

    fitted = stage(tried.groupBy(*by, "max_depth").applyInPandas(whole_group, schema), "trees")
    if largest <= local_rows:
        return fitted
    large = marked.where(F.col("_rows") > local_rows).drop("_rows")
    return fitted.unionByName(_fit_by_level(large, groups, depths, budget, patience, tol, schema))


def _fit_by_level(chunks: DataFrame, groups, depths, budget: int, patience: int, tol: float, schema: T.StructType) -> DataFrame:
    """The level form. The state of a (group, depth) is one row of `fits`; it never leaves the tasks."""
    keys = [*groups, "max_depth"]
    by = [named(k) for k in keys]
    held = schema.fieldNames()[: len(groups)]
    state = chunks.withColumn("max_depth", F.explode(F.array(*[F.lit(d) for d in depths])))
    state = stage(state.withColumn("pred", F.lit(None).cast("binary")), "state")
    fit_schema = T.StructType([
        *[f for f in schema if f.name in keys], T.StructField("level", T.IntegerType()), T.StructField("written", T.IntegerType()),
        T.StructField("trees", T.BinaryType()), T.StructField("losses", T.ArrayType(T.DoubleType())),
        T.StructField("maes", T.ArrayType(T.DoubleType())), T.StructField("ended", T.BooleanType()),
    ])
    fits = state.select(*by).distinct().select(
        *by, F.lit(0).alias("level"), F.lit(0).alias("written"), F.lit(b"").alias("trees"),
        F.array().cast("array<double>").alias("losses"), F.array().cast("array<double>").alias("maes"), F.lit(False).alias("ended"),
    )
    fits = stage(fits, "fits")

    def trees_of(blob: bytes, depth: int) -> list[np.ndarray]:
        return list(np.frombuffer(blob, NODE).reshape(-1, (2 << depth) - 1))

    def predicted(row, finished):
        """Prediction of a chunk: the written one and the finished trees since."""
        bins, y, train = _unpacked(row["n"], row["bins"], row["y"], row["train"])
        pred = np.zeros(len(y)) if row["pred"] is None else np.frombuffer(row["pred"], float)
        return bins, y, train, pred + ensemble(finished[row["written"]:], bins, row["max_depth"], row["written"])

    sums_schema = T.StructType([*[f for f in schema if f.name in keys], T.StructField("sums", T.BinaryType()), T.StructField("errors", T.ArrayType(T.DoubleType()))])

    def sum_chunks(batches):
        """Histograms of the open level and errors so far, added up over the chunks that a task has of a (group, depth)."""
        held, arrow = {}, None

        def out():
            rows = [{**dict(zip(keys, key)), "sums": sums.tobytes(), "errors": missed.tolist()} for key, (sums, missed) in held.items()]
            held.clear()
            return pa.RecordBatch.from_pylist(rows, schema=arrow)

        for batch in batches:
            if arrow is None:
                arrow = pa.schema([*[batch.schema.field(k) for k in keys], pa.field("sums", pa.binary()), pa.field("errors", pa.list_(pa.float64()))])
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                depth, level = row["max_depth"], row["level"]
                trees = trees_of(row["trees"], depth)
                finished, tree = (trees, new_tree(depth)) if level == 0 else (trees[:-1], trees[-1])
                bins, y, train, pred = predicted(row, finished)
                found = histograms(bins[train], open_slots(tree, bins[train], level), (y - pred)[train], 1 << level)
                missed = np.concatenate([errors(y, pred, ~train), errors(y, pred, train)])
                key = tuple(row[k] for k in keys)
                if key in held:
                    held[key] = held[key][0] + found, held[key][1] + missed
                else:
                    if len(held) >= HELD_SUMS:
                        yield out()
                    held[key] = found, missed
        if held:
            yield out()

    def add_up(batches):
        """The sums of each (group, depth), whose rows come one after the other."""
        now, arrow = None, None

        def out():
            key, sums, missed = now
            return pa.RecordBatch.from_pylist([{**dict(zip(keys, key)), "sums": sums.tobytes(), "errors": missed.tolist()}], schema=arrow)

        for batch in batches:
            arrow = arrow or batch.schema
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                key, sums, missed = tuple(row[k] for k in keys), np.frombuffer(row["sums"], float), np.array(row["errors"])
                if now is not None and key == now[0]:
                    now = key, now[1] + sums, now[2] + missed
                else:
                    if now is not None:
                        yield out()
                    now = key, sums, missed
        if now is not None:
            yield out()

    def advance(batches):
        """The next step of each (group, depth): judge a finished tree, begin one, or split a level."""
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                depth, level, missed = row["max_depth"], row["level"], row["errors"]
                trees = [t.copy() for t in trees_of(row["trees"], depth)]
                progress = Progress(patience, tol, zip(row["losses"], row["maes"]))
                if level == 0 and trees:
                    progress.add(*_judged(missed[:3], missed[3:]))
                ended = level == 0 and (progress.ended or len(trees) >= budget)
                if not ended:
                    if level == 0:
                        trees.append(new_tree(depth))
                    split_nodes(trees[-1], level, np.frombuffer(row["sums"], float).reshape(1 << level, -1, BINS, 2))
                rows.append({
                    **{k: row[k] for k in keys}, "level": 0 if ended else (level + 1) % depth, "written": row["written"],
                    "trees": b"".join(t.tobytes() for t in trees), "losses": progress.losses, "maes": progress.maes, "ended": ended,
                })
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([batch.schema.field(f.name) for f in fit_schema]))

    state_schema = state.schema

    def write_predictions(batches):
        names = state_schema.fieldNames()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                trees = trees_of(row["trees"], row["max_depth"])
                row["pred"] = predicted(row, trees if row["level"] == 0 else trees[:-1])[3].tobytes()
                yield pa.RecordBatch.from_pylist([{c: row[c] for c in names}], schema=pa.schema([batch.schema.field(c) for c in names]))

    open_, done, passes = fits, None, 0
    while not open_.isEmpty():
        joined = join_on(state, small_or_not(open_.drop("losses", "maes", "ended")), keys)
        summed = joined.mapInArrow(sum_chunks, sums_schema).repartition(*by).sortWithinPartitions(*by).mapInArrow(add_up, sums_schema)
        fits = stage(join_on(summed, small_or_not(open_), keys).mapInArrow(advance, fit_schema), "fits")
        done = fits.where("ended") if done is None else done.unionByName(fits.where("ended"))
        open_ = fits.where("NOT ended")
        passes += 1
        if passes % (KEPT_TREES * depths[-1]) == 0:
            again = join_on(state, small_or_not(open_.drop("losses", "maes", "ended")), keys)
            state = stage(again.mapInArrow(write_predictions, state_schema), "state")
            finished = F.expr("CAST(length(trees) / (((2 << max_depth) - 1) * 12) AS INT) - IF(level > 0, 1, 0)")
            open_ = stage(open_.withColumn("written", finished), "fits")

    def close(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                progress = Progress(patience, tol, zip(row["losses"], row["maes"]))
                rows.append({**{k: row[k] for k in held}, **_fitted_row(row["max_depth"], progress, trees_of(row["trees"], row["max_depth"]))})
            types = {"epoch": pa.int64(), "mse": pa.float64(), "mae": pa.float64(), "losses": pa.list_(pa.float64()), "maes": pa.list_(pa.float64()), "trees": pa.binary()}
            fields = [pa.field(c, types[c]) if c in types else batch.schema.field(c) for c in schema.fieldNames()]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    return done.mapInArrow(close, schema)


# --- a fitted model ---------------------------------------------------------------------


class TreeFit:
    """The trees of one group as a model; used like an MLlib model. A null or NaN feature gives a null prediction."""

    name = "gbt"

    def __init__(self, features, edges, max_depth: int, trees: bytes):
        self.features, self.edges, self.max_depth, self.trees = list(features), [list(e) for e in edges], int(max_depth), bytes(trees)

    def transform(self, rows: DataFrame) -> DataFrame:
        edges, depth, blob = self.edges, self.max_depth, self.trees

        @F.pandas_udf("double")
        def predict(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            trees = list(np.frombuffer(blob, NODE).reshape(-1, (2 << depth) - 1))
            for batch in columns:
                values = np.stack([c.to_numpy(float) for c in batch], axis=1)
                pred = ensemble(trees, binned(values, edges), depth)
                yield pd.Series(np.where(np.isnan(values).any(axis=1), np.nan, pred))

        given = [named(c).cast("double") for c in self.features]
        whole = F.lit(True)
        for c in given:
            whole = whole & c.isNotNull() & ~F.isnan(c)
        return rows.withColumn(f"pred_{self.name}", F.when(whole, predict(*given)))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(
            [(self.features, self.edges, self.max_depth, bytearray(self.trees))],
            "features array<string>, edges array<array<double>>, max_depth int, trees binary",
        ).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeFit":
        return TreeFit(*spark.read.parquet(path).first())


def fit_tree_model(train: DataFrame, features, target: str, max_depth: int, budget: int, **settings) -> TreeFit:
    """The model that a search tried, on all train rows: the same growth, depth and budget; the best epoch on the train rows."""
    rows = train.select(*[named(c) for c in features], named(target), F.lit("train").alias("role"))
    edges = bin_edges(rows, features)
    fitted = fit_trees(pack(rows, [], features, target, edges), [], [max_depth], budget, **settings).first()
    if fitted is None:
        raise ValueError("no train row has all features and a target")
    return TreeFit(features, edges, max_depth, fitted.trees)
