import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.plans.trees import SHRINKAGE, TreeFit, bin_edges, fit_tree_model, fit_trees, pack
from tidemark.plans.tuning import walk_forward_evaluator

FEATURES = ["x", "z", "w"]


def rows_of(spark, n=160, folds=2, seed=3):
    """Rows of some folds with a step, a product and a copied feature; a fifth validates."""
    rng = np.random.default_rng(seed)
    out = []
    for fold in range(folds):
        for i in range(n):
            x, z = float(rng.normal()), float(rng.integers(0, 6))
            y = 2.0 * (x > 0.3) + x * z + 0.1 * float(rng.normal())
            out.append((fold, "validation" if i % 5 == 0 else "train", x, z, x, y))
    return spark.createDataFrame(out, "fold long, role string, x double, z double, w double, y double")


def plain_tree(x, y, edges, depth):
    """Prediction function of the tree that every split search by plain loops gives."""
    best = None
    if depth:
        whole = y.sum() ** 2 / len(y)
        for f, cuts in enumerate(edges):
            for cut in cuts:
                left = x[:, f] <= cut
                if left.any() and not left.all():
                    gain = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() - whole
                    if gain > 0 and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = gain, f, cut
    if best is None:
        value = y.mean()
        return lambda rows: np.full(len(rows), value)
    _, f, cut = best
    left = x[:, f] <= cut
    low, high = plain_tree(x[left], y[left], edges, depth - 1), plain_tree(x[~left], y[~left], edges, depth - 1)
    return lambda rows: np.where(rows[:, f] <= cut, low(rows), high(rows))


def plain_losses(data, edges, depth, budget):
    train, other = data[data.role == "train"], data[data.role != "train"]
    other = other if len(other) else train
    x, y, vx, vy = (train[FEATURES].to_numpy(), train.y.to_numpy(), other[FEATURES].to_numpy(), other.y.to_numpy())
    pred, v_pred, losses = np.zeros(len(y)), np.zeros(len(vy)), []
    for t in range(budget):
        tree = plain_tree(x, y - pred, edges, depth)
        weight = SHRINKAGE if t else 1.0
        pred, v_pred = pred + weight * tree(x), v_pred + weight * tree(vx)
        losses.append(((vy - v_pred) ** 2).mean())
    return losses


@pytest.mark.parametrize("local_rows, chunk_rows", [(250_000, 50_000), (250_000, 37), (0, 37), (0, 1000)])
def test_same_trees_as_plain_loops_in_both_forms(spark, local_rows, chunk_rows):
    df = rows_of(spark)
    edges = bin_edges(df, FEATURES)
    assert len(edges[0]) == 31 and edges[1] == sorted(set(edges[1])) and len(edges[1]) <= 6
    chunks = pack(df, ["fold"], FEATURES, "y", edges, chunk_rows)
    fitted = {(r.fold, r.max_depth): r for r in fit_trees(chunks, ["fold"], [1, 3], 4, local_rows=local_rows).collect()}
    assert sorted(fitted) == [(0, 1), (0, 3), (1, 1), (1, 3)]
    data = df.toPandas()
    for (fold, depth), r in fitted.items():
        want = plain_losses(data[data.fold == fold], edges, depth, 4)
        assert r.losses == pytest.approx(want, rel=1e-9)
        assert r.epoch == 4 and r.mse == min(r.losses)


def test_predictions_written_between_trees_change_nothing(spark, monkeypatch):
    from tidemark.plans import trees

    df = rows_of(spark, n=60, folds=1)
    edges = bin_edges(df, FEATURES)
    chunks = pack(df, ["fold"], FEATURES, "y", edges, 20)
    want = fit_trees(chunks, ["fold"], [1, 2], 5).collect()
    monkeypatch.setattr(trees, "KEPT_TREES", 1)
    got = fit_trees(chunks, ["fold"], [1, 2], 5, local_rows=0).collect()
    for a, b in zip(sorted(want, key=lambda r: r.max_depth), sorted(got, key=lambda r: r.max_depth)):
        assert a.losses == pytest.approx(b.losses, rel=1e-9) and a.max_depth == b.max_depth


@pytest.mark.parametrize("local_rows", [250_000, 0])
def test_early_stop_keeps_the_best_epoch(spark, local_rows):
    """Validation rows that say the opposite: the first tree is the best one."""
    df = rows_of(spark, n=80, folds=1).withColumn("y", F.when(F.col("role") == "train", F.col("x")).otherwise(-F.col("x")))
    chunks = pack(df, ["fold"], FEATURES, "y", bin_edges(df, FEATURES))
    r = fit_trees(chunks, ["fold"], [2], 50, patience=3, local_rows=local_rows).first()
    assert r.epoch == len(r.losses) == 4 and r.mse == r.losses[0]
    assert len(r.trees) == 7 * 12


@pytest.mark.parametrize("local_rows", [250_000, 0])
def test_nulls_nan_repeats_and_groups_without_train_rows(spark, local_rows):
    df = rows_of(spark, n=50, folds=1)
    odd = [(0, "train", None, 1.0, 1.0, 9.0), (0, "train", 1.0, float("nan"), 1.0, 9.0), (0, "train", 1.0, 1.0, 1.0, None), (7, "validation", 1.0, 1.0, 1.0, 1.0)]
    more = df.unionByName(spark.createDataFrame(odd, df.schema))
    edges = bin_edges(df, FEATURES)
    fit = lambda rows: fit_trees(pack(rows, ["fold"], FEATURES, "y", edges), ["fold"], [2], 3, local_rows=local_rows).collect()
    a, b = fit(df), fit(more)
    assert [r.fold for r in b] == [0] and a[0].losses == pytest.approx(b[0].losses, rel=1e-9)
    assert fit(df.limit(0)) == []
    same = spark.createDataFrame([(0, "train", 1.0, 1.0, 1.0, 5.0)] * 10, df.schema)
    flat = fit_trees(pack(same, ["fold"], FEATURES, "y", bin_edges(same, FEATURES)), ["fold"], [2], 3, local_rows=local_rows).first()
    assert flat.mse == 0.0 and flat.losses[0] == 0.0


def test_model_predicts_as_it_was_fitted(spark, tmp_path):
    train = rows_of(spark, n=300, folds=1).select(*FEATURES, "y")
    model = fit_tree_model(train, FEATURES, "y", 3, 20)
    data = train.toPandas().assign(role="train")
    want = min(plain_losses(data, model.edges, 3, 20))
    mse = lambda m: m.transform(train).agg(F.avg((F.col("pred_gbt") - F.col("y")) ** 2)).first()[0]
    assert mse(model) == pytest.approx(want, rel=1e-9)
    model.save(spark, str(tmp_path / "gbt"))
    assert mse(TreeFit.load(spark, str(tmp_path / "gbt"))) == pytest.approx(want, rel=1e-9)
    holes = spark.createDataFrame([(None, 1.0, 1.0), (1.0, 1.0, 1.0), (float("nan"), 1.0, 1.0)], "x double, z double, w double")
    assert [r.pred_gbt is None for r in model.transform(holes).collect()] == [True, False, True]


def test_evaluator_averages_folds_and_shares_depths(spark):
    rng = np.random.default_rng(5)
    rows = [(s, i, float(rng.normal()), float(i % 3), float(rng.normal())) for s in ("a", "b") for i in range(120)]
    df = spark.createDataFrame(rows, "series string, dt int, x double, z double, y double")
    evaluate = walk_forward_evaluator(df, ["series"], ["dt"], ["x", "z"], "gbt", "y", train=40, validation=20, gap=5)
    configs = [{"config_id": i, "max_depth": d, "learning_rate": 0.1, "l2": 0.0} for i, d in enumerate([1, 2, 2])]
    scored = {r.config_id: (r.mse, r.mae_ratio) for r in evaluate(configs, 3).collect()}
    assert sorted(scored) == [0, 1, 2] and scored[1] == scored[2] != scored[0]
    per_fold = evaluate.fits([(configs, 3)]).where("config_id = 0").collect()
    assert len(per_fold) == 3 and scored[0][0] == pytest.approx(np.mean([r.mse for r in per_fold]))
