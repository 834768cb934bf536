import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import nbsvm

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = nbsvm.held_out(F.col("doc_id"), 4, 2)
    model = nbsvm.fit(nbsvm.labelled_rows(docs.where(~held), labels))
    rows = nbsvm.score(docs.where(held), model).join(labels, "doc_id").select("quality", "score").collect()
    right = [(r.score >= 0.7) == bool(r.quality) for r in rows]
    assert len(rows) > 50 and np.mean(right) > 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_dual_descent_separates_and_respects_the_box():
    random = np.random.default_rng(0)
    signs = np.where(np.arange(60) % 2, 1.0, -1.0)
    rows = [(np.array([0 if s > 0 else 1, 2 + i % 5]), np.array([0.8, 0.6])) for i, s in enumerate(signs)]
    weights, bias = nbsvm.dual_descent(rows, signs, 30, 1.0)
    margins = np.array([weights[a] @ v + bias for a, v in rows])
    assert (np.sign(margins) == signs).all() and random is not None


def test_ratios_cover_all_rows(spark):
    rows = [("a", 1, "good text here"), ("b", 0, "bad text"), ("c", 1, "good"), (None, 0, "")]
    ratios, negatives, positives = nbsvm.log_count_ratios(spark.createDataFrame(rows, "id string, label int, text string").repartition(4))
    assert (negatives, positives) == (2, 2) and np.count_nonzero(np.abs(ratios - np.median(ratios)) > 1e-9) >= 3


@pytest.mark.parametrize("rows, expected", [([], 0.5), ([(1, 1, "a b c")] * 8, 0.9), ([(1, 0, "a b c")] * 8, 0.1)])
def test_without_two_classes_all_scores_are_the_share(spark, rows, expected):
    model = nbsvm.fit(spark.createDataFrame(rows, "id long, label int, text string"))
    df = spark.createDataFrame([(None, 3.0), ("", 4.0), ("some words", 5.0)], "text string, score double")
    assert [r.score for r in nbsvm.score(df, model).collect()] == pytest.approx([expected] * 3)


def test_the_fitted_rows_are_bounded_with_hot_copies(spark, monkeypatch):
    rows = [(None, i % 2, "same text") for i in range(400)] + [(i, i % 2, ("good words " if i % 2 else "bad ### words ") + str(i)) for i in range(300)]
    seen = []
    real = nbsvm.dual_descent
    monkeypatch.setattr(nbsvm, "dual_descent", lambda held, *rest: seen.append(len(held)) or real(held, *rest))
    nbsvm.fit(spark.createDataFrame(rows, "id long, label int, text string"), fit_rows=60)
    assert max(seen) <= 60


def test_labels_may_repeat_be_null_or_tie(spark):
    docs = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (3, "y"), (None, "z")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    rows = nbsvm.labelled_rows(docs, labels).collect()
    assert sorted((r.id, r.label, r.text) for r in rows) == [(1, 1, ""), (2, 0, "x"), (2, 0, "x")]


def test_long_and_odd_texts_have_scores(spark, texts):
    model = nbsvm.Classifier(np.ones(nbsvm.FEATURES), np.ones(nbsvm.FEATURES), 0.0, 1.0, 0.0)
    df = spark.createDataFrame(list(enumerate(texts)), "at int, text string")
    assert all(0 <= r.score <= 1 for r in nbsvm.score(df, model).collect())
    assert nbsvm.score(df.where("false"), model).collect() == []
