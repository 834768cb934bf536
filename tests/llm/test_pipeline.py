"""The pipeline's stages on a small table, each against a plain version working on the same input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import near_classes, without_repeats, words
from tidemark.llm import divergence, nbsvm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of the input and of every stage, written and read again, from documents with odd extra columns."""
    at = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (900_001, "a b c", None, None, 5)], docs.schema)
    long = spark.createDataFrame([(900_002, " ".join(f"the{i} and of" for i in range(4000)), "en", "s", 1), (900_002, " ".join(f"the{i} and of" for i in range(4000)), "en", "s", 1)], docs.schema)
    docs = docs.unionByName(odd).unionByName(long)
    for name in ("kept", "score", "_row", "n_words", "_n", "kept_text", "set_id"):
        docs = docs.withColumn(name, F.lit("mine"))
    out = [docs]
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, out[-1], SF).write.parquet(f"{at}/{i}")
        out.append(spark.read.parquet(f"{at}/{i}"))
    return out


def test_all_stages_but_the_last_return_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.dtypes == stages[0].dtypes
        assert df.where("kept <> 'mine' OR _row <> 'mine'").count() == 0


def test_rules_drop_what_they_reject(stages):
    judged = divergence.quality_rules(stages[0].select("doc_id", "text", "lang")).where("kept").select("doc_id").collect()
    assert sorted(r.doc_id for r in judged) == sorted(r.doc_id for r in stages[1].select("doc_id").collect())
    assert all(len(words(r.text)) >= 50 for r in stages[1].collect())


def test_classifier_drops_what_it_rejects(spark, stages):
    known, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = nbsvm.fit(nbsvm.labelled_rows(known, labels))
    scores = nbsvm.score(stages[1].select("doc_id", "text"), model).select("doc_id", "score").collect()
    assert sorted(r.doc_id for r in scores if r.score >= 0.7) == sorted(r.doc_id for r in stages[2].select("doc_id").collect())
    good = [r.doc_id for r in labels.where("quality = 1").collect()]
    before, after = ({r.doc_id for r in df.select("doc_id").collect()} for df in stages[1:3])
    assert np.mean([d in after for d in good if d in before]) > 0.95


def test_one_document_of_each_class_stays(stages):
    rows = stages[2].select("doc_id", "text").collect()
    kept = [r.doc_id for r in stages[3].select("doc_id").collect()]
    classes = near_classes([r.text for r in rows])
    members = {}
    for r, (root, _, _) in zip(rows, classes):
        members.setdefault(root, []).append(r.doc_id)
    assert len(kept) == len(members)
    left = sorted(kept)
    for group in members.values():
        found = [d for d in left if d in group]
        assert len(set(found)) == 1


def test_repeated_passages_go(stages):
    rows = sorted(stages[3].select("doc_id", "text").collect())
    expected = without_repeats([r.text for r in rows])
    got = sorted(stages[4].select("doc_id", "text", "n_chars").collect())
    assert [(r.doc_id, e[2], len(e[2])) for r, e in zip(rows, expected)] == [tuple(r) for r in got]


def test_every_word_left_is_packed(stages):
    left = sum(len(words(r.text)) for r in stages[4].collect())
    packed = stages[5].collect()
    assert sum(r.n_words for r in packed) == sum(len(words(r.text)) for r in packed) == left


def test_run_gives_the_same_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
    key = lambda df: sorted((r.doc_id, r.piece, r.text) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(docs)


@pytest.mark.parametrize("k", range(5))
def test_empty_tables(spark, k):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    assert corpus_pipeline.STAGES[k][1](spark, docs, SF).collect() == []
