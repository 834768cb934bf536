"""From raw documents to packed training sequences: rules, classifier, near copies, repeats, packing.

Each stage is written to the shared folder and read again, so a lost executor costs one stage at
most. All stages but the last return the columns of their input. The classifier learns from the
labelled rows of the documents table itself, as its input has lost most of one class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import divergence, near, nbsvm, packing, repeats
from tidemark.session import stage

ACCEPTED = 0.7


def _shielded(docs: DataFrame, work) -> DataFrame:
    """Apply `work(renamed, names)` with columns renamed, so that none clashes with an operator's, and name them back."""
    inner = [f"_in{i}" for i in range(len(docs.columns))]
    names = dict(zip(docs.columns, inner))
    return work(docs.toDF(*inner), names).select(*inner).toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _shielded(docs, lambda d, n: divergence.quality_rules(d, n["text"], n["lang"]).where("kept"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = nbsvm.fit(nbsvm.labelled_rows(known, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return _shielded(docs, lambda d, n: nbsvm.score(d, model, n["text"]).where(F.col("score") >= ACCEPTED))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _shielded(docs, lambda d, n: near.keep_one(d, n["text"]))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def work(d, n):
        kept = repeats.drop_repeats(d, n["text"]).withColumn(n["text"], F.col("kept_text"))
        return kept.withColumn(n["n_chars"], F.length("kept_text").cast("long")) if "n_chars" in n else kept

    return _shielded(docs, work)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, words=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None  # the classifier is fitted; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
