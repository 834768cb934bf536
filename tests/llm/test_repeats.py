import pytest

from brute import without_repeats
from tidemark.llm import repeats


@pytest.mark.parametrize("width, sketch_bytes", [(35, 1 << 20), (35, 1024), (4, 1 << 20)])
def test_same_as_brute_force(spark, texts, width, sketch_bytes):
    """A sketch so small that every cell is full only moves work to the exact groups."""
    rows = [(i % 7 if i % 3 else None, t, "old", i) for i, t in enumerate(texts)] * 1
    df = spark.createDataFrame(rows, "doc_id int, text string, kept_text string, at int").repartition(3)
    got = {r["at"]: (r.n_words, r.n_removed, r.kept_text) for r in repeats.drop_repeats(df, width=width, sketch_bytes=sketch_bytes).collect()}
    assert [got[i] for i in range(len(texts))] == without_repeats(texts, width)


def test_repeated_rows_and_small_batches(spark, texts, monkeypatch):
    monkeypatch.setattr(repeats, "SKETCH_WINDOWS", 50)
    monkeypatch.setattr(repeats, "FLUSH_WINDOWS", 40)
    monkeypatch.setattr(repeats, "MERGE_BYTES", 64)
    monkeypatch.setattr(repeats, "GROUP_WINDOWS", 100)
    many = texts[5:17] * 3
    df = spark.createDataFrame(list(enumerate(many)), "at int, text string").repartition(5)
    got = {r["at"]: (r.n_words, r.n_removed, r.kept_text) for r in repeats.drop_repeats(df).collect()}
    assert [got[i] for i in range(len(many))] == without_repeats(many)


def test_empty_table_and_null_texts(spark):
    df = spark.createDataFrame([], "doc_id int, text string")
    assert repeats.drop_repeats(df).collect() == []
    nulls = spark.createDataFrame([(1, None)], "doc_id int, text string")
    assert [tuple(r) for r in repeats.drop_repeats(nulls).collect()] == [(1, None, 0, 0, "")]
