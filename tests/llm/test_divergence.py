import numpy as np
import pytest

from brute import base_counts
from tidemark.llm import divergence

SF = "/root/testdata/sf0.01"


def test_base_counts_are_those_of_the_definition(spark, texts):
    df = spark.createDataFrame([(i, t, "xx", True) for i, t in enumerate(texts)], "at int, text string, lang string, kept boolean").repartition(3)
    rows = divergence.quality_rules(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts = base_counts(texts[r["at"]])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_distance_is_jensen_shannon():
    p, q = np.array([[3, 1, 0], [0, 0, 0], [1, 1, 2]]), np.array([0.25, 0.25, 0.5])
    got = divergence.distances(p, q)
    assert got[1] == 1.0 and got[2] == pytest.approx(0)
    share = p[0] / 4
    middle = (share + q) / 2
    kl = lambda a: sum(x * np.log2(x / m) for x, m in zip(a, middle) if x)
    assert got[0] == pytest.approx(np.sqrt((kl(share) + kl(q)) / 2))
    assert divergence.distances(np.array([[5, 0]]), np.array([0.0, 1.0]))[0] == pytest.approx(1)


def test_references_are_exact(spark):
    """Common words by document share and shares over the nearer half, against plain counting."""
    docs = ["the cat sat on the mat " * 3, "the dog and the cat", "A dog, a Dog!", "$$$$ %%%% the"] * 5
    df = spark.createDataFrame([(t, "en") for t in docs] + [("le chat", "fr"), ("x", None)], "text string, lang string").repartition(4)
    got = divergence.learn_references(df)
    assert set(got) == {"en", "fr"}
    assert len(got["en"].words) == len({"the", "cat", "sat", "on", "mat", "dog", "and", "a", "dog,", "dog!", "$$$$", "%%%%"})
    assert got["en"].classes.sum() == pytest.approx(1) and got["en"].shares.sum() == pytest.approx(1)
    assert got["fr"].shares.tolist() == [0.5, 0.5, 0.0]
    symbols = divergence.CLASSES.index("symbol")
    assert got["en"].classes[symbols] == 0  # the junk is not in the nearer half


def test_junk_goes_and_labelled_good_texts_stay(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = divergence.quality_rules(docs).join(labels, "doc_id").where("NOT base_failed").select("quality", "kept").collect()
    bad, good = [r.kept for r in rows if not r.quality], [r.kept for r in rows if r.quality]
    assert bad and sum(bad) == 0 and np.mean(good) > 0.98


def test_unknown_languages_ties_and_empty_tables(spark):
    text = "the cat and the dog sat on the mat with a hat " * 8
    df = spark.createDataFrame([(text + str(i), None) for i in range(4)], "text string, lang string")
    rows = divergence.quality_rules(df).collect()
    assert all(r.char_distance is None and r.base_failed and not r.kept for r in rows)
    none = spark.createDataFrame([], "text string, lang string")
    assert divergence.quality_rules(none).collect() == [] and divergence.learn_references(none) == {}


def test_rare_languages_have_a_reference_of_their_own(spark):
    """Three Greek texts among 4,000 English ones, under 0.1%, are not compared with English."""
    def prose(letters, seed):
        random = np.random.default_rng(seed)
        words = ["".join(letters[(i * 7 + k * 3) % len(letters)] for k in range(3 + i % 5)) for i in range(60)]
        return " ".join(words[i] for i in random.permutation(60))

    rows = [(prose("abcdefghijklmnop", i), "en") for i in range(4000)] + [(prose("αβγδεζηθικλμνξοπ", i), "el") for i in range(3)]
    got = divergence.quality_rules(spark.createDataFrame(rows, "text string, lang string").coalesce(2)).where("lang = 'el'").collect()
    assert len(got) == 3 and all(r.kept and r.char_distance < 0.1 for r in got)
    references = {"en": divergence.Reference(np.ones(len(divergence.CLASSES)) / len(divergence.CLASSES), np.empty(0, np.uint64), np.ones(1))}
    judged = divergence.judge(divergence.pa.array([rows[-1][0]]), ["el"], references, divergence.CHAR_LIMIT, divergence.WORD_LIMIT)
    assert judged[6].to_pylist() == [True]  # no reference: the base rule alone
