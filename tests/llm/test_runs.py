import random

import brute
from pyspark.sql import functions as F

from tidemark.llm import runs
from tidemark.llm.queries import looped

SCHEMA = "id long, text string"


def rows_of(df):
    return {r.id: r for r in df.collect()}


def test_same_as_brute_force(spark, texts):
    rng = random.Random(8)
    made = []
    for _ in range(300):
        letters = "abcd"[: rng.randint(1, 4)]
        w = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            unit = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
            at = rng.randint(0, len(w))
            w[at:at] = (unit * 8)[: rng.randint(0, 8 * len(unit))]
        made.append(rng.choice([" ", "\n", " \t "]).join(w))
    all_texts = [t for t in texts if t is None or len(t) < 20_000] + made
    found = rows_of(runs.collapse_runs(spark.createDataFrame(list(enumerate(all_texts)), SCHEMA)))
    assert len(found) == len(all_texts)
    n_found = 0
    for i, text in enumerate(all_texts):
        w = brute.words(text)
        want = brute.runs(w)
        n_found += len(want)
        assert [tuple(r) for r in found[i].runs] == want
        assert (found[i].n_words, found[i].n_runs, found[i].collapsed) == (len(w), len(want), brute.collapsed(w))
    assert n_found > 100


def test_hand_worked(spark):
    cases = ["a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "z a b c a b c a b c a b c a z", "a a a a a a b a a a a a a b a a a a a a b a a a a a a b"]
    found = rows_of(runs.collapse_runs(spark.createDataFrame(list(enumerate(cases)), SCHEMA)))
    assert [[tuple(r) for r in found[i].runs] for i in range(len(cases))] == [
        [], [(0, 6, 1)], [(0, 8, 2)], [], [(1, 13, 3)],
        [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)],
    ]
    assert [found[i].collapsed for i in range(len(cases))] == ["a a a a a", "a", "a b", "a b a b a b a", "z a b c z", "a b"]


def test_very_long_texts(spark):
    cases = ["x " * 300_000, ("x " * 1000 + "y ") * 300, " ".join(map(str, range(50_000))) + " ", (" ".join(map(str, range(30_000))) + " ") * 4]
    found = rows_of(runs.collapse_runs(spark.createDataFrame(list(enumerate(cases)), SCHEMA)))
    assert [found[i].n_runs for i in range(4)] == [1, 301, 0, 1]
    assert tuple(found[0].runs[0]) == (0, 300_000, 1)
    assert (0, 300_300, 1001) in [tuple(r) for r in found[1].runs]
    assert tuple(found[3].runs[0]) == (0, 120_000, 30_000)


def test_strongest_is_exact(spark):
    big = 10**6
    cases = [
        [], [(5, 8, 2), (1, 4 * big + 1, big)], [(9, 12, 3), (2, 8, 2), (2, 4, 1)], [(0, 4 * big - 1, big - 1), (7, 4 * (big + 1) + 3, big + 1)],
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id long, runs array<struct<start:long,length:long,period:long>>")
    best = {r.id: r.best and tuple(r.best) for r in df.select("id", runs.strongest(F.col("runs")).alias("best")).collect()}
    assert best == {0: None, 1: (1, 4 * big + 1, big), 2: (2, 4, 1), 3: (0, 4 * big - 1, big - 1)}


def test_empty_tables_repeats_and_clashing_columns(spark):
    assert runs.collapse_runs(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [("a b a b a b a b", 1, "k", None), ("a b a b a b a b", 1, "k", None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "text string, n_runs long, `odd.name` string, collapsed string")
    out = runs.collapse_runs(df)
    assert out.columns == ["text", "odd.name", "n_words", "n_runs", "runs", "collapsed"]
    assert sorted((r.text or "", r.n_runs, r.collapsed) for r in out.collect()) == [("", 0, ""), ("a b a b a b a b", 1, "a b"), ("a b a b a b a b", 1, "a b")]
    own = runs.collapse_runs(df.select(F.col("text").alias("runs")), "runs")
    assert sorted(r.n_runs for r in own.collect()) == [0, 1, 1]


def test_looped_texts(spark):
    import zlib

    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i % 50))) for i in range(300)] + [(None, "a b"), (7, None)], "doc_id long, text string")
    made = [(r.doc_id, r.text) for r in looped(docs).collect()]
    want = []
    for doc_id, text in [(r.doc_id, r.text) for r in docs.collect()]:
        w = brute.words(text)
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            text = " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))
        want.append((doc_id, text))
    assert made == want
