import random

import numpy as np
import pytest

from brute import near_classes as plain_classes
from tidemark.llm import near
from tidemark.llm.components import components, forest


def variants(seed, n, words=120, edits=3):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{rng.randint(0, 9999)}"
        out.append(" ".join(copy))
    return out


def check(spark, texts):
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "at int, text string, n_links int").coalesce(1)
    rows = near.near_classes(df).collect()
    first = {}
    for r in sorted(rows, key=lambda r: r["at"]):
        first.setdefault(r.class_no, r["at"])
    got = {r["at"]: (first[r.class_no], r.n_links, r.n_copies) for r in rows}
    assert [got[i] for i in range(len(texts))] == plain_classes(texts)
    kept = sorted(r["at"] for r in near.keep_one(df).collect())
    assert kept == sorted(first.values())


def test_same_as_brute_force(spark, texts):
    check(spark, texts + variants(1, 30) + variants(2, 5, words=9) + variants(3, 12, edits=9))


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_SETS", 7)
    monkeypatch.setattr(near, "CLUSTER_SETS", 5)
    monkeypatch.setattr(near, "CLUSTER_SHINGLES", 900)
    monkeypatch.setattr(near, "LOW_DF", 4)
    check(spark, variants(4, 40) + variants(5, 6) + ["a b"] * 4)


def test_blocks_without_sets_count_no_link_twice(spark, monkeypatch):
    """Clusters of two or three very long sets, in more blocks than they have sets."""
    monkeypatch.setattr(near, "CLUSTER_SHINGLES", 90)
    check(spark, [t for seed in range(20, 36) for t in variants(seed, 2 + seed % 2, edits=2)])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_classes(df).collect() == [] and near.keep_one(df).collect() == []


def test_posterior_bounds():
    """The fewest matches that keep a pair are those whose posterior chance reaches the tolerance."""
    least = near.least_matches(0.8, 1e-6)
    random_ = np.random.default_rng(1)
    p = 0.8 + 0.2 / 256
    for n, m in zip(range(16, 129, 16), least):
        assert 0 <= m <= n
        draws = random_.beta(m + 1, n - m + 1, 200_000)
        assert (draws >= p).mean() < 1e-3  # a chance near 1e-6
    # pairs at the threshold are practically never dropped
    matches = random_.random((200_000, 128)) < p
    running = matches.cumsum(1)[:, 15::16]
    assert (running < np.array(least)).any(1).mean() < 1e-4


def test_intersections_of_common_and_rare_shingles(monkeypatch):
    monkeypatch.setattr(near, "COLUMNS", 3)
    random_ = np.random.default_rng(2)
    sets = [np.unique(random_.integers(0, 60, random_.integers(1, 50))).astype(np.uint64) for _ in range(70)]
    got = near.intersections(np.repeat(np.arange(70), [len(s) for s in sets]), np.concatenate(sets), 70)
    for i in range(70):
        for j in range(70):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(20)] + [(500, 500)]
    label = forest(600, *np.array(edges).T)
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: label[v] for v in {x for e in edges for x in e}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
