import random
import re
from itertools import combinations

import brute
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash

SCHEMA = "doc_id long, text string"


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = brute.words(text)
    pieces = [" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(prints))]


def test_masks_cover_every_small_difference():
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(list(range(64)), 3)]
    assert len(masks) == 15
    for places in combinations(range(64), 3):
        assert any(not any(m >> p & 1 for p in places) for m in masks)
    fine = [m & (1 << 64) - 1 for m in simhash.finer_masks(masks[4], 3)]
    open_ = [p for p in range(64) if not masks[4] >> p & 1]
    assert all(m & masks[4] == masks[4] and 64 - m.bit_count() <= 16 for m in fine)
    for places in combinations(open_, 3):
        assert any(not any(m >> p & 1 for p in places) for m in fine)


def test_texts_same_as_brute_force(spark, texts):
    rng = random.Random(3)
    base = [f"Word{rng.randint(0, 500)}" for _ in range(400)]
    near = []
    for _ in range(40):
        w = list(base)
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = f"other{rng.randint(0, 99)}"
        near.append(" ".join(w))
    all_texts = texts + near + ["One two three", "one TWO\tthree", "É é É", "é É é"]
    made = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_components(spark.createDataFrame(list(enumerate(all_texts)), SCHEMA)).collect()}
    prints = [fingerprint(t) for t in all_texts]
    assert [made[i][0] for i in range(len(all_texts))] == [f"{p:016x}" for p in prints]
    assert [made[i][1] for i in range(len(all_texts))] == classes(prints)
    assert len(set(classes(prints))) < len(set(prints))


@pytest.mark.parametrize("bucket_rows", [4096, 8])
def test_links_of_planted_fingerprints(spark, bucket_rows):
    """Random ones, chains, dense balls, both ends of the bits; small buckets are dealt out by finer masks."""
    rng = random.Random(bucket_rows)
    prints = {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1, 1 << 63, (1 << 64) - 8}
    for _ in range(6):
        p = rng.getrandbits(64)
        for _ in range(30):
            prints.add(p)
            for b in rng.sample(range(64), rng.choice([3, 3, 4])):
                p ^= 1 << b
    centre = rng.getrandbits(64)
    for _ in range(200):
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "_print long").repartition(5)
    links = [(r.a, r.b) for r in simhash.near_links(df, 3, bucket_rows).collect()]
    assert all(a != b for a, b in links)
    want = classes(prints)
    root = {s: s for s in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    ours = [find(s) for s in signed]
    assert len(set(zip(ours, want))) == len(set(want)) == len(set(ours))


def test_nulls_repeats_extra_columns_and_empty_tables(spark):
    assert simhash.near_components(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d"), (9, "a b c d"), (5, None), (5, ""), (None, " "), (7, "q r s t u v"), (None, "zz yy xx ww")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, _print int, component_id int")
    out = simhash.near_components(df)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    got = sorted(((r.doc_id, r.component_id) for r in out.collect()), key=str)
    assert got == sorted([(None, 9), (9, 9), (5, 5), (5, 5), (None, 5), (7, 7), (None, None)], key=str)


def test_copies_stay_one_vertex(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("the same words in every text").alias("text"))
    assert simhash.near_components(df).where("component_id = 0").count() == 5000
