import random
from collections import Counter, defaultdict

import pytest

from brute import words
from tidemark.llm import packing


def one_by_one(lengths, capacities, overhead):
    """Best fit of single pieces, longest first: (room, capacity, pieces) of each bin."""
    counts, bins = Counter(lengths), []
    shorter = sum(lengths)
    for length in sorted(counts, reverse=True):
        shorter -= length * counts[length]
        left = counts[length]
        while left:
            open_ = [b for b in bins if b[0] >= length]
            if not open_:
                capacity = packing.cheapest(length, left, shorter, capacities, overhead)
                for _ in range(max(left // (capacity // length), 1)):
                    bins.append([capacity, capacity, []])
                open_ = [b for b in bins if b[0] >= length]
            best = min(open_, key=lambda b: b[0])
            best[0] -= length
            best[2].append(length)
            left -= 1
    return bins


@pytest.mark.parametrize("seed", range(40))
def test_histogram_is_packed_as_single_pieces_are(seed):
    rng = random.Random(seed)
    capacities = rng.choice([(8, 16, 32), (10,), (5, 7, 40), (3, 64)])
    lengths = [rng.randint(1, max(capacities)) for _ in range(rng.randint(1, 80))]
    groups = packing.pack_histogram(dict(Counter(lengths)), capacities, 3)
    plain = one_by_one(lengths, capacities, 3)
    cut = Counter(min(c for c in capacities if c >= sum(b[2])) for b in plain if b[2])
    bulk = Counter()
    for b in groups:
        used = sum(a * n for a, n in b.contents)
        assert used <= b.capacity == min(c for c in capacities if c >= used)
        bulk[b.capacity] += b.count
    assert bulk == cut
    held = Counter()
    for b in groups:
        for a, n in b.contents:
            held[a] += n * b.count
    assert held == Counter(lengths)


def test_every_word_once_without_overlap(spark, texts):
    rows = [(i % 5 if i else None, t, i, 7) for i, t in enumerate(texts * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, at long, capacity int").repartition(3)
    got = packing.pack(df, key="at", capacities=(64, 256, 1000), words=True).collect()
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        bins[r.bin_id].append(r)
        pieces[r["at"]].append(r)
        assert r.text == " ".join(words(rows[r["at"]][1])[r.first_word:r.first_word + r.n_words])
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: r.position):
            assert r.position == at
            at += r.n_words
        assert {r.capacity for r in held} == {min(c for c in (64, 256, 1000) if c >= at)}
    assert sorted(bins) == list(range(len(bins)))
    for _, text, i, _ in rows:
        spans = sorted((r.first_word, r.n_words) for r in pieces[i])
        assert sum(n for _, n in spans) == len(words(text)) and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_null_repeated_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None), (3, " \n")], "doc_id long, text string")
    got = packing.pack(df, capacities=(4,)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "None"] and sum(r.n_words for r in got) == 6
    assert packing.pack(df.where("false")).collect() == []


def test_bad_settings_raise():
    with pytest.raises(ValueError):
        packing.pack_histogram({5: 1}, (4,))
    with pytest.raises(ValueError):
        packing.pack_histogram({1: 1}, ())
