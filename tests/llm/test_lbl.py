import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import words
from tidemark.llm import lbl, nbsvm

SF = "/root/testdata/sf0.01"
LOWER = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return [w.translate(LOWER) for w in words(text)] + ["\0end"]


def plain(rows):
    """n_tokens, n_known, train_tokens, base_score of (text, training) rows."""
    counts = Counter(t for text, training in rows if training for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    return [
        (len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), n, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(text)))
        for text, _ in rows
    ]


@pytest.mark.parametrize("head", [1 << 19, 3])
def test_counts_and_base_are_exact(spark, texts, head, monkeypatch):
    """With a short head most words go through the join with the table of counts."""
    monkeypatch.setattr(lbl, "HEAD", head)
    monkeypatch.setattr(lbl, "FLUSH_WORDS", 400)
    rows = [(t, i % 3 != 0) for i, t in enumerate(texts + ["One two", "ONE É", "é"])]
    df = spark.createDataFrame([(None if i == 4 else i % 9, t, k, i) for i, (t, k) in enumerate(rows)], "id int, text string, train boolean, score int").repartition(3)
    got = lbl.lm_scores(df.withColumn("id", F.col("score")), "id", "text", F.col("train"), shortlist=20, rounds=1).collect()
    assert len(got) == len(rows)
    for r in got:
        n_tokens, n_known, total, base = plain(rows)[r.id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.training) == (n_tokens, n_known, total, rows[r.id][1])
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0


def test_probabilities_are_normalised(spark):
    random = np.random.default_rng(1)
    model = lbl.Model.start(random.integers(1, 50, 30), 8)
    tables = lbl.score_tables(spark, model)
    for one, two in [(1, 1), (0, 5), (29, 2)]:
        token = np.arange(30)
        p = np.exp(tables.logs(token, np.full(30, one), np.full(30, two)).astype(float))
        assert p.sum() == pytest.approx(1, abs=1e-4) and p[lbl.START] < 1e-6
        predicted = model.context[one] * model.position[0] + model.context[two] * model.position[1]
        scores = model.target @ predicted + model.bias
        assert tables.logs(np.array([7]), np.array([one]), np.array([two]))[0] == pytest.approx(scores[7] - np.log(np.exp(scores[token != lbl.START]).sum()), abs=1e-3)


def test_training_learns_a_pattern():
    """a is always followed by b, b by a or c: the model must find it."""
    random = np.random.default_rng(0)
    chain = [3]
    for _ in range(60_000):
        chain.append(4 if chain[-1] in (3, 5) else int(random.choice([3, 5])))
    chain = np.array(chain)
    counts = np.bincount(chain, minlength=6)
    trainer = lbl.Trainer(lbl.Model.start(counts, 8), counts, 1)
    for _ in range(3):
        for i in range(2, len(chain) - 4096, 4096):
            at = np.arange(i, i + 4096)
            trainer.step(chain[at], chain[at - 1], chain[at - 2])
    m = trainer.m
    scores = m.target @ (m.context[3] * m.position[0] + m.context[4] * m.position[1]) + m.bias
    p = np.exp(scores - scores.max())
    assert p[4] / p.sum() > 0.8


def test_better_than_unigrams_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = nbsvm.held_out(F.col("doc_id"), 5, 1)
    row = lbl.lm_scores(docs, "doc_id", "text", ~held).where("NOT training").agg(F.sum("base_score"), F.sum("score")).first()
    assert row[1] > row[0]


def test_no_training_texts_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "id long, text string")
    got = {r.id: r for r in lbl.lm_scores(df, "id", "text", F.lit(False)).collect()}
    assert got[1].base_score == 0 and got[2].n_tokens == 1 and got[1].n_known == 0 and got[1].train_tokens == 0
    assert lbl.lm_scores(df.where("false"), "id", "text", F.lit(True)).collect() == []


def test_class_probabilities_are_normalised(spark):
    """Members of all classes add up to 1, with the normaliser from the table or not."""
    random = np.random.default_rng(2)
    counts = random.integers(1, 50, 60)
    model = lbl.Model.start(counts, 8, np.array([0, 1, 2, 3, 6, 11, 18, 60]))
    tables = lbl.score_tables(spark, model, 10)
    for one, two in [(1, 1), (9, 50), (59, 40)]:
        p = np.exp(tables.logs(np.arange(60), np.full(60, one), np.full(60, two)).astype(float))
        assert p.sum() == pytest.approx(1, abs=1e-4) and p[lbl.START] < 1e-6


def test_vocabulary_grows_and_rare_words_are_learned(spark):
    """400 words outside a shortlist of 5, always in the same order: which one follows must be learned."""
    def vocabulary(n):
        head = lbl.pd.DataFrame({"a": np.arange(n) * 7919})
        return lbl.make_vocabulary(head, n, 5)

    small, large = vocabulary(10_000), vocabulary(1_000_000)
    assert len(large.keys) == 10 * len(small.keys) and large.classes > 5 * small.classes
    random = np.random.default_rng(0)
    texts = []
    for i in range(1500):
        at = int(random.integers(0, 400))
        texts.append((i, " ".join(f"w{(at + k) % 400}" for k in range(60))))
    df = spark.createDataFrame(texts, "id int, text string").coalesce(1)
    held = F.col("id") % 5 == 0
    base, score = lbl.lm_scores(df, "id", "text", ~held, shortlist=5).where("NOT training").agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base * 0.97


def test_products_of_a_normaliser_grow_slower_than_members():
    """Classes of hashed words hold as many members as there are classes: at 2.4 million words some 700 products at most, not 1,800."""
    own, hashed = 24_800, 1_542
    begins = lbl.Vocabulary(np.arange(own), np.arange(own) + 2, hashed).begins()
    assert begins[0] == 0 and begins[-1] == own + 2 + hashed * lbl.BUCKETS and (np.diff(begins) > 0).all()
    assert len(begins) - 1 + np.diff(begins).max() < 800


def test_tokens_of_a_class_share_noise_members():
    """4,096 tokens of one class of 5,000 members: a block's noise is drawn once, and every gradient is that of its tokens."""
    counts = np.ones(5_002, np.int64)
    trainer = lbl.Trainer(lbl.Model.start(counts, 8, np.array([0, 1, 2, 5_002])), counts, 0)
    token = np.random.default_rng(5).integers(2, 5_002, 4_096)
    trainer.step(token, np.full(4_096, 1), np.full(4_096, 1))
    drawn = int((trainer.used[1] > 0).sum()) - len(np.unique(token))
    assert 0 < drawn <= 4_096 // lbl.BLOCK * lbl.INSIDE
    assert trainer.used[1].sum() == 4_096 * (1 + lbl.INSIDE)  # each token counts for its own member and its noise
    begin, length = trainer._blocks(np.array([1, 1, 2, *[3] * (lbl.BLOCK + 1)]))
    assert begin.tolist() == [0, 2, 3, 3 + lbl.BLOCK] and length.tolist() == [2, 1, lbl.BLOCK, 1]


def test_a_class_that_is_never_predicted_costs_no_second_pass(monkeypatch):
    """A bias of -30 cannot overflow; scores that would, or that would all vanish, are still exact."""
    random = np.random.default_rng(1)
    vectors, q = random.standard_normal((50, 8)).astype(np.float32), random.standard_normal((20, 8)).astype(np.float32)
    for shift in (0.0, 200.0, -200.0):
        bias = np.full(50, shift, np.float32)
        bias[0] = shift - 30
        plain = np.logaddexp.reduce(q.astype(float) @ vectors.T.astype(float) + bias, axis=1)
        assert lbl.Normaliser(vectors, bias).logs(lbl._with_one(q)) == pytest.approx(plain, rel=1e-5)
    small = 10 * vectors, np.array([-30.0, *[0.0] * 49], np.float32)
    want = lbl.Normaliser(*small).logs(lbl._with_one(q / 4))
    monkeypatch.setattr(lbl, "_log_sums", None)
    assert np.allclose(lbl.Normaliser(*small).logs(lbl._with_one(q / 4)), want)
    longest = float(np.sqrt((small[0] ** 2).sum(1)).max() * np.sqrt((q ** 2).sum(1)).max() / 4)
    assert 30 < longest < lbl.Normaliser.LARGEST


def test_counts_of_words_whose_first_halves_agree():
    entries = np.array([(5, 2, 1), (5, 1, 1), (3, 9, 4), (5, 2, 2)], lbl.ENTRY)
    assert lbl._summed(entries).tolist() == [(3, 9, 4), (5, 1, 1), (5, 2, 3)]


def test_keys_of_words_hashed_byte_by_byte():
    """Words up to, at and beyond `SHORT` bytes, and texts without any."""
    pa, find = lbl.pa, lbl.find_words
    around = " ".join("É" + "Xy" * n for n in range(20)) + " " + " ".join("z" * n for n in range(1, 2 * lbl.SHORT))
    for texts in (["", None], [], ["A b", None, "w" * 100_000 + " end"], [around, "", around.upper()], ["q" * 70_000]):
        for _, _, data, bounds in lbl.text_chunks(pa.array(texts, pa.string())):
            w = find(data, bounds)
            want = [lbl.span_hashes(lbl._LOWERED[data], w.starts, w.ends, which).view(np.int64) for which in (0, 1)]
            assert all(np.array_equal(a, b) for a, b in zip(lbl.word_keys(w), want))
            assert np.array_equal(lbl.word_keys(w, 1)[0], want[0])


def test_sums_of_segments_by_layers():
    random = np.random.default_rng(3)
    for width in (4, 5):
        at = np.concatenate([random.integers(0, 90_000, 500), np.repeat([7, 70_000, 8], [lbl.LAYERS, lbl.LAYERS + 1, 300])])
        random.shuffle(at)
        rows, where = random.standard_normal((len(at) + 9, width)).astype(np.float32), random.permutation(len(at) + 9)[: len(at)]
        found = lbl.Segments(at)
        assert np.array_equal(found.places[found.of], at) and np.array_equal(np.bincount(found.of), found.times) and (np.diff(found.times) <= 0).all()
        for given, mine in ((None, rows[: len(at)]), (where, rows[where])):
            want = np.zeros((90_000, width))
            np.add.at(want, at, mine)
            assert np.allclose(found.sums(rows, given), want[found.places], atol=1e-4)


def test_a_step_moves_every_row_by_the_sum_of_its_tokens():
    """Against a loop over tokens: whatever tokens, positions and noise share a row, it moves once."""
    random, width = np.random.default_rng(6), 8
    counts, begins = random.integers(1, 50, 40), np.array([0, 1, 2, 3, 6, 20, 40])
    model, twin = (lbl.Model.start(counts, width, begins) for _ in range(2))
    trainer = lbl.Trainer(model, counts, 4)
    n = 300
    token, one, two = random.integers(1, 40, n), random.integers(0, 12, n), random.integers(0, 40, n)
    class_of = np.repeat(np.arange(6), np.diff(begins))
    order = np.argsort(class_of[token], kind="stable")
    token, one, two = token[order], one[order], two[order]
    draws = np.random.default_rng(4)
    noise = draws.choice(6, lbl.NOISE, p=trainer.share)  # 64 of six classes
    begin, length = trainer._blocks(class_of[token])
    sizes = np.diff(begins)[class_of[token[begin]]]
    drawn = (draws.random((len(begin), lbl.INSIDE), dtype=np.float32) * sizes[:, None].astype(np.float32)).astype(int) + begins[class_of[token[begin]]][:, None]
    trainer.step(token, one, two)

    sigma = lambda x: 1 / (1 + np.exp(-x))
    context, member, target = np.zeros((40, width)), np.zeros((40, width)), np.zeros((6, width))
    bias, member_bias, position = np.zeros(6), np.zeros(40), np.zeros((2, width))
    for block, (first, many) in enumerate(zip(begin, length)):
        for i in range(first, first + many):
            c, a, b = class_of[token[i]], twin.context[one[i]], twin.context[two[i]]
            q = a * twin.position[0] + b * twin.position[1]
            pulls = [(c, sigma(-(q @ twin.target[c] + twin.bias[c] - trainer.log_noise[c])))]
            pulls += [(j, -sigma(q @ twin.target[j] + twin.bias[j] - trainer.log_noise[j])) for j in noise]
            back = np.zeros(width)
            for j, pull in pulls:
                back, bias[j] = back + pull * twin.target[j], bias[j] + pull
                target[j] += pull * q
            if sizes[block] > 1:
                inside = lambda k: q @ twin.member[k] + twin.member_bias[k] - trainer.log_inside[c]  # noqa: B023, E731
                for k, pull in [(token[i], sigma(-inside(token[i]))), *((k, -sigma(inside(k))) for k in drawn[block])]:
                    back, member_bias[k] = back + pull * twin.member[k], member_bias[k] + pull
                    member[k] += pull * q
            context[one[i]] += back * twin.position[0]
            context[two[i]] += back * twin.position[1]
            position += np.stack([back * a, back * b])
    rows = lambda g: lbl.RATE * g / np.sqrt(1 + g * g)
    each = lambda g: lbl.RATE * g / n / np.sqrt(1e-6 + (g / n) ** 2)
    for name, step in (("context", rows(context)), ("member", rows(member)), ("target", each(target)), ("bias", each(bias)), ("position", each(position))):
        assert np.allclose(getattr(model, name) - getattr(twin, name), step, atol=2e-4), name
    assert np.allclose(model.member_bias - twin.member_bias, lbl.RATE * member_bias / np.sqrt(1 + member_bias**2), atol=2e-4)
    assert np.array_equal(trainer.used[0], np.bincount(np.concatenate([one, two]), minlength=40))


def test_scores_are_those_of_the_model(spark):
    """In any order of tokens, for classes of one and of many, with pairs of contexts in the table or not."""
    random = np.random.default_rng(8)
    begins = np.array([0, 1, 2, 3, 30, 60])
    model = lbl.Model.start(random.integers(1, 50, 60), 8, begins)
    for scale in (1, 40):  # scores beyond an exponential of 32 bits
        model.target *= scale
        model.member *= scale
        tables = lbl.score_tables(spark, model, 10)
        token, one, two = random.integers(1, 60, 2_000), random.integers(0, 60, 2_000), random.integers(0, 20, 2_000)
        got = tables.logs(token, one, two)
        for i in range(0, 2_000, 7):
            c = np.searchsorted(begins, token[i], side="right") - 1
            q = (model.context[one[i]] * model.position[0] + model.context[two[i]] * model.position[1]).astype(float)
            classes, members = model.target @ q + model.bias, model.member[begins[c]:begins[c + 1]] @ q + model.member_bias[begins[c]:begins[c + 1]]
            want = classes[c] - np.logaddexp.reduce(classes) + members[token[i] - begins[c]] - np.logaddexp.reduce(members)
            assert got[i] == pytest.approx(want, abs=2e-3)
    assert tables.logs(*np.empty((3, 0), np.int64)).tolist() == []
