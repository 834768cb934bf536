import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import rabitq


def plain(rows, k=5, every=50):
    usable = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for i, q in usable:
        if i % every == 0:
            scored = sorted((-float(q @ v / (np.linalg.norm(q) * np.linalg.norm(v))), j) for j, v in usable if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def check(spark, rows, k=5, every=50):
    df = spark.createDataFrame([(i, v, 0.5, 1) for i, v in rows], "vec_id long, embedding array<double>, score double, rank int").repartition(3)
    got = [tuple(r) for r in rabitq.nearest(df, df.where(F.col("vec_id") % every == 0), k=k).orderBy("query_id", "rank").collect()]
    expected = plain(rows, k, every)
    assert [(g[0], g[1]) for g in got] == [(e[0], e[1]) for e in expected]
    for g, e in zip(got, expected):
        assert g[3] == pytest.approx(e[3], abs=1e-12)
        assert g[2] == e[2] or abs(g[3] - e[3]) < 1e-12
    return got


@pytest.mark.parametrize("d, spread", [(64, 1.0), (3, 1.0), (1, 1.0), (128, 0.05)])
def test_same_as_brute_force(spark, d, spread, monkeypatch):
    monkeypatch.setattr(rabitq, "CODE_BLOCK", 150)
    monkeypatch.setattr(rabitq, "QUERY_BLOCK", 7)
    random = np.random.default_rng(d)
    centres = random.standard_normal((4, d))
    x = centres[random.integers(0, 4, 900)] + spread * random.standard_normal((900, d))
    check(spark, [(i, v.tolist()) for i, v in enumerate(x)])


def test_ties_nulls_and_odd_vectors(spark):
    random = np.random.default_rng(9)
    same = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, same) for i in range(200, 230)] + [(i, random.standard_normal(4).tolist()) for i in range(100)]
    rows += [(300, None), (301, [0.0] * 4), (302, [1.0, None, 2.0, 3.0]), (303, [1.0, float("nan"), 0.0, 1.0]), (304, [float("inf"), 1.0, 0.0, 1.0]), (350, [])]
    got = check(spark, rows)
    assert [g[2] for g in got if g[0] == 200] == [201, 202, 203, 204, 205]


def test_few_candidates_and_empty_tables(spark):
    check(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [0.0, -1.0])])
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert rabitq.nearest(df, df).collect() == []
    lone = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    assert rabitq.nearest(lone, lone).collect() == []


def test_bounds_hold():
    random = np.random.default_rng(3)
    d = 64
    x, q = rabitq.unit(random.standard_normal((4000, d))), rabitq.unit(random.standard_normal((20, d)))
    turned = rabitq.rotation(d)
    assert np.allclose(turned @ turned.T, np.eye(d))
    bits, length, correction = rabitq.codes(x, turned)
    found, bound = rabitq.estimates(bits, correction, q @ turned, rabitq.EPSILON)
    error = np.abs(found - q @ x.T)
    assert np.allclose(length, 1) and (error <= bound[None, :]).mean() > 0.9999
    assert abs((found - q @ x.T).mean()) < 0.005  # without bias


def test_vectors_of_several_dimensions(spark):
    """Each query is answered from the vectors of its own dimension, also the rarest."""
    random = np.random.default_rng(12)
    rows = [(i, random.standard_normal(3).tolist()) for i in range(100)] + [(1000 + i, random.standard_normal(2).tolist()) for i in range(50)]
    rows += [(3000, random.standard_normal(7).tolist()), (3001, random.standard_normal(7).tolist()), (4000, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in rabitq.nearest(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    want = [e for d in (3, 2, 7, 1) for e in plain([r for r in rows if len(r[1]) == d])]
    assert [g[:3] for g in got] == [e[:3] for e in sorted(want)] and len(got) == 5 + 5 + 5 + 1
    assert [g[3] for g in got] == pytest.approx([e[3] for e in sorted(want)], abs=1e-12)
