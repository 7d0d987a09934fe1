import math
from fractions import Fraction

import numpy as np

from tabula.llm import whitening


def brute(rows, k=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, size = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(size)]
    dev = [[n * x[j] - s[j] for j in range(size)] for x in fit]
    cov = np.array([[float(Fraction(sum(d[i] * d[j] for d in dev), n**3)) for j in range(size)] for i in range(size)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for i, x in kept:
        d = [n * x[j] - s[j] for j in range(size)]
        z = (np.array(d) / n) @ vectors / np.sqrt(values)
        out[i] = (n, sum(v * v for v in d), z, values / np.trace(cov))
    return out


def test_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=7) @ np.diag([3, 2, 1.5, 1, 0.5, 0.4, 0.3])]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)]  # a third of the rows is one vector
    rows += [(2000, None), (2001, [None] * 7), (2002, [math.nan] * 7), (2003, [math.inf] + [0.0] * 6), (2004, []), (2005, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got, want = whitening.whiten(df.withColumn("x", df.vec_id).withColumn("i", df.vec_id)).collect(), brute(rows[:450])
    assert len(got) == 4 * 450 and {r.vec_id for r in got} == set(want)
    sign = {}
    for r in got:
        n, deviation, z, explained = want[r.vec_id]
        c = r.component - 1
        sign.setdefault(c, np.sign(r.whitened * z[c]))
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened * sign[c] - z[c]) < 1e-6 and abs(r.explained - explained[c]) < 1e-9
        assert r.identity_error < 1e-9


def test_sums_are_exact_beyond_64_bits():
    rng = np.random.default_rng(1)
    for bits in (10, 30, 44, 47, 55):
        d = rng.integers(-(1 << bits), 1 << bits, (500, 3))
        assert list(whitening.square_sums(d)) == [sum(int(v) ** 2 for v in d[:, j]) for j in range(3)]
    big = np.array([[1 << 40, -(1 << 40)]])
    assert whitening.centred(big, 1 << 30, [5, 5]).tolist() == [[(1 << 70) - 5, -(1 << 70) - 5]]


def test_awkward_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0])], schema)).collect()
    assert len(one) == 6 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.identity_error is None for r in one)
    flat = whitening.whiten(spark.createDataFrame([(1, [0.0, 1.0]), (2, [2.0, 1.0]), (3, [2.0, 1.0])], schema)).collect()
    assert {(r.vec_id, r.component, r.whitened is None) for r in flat} == {(i, c, c == 2) for i in (1, 2, 3) for c in (1, 2)}
    assert all(r.identity_error < 1e-12 for r in flat)
