import math
import random
from fractions import Fraction

import numpy as np
import pytest

from sedimenta.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, x int, n long, component string"


def reference(rows, k=4):
    """(n, covariance as Fractions of whole numbers, S, usable rows) by plain Python, and eigh of the covariance."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 0
    good = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in good if len(v) == d]
    points = sorted({x for _, x in good})
    n = len(points)
    total = [sum(x[j] for x in points) for j in range(d)]
    cov = [[Fraction(sum((n * x[a] - total[a]) * (n * x[b] - total[b]) for x in points), n**3) for b in range(d)] for a in range(d)]
    return n, total, cov, good, points


def check(spark, rows, k=4):
    n, total, cov, good, points = reference(rows)
    df = spark.createDataFrame([(i, v, 1, 2, 3, "c") for i, v in rows], SCHEMA).repartition(5)
    got = wh.whiten(df, components=k).collect()
    v = np.array([[float(c) for c in r] for r in cov]).reshape(len(total), len(total))
    values, directions = np.linalg.eigh(v) if len(v) else (np.zeros(0), np.zeros((0, 0)))
    values, directions = values[::-1], directions[:, ::-1]
    rank = int((values > 1e-9 * max(values.max(initial=0), 1e-300)).sum())
    use = min(rank, k)
    assert len(got) == len(good) * use
    by = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-6
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        by.setdefault(r.component, {}).setdefault(r.vec_id, set()).add((r.deviation, r.whitened))
    gaps = [min((abs(values[c] - values[o]) for o in range(len(values)) if o != c), default=1) for c in range(use)]
    for c in range(use):
        direction = directions[:, c]
        want = {}
        for i, x in good:
            away = [n * a - s for a, s in zip(x, total)]
            want.setdefault(i, set()).add((sum(a * a for a in away), float(np.dot(away, direction)) / n / math.sqrt(values[c])))
        assert by[c + 1].keys() == want.keys()
        if gaps[c] < 1e-6 * values[0]:
            continue  # any turn of such components is right
        most = max(((i, p) for i, ps in want.items() for p in ps if len(ps) == 1), key=lambda ip: abs(ip[1][1]), default=None)
        sign = 1.0 if most is None else math.copysign(1, most[1][1] * next(iter(by[c + 1][most[0]]))[1])
        for i, pairs in want.items():
            mine = sorted((d, sign * w) for d, w in by[c + 1][i])
            assert len(mine) == len(pairs)
            for (d1, w1), (d2, w2) in zip(mine, sorted(pairs)):
                assert d1 == d2 and w1 == pytest.approx(w2, abs=1e-7)


def vectors(rng, n, d, rank=None):
    basis = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(rank or d)]
    return [[sum(rng.gauss(0, 1 + 2 * j) * b[a] for j, b in enumerate(basis)) for a in range(d)] for _ in range(n)]


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = list(enumerate(vectors(rng, 60, 6)))
    rows += [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (103, [float("nan")] * 6), (104, [float("inf")] + [0.0] * 5), (105, [1.0, 2.0])]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, rows[5][1])]  # null ids, repeated rows, other vectors under a used id
    rows += [(200 + i, rows[7][1]) for i in range(50)]  # a hot vector counts once
    check(spark, rows)


def test_ranks_below_the_dimension(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randrange(9)), 3.0, 0.0, -2.5]) for i in range(30)]
    check(spark, rows)  # one component
    check(spark, [(i, [float(a), 2.0 * a, float(b), float(a + b)]) for i, (a, b) in enumerate((rng.randrange(50), rng.randrange(50)) for _ in range(40))])
    check(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])  # one distinct vector: no component
    check(spark, [(1, []), (2, [])])
    check(spark, [])


def test_values_of_many_sizes(spark):
    rng = random.Random(8)
    rows = [(i, [float(rng.randrange(-64, 64)), rng.random(), rng.random() * 1e-2, 2.0 ** rng.randrange(6)]) for i in range(50)]
    check(spark, rows, k=3)


def test_huge_values_do_not_crash(spark):
    df = spark.createDataFrame([(i, [1e38 * (-1) ** i, float(i)], 1, 2, 3, "") for i in range(5)], SCHEMA)
    rows = wh.whiten(df).collect()
    assert len(rows) in (5, 10) and all(r.deviation is None for r in rows)


def test_sums_are_exact():
    rng = np.random.default_rng(1)
    for top in (3, 1 << 20, 1 << 40, 1 << 62):
        x = rng.integers(-top, top, (50, 3))
        total = wh.products(x)
        own = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for j in range(3)] for i in range(3)]
        assert total.tolist() == own
        back = sum(p.astype(object) << (wh.LIMB_BITS * k) for k, p in enumerate(wh.limbs(total.ravel())))
        assert back.tolist() == total.ravel().tolist()


def test_jacobi_on_graded_matrices():
    """Eigenvalues over twelve orders of magnitude, each to full relative precision."""
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(7, 7)))
    whole = np.array([[int(v) for v in row] for row in np.round(q * 2.0**10 @ np.diag(4.0 ** -np.arange(7)) * 2.0**30).tolist()], object)
    scatter = whole.dot(whole.T)
    values, directions = wh.one_sided_jacobi(wh.pivoted_cholesky(scatter))
    own = np.linalg.svd(whole.astype(np.float64), compute_uv=False) ** 2
    assert np.allclose(np.float64(values), own, rtol=1e-9)
    assert np.allclose(np.float64(directions.T @ directions), np.eye(7), atol=1e-14)


def test_query(spark):
    from sedimenta.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    n, total, cov, good, _ = reference([(r.vec_id, r.embedding) for r in rows])
    v = np.array([[float(c) for c in r] for r in cov])
    values, directions = np.linalg.eigh(v)
    got = QUERIES["op12_whitening"](spark, sf).collect()
    assert len(got) == 4 * len(good)
    own = {(r.vec_id, r.component): r for r in got}
    for c in range(1, 5):
        white = np.array([float(np.dot([n * a - s for a, s in zip(x, total)], directions[:, -c])) / n / math.sqrt(values[-c]) for _, x in good])
        mine = np.array([own[i, c].whitened for i, _ in good])
        assert min(np.abs(mine - white).max(), np.abs(mine + white).max()) < 1e-8
    assert got[0].identity_error < 1e-9
    assert {(r.vec_id, r.deviation) for r in got} == {(i, sum((n * a - s) ** 2 for a, s in zip(x, total))) for i, x in good}
