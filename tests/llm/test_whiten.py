import math
import random

import numpy as np
import pytest

from lakeweave.llm import whiten

CLASHING = "x long, n int, component int, i string, q int, `a b` int"


@pytest.fixture
def vectors(spark):
    def make(rows, kind="float"):
        return spark.createDataFrame([(i, v, 1, 1, 1, "x", 1, 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, {CLASHING}")

    return make


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, top=16):
    """Rows and components by a dense eigensolver, everything else in integers."""
    rows = [(i, v) for i, v in rows if usable(v)]
    dim = max((len(v) for _, v in rows), default=0)
    scaled = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (dim - len(v))) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in scaled}), dtype=np.int64).reshape(-1, dim)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    covariance = centred.T @ centred / max(n, 1)
    values, columns = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(-values)[:top] if values[k] > 1e-9 * max(values.max(), 1e-300)]
    out = {}
    for i, x in scaled:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for number, k in enumerate(order, 1):
            score = (np.array(x) - fit.mean(axis=0)) @ columns[:, k] / math.sqrt(values[k])
            out.setdefault((i, number), []).append((n, deviation, score, values[k] / np.trace(covariance)))
    return out


def compare(df, rows, signs=True):
    want, got = brute(rows), {}
    for r in df.collect():
        got.setdefault((r.vec_id, r.component), []).append(r)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items()}
    flips = {}
    for key, found in got.items():
        expected = sorted(want[key], key=lambda w: abs(w[2]))
        for r, w in zip(sorted(found, key=lambda r: abs(r.whitened)), expected, strict=True):
            assert (r.n, r.deviation) == w[:2] and r.explained == pytest.approx(w[3], rel=1e-6) and 0 <= r.identity_error <= 1e-4
            if signs:
                assert abs(r.whitened) == pytest.approx(abs(w[2]), abs=1e-6)
                if abs(w[2]) > 1e-3:
                    flips.setdefault(r.component, set()).add(r.whitened * w[2] > 0)
    assert all(len(f) == 1 for f in flips.values())  # one sign for all rows


def made_up(seed, n, dim):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1.5 - k / dim) for k in range(dim)]) for i in range(n)]


def symmetric(rng, dim, values):
    q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    m = (q * np.array(values)) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("dim", [1, 2, 5, 40])
def test_inertia_counts_eigenvalues(dim):
    rng = np.random.default_rng(dim)
    for _ in range(20):
        m = rng.standard_normal((dim, dim))
        m = m + m.T
        values = np.linalg.eigvalsh(m)
        for shift in [*rng.standard_normal(5) * 3, *(values[:-1] + values[1:]) / 2]:
            assert whiten.inertia(m, shift) == (values > shift).sum()
    assert whiten.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # no usable pivot on the diagonal


@pytest.mark.parametrize(
    "values",
    [
        list(range(40, 0, -1)), [5] * 3 + [1] * 20, [7.0] * 20, [1] + [0] * 10, [1e6, 1e6 * (1 + 1e-9), 1e-3, 1e-3, 0.0], [2.0**-k for k in range(30)],
        [3 + 1e-13 * k for k in range(10)],
    ],
)
def test_leading_pairs(values):
    m = symmetric(np.random.default_rng(3), len(values), values)
    pairs = whiten.leading_pairs(m, 16)
    exact, scale = np.sort(np.linalg.eigvalsh(m))[::-1], max(values)
    assert len(pairs) == min(16, sum(v > 1e-12 * scale for v in values))
    vectors = np.array([p.vector for p in pairs])
    assert np.abs(vectors @ vectors.T - np.eye(len(pairs))).max() < 1e-12
    for number, p in enumerate(pairs, 1):
        assert p.first <= number <= p.last
        assert abs(p.value - exact[number - 1]) < 1e-13 * scale
        assert np.linalg.norm(m @ p.vector - p.value * p.vector) < 1e-13 * scale


def test_no_pairs_of_nothing():
    assert whiten.leading_pairs(np.zeros((3, 3)), 16) == [] and whiten.leading_pairs(np.zeros((0, 0)), 16) == []


@pytest.mark.parametrize("n,dim", [(400, 24), (30, 5), (10, 24), (2, 3)])
def test_whitening_equals_brute_force(vectors, n, dim):
    rows = made_up(n, n, dim)
    rows += [(1000 + i, v) for i, v in rows[:: max(1, n // 50)]] + [rows[0]] * 3  # copies and a repeated row
    compare(whiten.whiten(vectors(rows)), rows)


def test_equal_eigenvalues(vectors):
    """Eight corners around the origin: any orthonormal basis will do, but the whitened covariance is the identity."""
    rows = [(i, [float(1 - 2 * (i >> k & 1)) for k in range(3)]) for i in range(8)]
    df = whiten.whiten(vectors(rows))
    compare(df, rows, signs=False)
    w = np.zeros((8, 3))
    for r in df.collect():
        w[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(w.T @ w / 8 - np.eye(3)).max() < 1e-12


def test_a_hot_vector_counts_once(vectors):
    rows = made_up(2, 40, 4) + [(5000 + i, [0.5, 0.25, -1.0, 0.0]) for i in range(500)]
    compare(whiten.whiten(vectors(rows)), rows)


def test_odd_vectors_and_empty_tables(vectors):
    odd = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("-inf"), 1.0]), (None, [2.0, -0.0, 1.0]), (None, None), (7, [2.0, 0.5]), (7, [2.0, 0.5]),
        (8, [1e-30, -1e-30]),
    ]
    compare(whiten.whiten(vectors(odd)), odd)
    assert whiten.whiten(vectors([])).count() == 0
    assert whiten.whiten(vectors([(1, None)])).count() == 0
    assert whiten.whiten(vectors([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no spread
    assert whiten.whiten(vectors([(1, []), (2, [])])).count() == 0


def test_values_beyond_long(vectors):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1e12, 2.0]), (4, [5.0, 3.0])]
    got = whiten.whiten(vectors(rows)).collect()
    assert {r.deviation for r in got} == {None} and all(math.isfinite(r.whitened) for r in got)


def test_exact_sums_beyond_doubles():
    x = np.array([[2**40, 3], [-(2**45), 5]], dtype=np.int64)
    y = x.astype(object) - np.array([7, 1], dtype=object)
    assert (whiten.exact_gram(x, np.array([7, 1], dtype=object)) == y.T @ y).all()
    assert whiten.deviations(np.array([[2**33, 0]]), 3, [5, 9]) == [None]
    assert whiten.deviations(np.array([[2**30, 0]]), 2, [5, 9]) == [(2 * 2**30 - 5) ** 2 + 81]
