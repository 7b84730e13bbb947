import math

import numpy as np
import pytest

from gridpanel.llm import whiten as W

SCHEMA = "vec_id long, embedding array<float>, x string, n string, v string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], SCHEMA)


def brute(rows):
    """Kept (id, x) rows, and n, sums, eigenvalues, eigenvectors and trace of the distinct x-vectors."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in kept), default=0)
    kept = [(i, tuple(x + [1_000_000] * (width - len(x)))) for i, x in kept]
    fit = np.array(sorted(set(x for _, x in kept)))
    n, s = len(fit), fit.sum(0)
    centred = (n * fit - s) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, s, values[::-1], vectors[:, ::-1], float(values.sum())


def check(spark, rows, components):
    got = W.whiten_digest(frame(spark, rows).repartition(3)).collect()
    kept, n, s, values, vectors, trace = brute(rows)
    assert len(got) == len(kept) * components
    per = {}
    for r in got:
        per.setdefault((r["vec_id"], r["deviation_exact"]), {}).setdefault(r["component"], []).append(r)
    signs = {}
    for i, x in kept:
        y = [n * a - int(b) for a, b in zip(x, s)]
        mine = per[i, sum(v * v for v in y)]
        assert sorted(mine) == list(range(1, components + 1))
        for c, found in mine.items():
            want = np.array(y) / n @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            for r in found:
                if abs(want) > 1e-6:
                    signs.setdefault(c, np.sign(want * r["whitened"]))
                assert abs(r["whitened"] - want * signs.get(c, 1)) < 1e-8 * max(1, abs(want))
                assert r["n"] == n and abs(r["explained"] - values[c - 1] / trace) < 1e-10 and r["identity_error"] < 1e-9
                assert r["deviation"] == (r["deviation_exact"] if r["deviation_exact"] < 1 << 63 else None)


def random_symmetric(rng, n, values):
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    return (q * values) @ q.T


@pytest.mark.parametrize("n", [1, 2, 3, 10, 40])
def test_counts_are_those_of_the_eigenvalues(n):
    rng = np.random.default_rng(n)
    for values in (rng.normal(size=n), np.round(rng.normal(size=n) * 2), 10.0 ** rng.integers(-6, 6, n), np.zeros(n)):
        a = random_symmetric(rng, n, values)
        a = (a + a.T) / 2
        exact = np.linalg.eigvalsh(a)
        for shift in [*(exact[:-1] + exact[1:]) / 2, -1e9, 1e9, 0.37]:
            if np.abs(exact - shift).min() > 1e-9 * max(1, np.abs(exact).max()):
                assert W.count_above(a, shift) == (exact > shift).sum()


def test_leading_pairs():
    rng = np.random.default_rng(0)
    cases = [rng.random(30), np.array([5.0] * 4 + [3.0] * 3 + [1.0] * 10), 10.0 ** -np.arange(12.0), 1 + np.arange(20) * 1e-9, np.zeros(5), np.ones(6),
             np.array([1.0, 1.0 + 1e-13, 0.5]), np.array([2.0])]
    for values in cases:
        n = len(values)
        a = random_symmetric(rng, n, values)
        a = (a + a.T) / 2
        got, vectors = W.leading_pairs(a, 16)
        k = min(n, 16)
        scale = max(np.abs(values).max(), 1e-300)
        assert np.abs(got - np.sort(values)[::-1][:k]).max() < 1e-12 * scale
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
        assert np.abs(a @ vectors - vectors * got).max() < 1e-12 * scale


def test_exact_squares():
    rng = np.random.default_rng(4)
    for top in (10, 1 << 28, 1 << 40, 1 << 60):
        y = rng.integers(-top, top, (50, 9))
        assert [int(d) for d in W.squares(y).to_pylist()] == [sum(int(v) ** 2 for v in row) for row in y]


def test_equals_dense_solution(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate((rng.normal(size=(400, 24)) @ rng.normal(size=(24, 24)) * 0.3 + 5).astype(np.float32))]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [rows[9], rows[9], (None, rows[11][1])]
    check(spark, rows, 16)
    check(spark, [(i, [c * 1e5 for c in v]) for i, v in rows], 16)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 0.5]), (1, [0.0, 0.0, 0.0]), (2, [1.0, 2.0]), (3, []), (4, None), (5, [None, 1.0, 1.0]), (6, [nan, 1.0, 2.0]), (7, [inf, 0.0, 0.0]),
            (8, [-1.0, 0.5, 3.0]), (None, [4.0, 1.0, 3.0]), (9, [2.0, 2.0, 2.0])]
    check(spark, rows, 3)
    check(spark, [(1, [1.0, 5.0]), (2, [3.0, 5.0])], 1)              # one direction with variance
    for none in ([], [(1, None)], [(1, [2.0]), (2, [2.0])], [(1, [])]):
        got = W.whiten_digest(frame(spark, none))
        assert got.count() == 0 and got.columns[:4] == ["vec_id", "component", "n", "deviation"]
    with pytest.raises(ValueError):
        W.whiten(frame(spark, [(1, [1e30]), (2, [1.0])]))
