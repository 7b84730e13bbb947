import hashlib
import math

import numpy as np
import pytest

from gridpanel.llm import cluster as C

SCHEMA = "vec_id long, embedding array<float>, cluster int, distance long, n string, v string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", "y", "z") for i, v in rows], SCHEMA)


def brute(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(v) for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))                                     # noqa: E731
    pick = lambda v: min((far(v, c), n) for n, c in enumerate(centroids))                          # noqa: E731
    for _ in range(rounds):
        which = [pick(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            group = [v for (_, v), w in zip(kept, which) if w == n]
            if group:
                centroids[n] = [sum(x) // len(group) for x in zip(*group)]
    final = [(i, *pick(v)) for i, v in kept]
    of = lambda n: sum(d for _, d, w in final if w == n)                                           # noqa: E731
    total = sum(d for _, d, _ in final)
    return [(i, w, d, of(w), total, hashlib.sha256(",".join(map(str, centroids[w])).encode()).hexdigest()) for i, d, w in final]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def check(spark, rows, **how):
    got = C.cluster(frame(spark, rows).repartition(3), **how)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert order(tuple(r) for r in got.collect()) == order(brute(rows, **how))


def make(rng, n, scale=0.2):
    return [(int(i), [float(x) for x in rng.normal(scale=scale, size=64).astype(np.float32)]) for i in rng.permutation(n)]


def test_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for bits in (1, 2, 9, 28):
        low, high = -(1 << bits - 1), (1 << bits - 1) - 1
        a, c = rng.integers(low, high + 1, (50, 64)), rng.integers(low, high + 1, (7, 64))
        a[0], a[1] = low, high
        pa, pc = C.pack(a, bits), C.pack(c, bits)
        assert (C.unpack(pa) == a).all()
        assert (C.dots(pa, pc) == a @ c.T).all()
        assert (C.norms(pa) == (a * a).sum(1)).all()
        which, far = C.nearest(pa, C.norms(pa), pc, C.norms(pc))
        plain = ((a[:, None] - c) ** 2).sum(2)
        assert (which == plain.argmin(1)).all() and (far == plain.min(1)).all()


def test_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = make(rng, 150)
    check(spark, rows)
    check(spark, rows, k=3, rounds=0)
    check(spark, [(i, [x * 300 for x in v]) for i, v in rows[:60]], k=7, rounds=2)


def test_odd_rows_copies_and_ties(spark):
    rng = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    rows = make(rng, 60)
    one = rows[0][1]
    rows += [(i, one) for i in range(100, 150)] + [rows[1], rows[1], (None, rows[2][1]), (None, one), (7, rows[3][1])]
    rows += [(200, None), (201, []), (202, one[:63]), (203, one + [0.0]), (204, [None] + one[1:]), (205, [nan] + one[1:]), (206, [-inf] + one[1:])]
    check(spark, rows)
    check(spark, rows[60:], k=40)                  # mostly equal seeds: the smaller number gets all
    check(spark, [(1, [0.0] * 64), (2, [0.0] * 64)])
    check(spark, rows[-5:])                        # nothing kept
    check(spark, [])


def test_bounds_raise(spark):
    with pytest.raises(ValueError):
        C.cluster(frame(spark, [(1, [1e9] * 64)]))
    with pytest.raises(ValueError):
        C.cluster(frame(spark, []), k=0)
