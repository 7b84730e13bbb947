import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpanel.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score long, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)


def brute(rows, step, k):
    """Over rows in order; a row's own place is left out."""
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v in usable]
    out = []
    for a, (i, _) in enumerate(usable):
        if i % step == 0:
            scores = [(-sum(x * y for x, y in zip(ints[a], ints[b])), j) for b, (j, _) in enumerate(usable) if b != a]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def got(spark, rows, step, k=5):
    return sorted(tuple(r) for r in topk.top_k(frame(spark, rows).repartition(3), F.col("vec_id") % step == 0, k).collect())


def spread_out(rng, n, dim):
    """Lengths over several orders of magnitude, some directions close together, some vectors equal."""
    centre = rng.normal(size=(8, dim))
    v = centre[rng.integers(0, 8, n)] + rng.normal(scale=rng.choice([0.05, 0.5, 2], (n, 1)), size=(n, dim))
    v *= np.exp(rng.normal(scale=1.2, size=(n, 1))) / 10
    v[n // 2:n // 2 + 20] = v[0]
    return [(i, [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize("bucket,coord", [(1024, 0.4), (32, 0.4), (32, 0.0), (32, 2.0)])
def test_equals_brute_force(spark, monkeypatch, bucket, coord):
    monkeypatch.setattr(topk, "BUCKET", bucket)
    monkeypatch.setattr(topk, "COORD_FROM", coord)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 150)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    rows = spread_out(np.random.default_rng(4), 400, 12)
    assert got(spark, rows, 10) == brute(rows, 10, 5)


def test_search_in_one_task():
    rng = np.random.default_rng(8)
    for scale in (1, 1000, 10**7):
        v = (rng.normal(size=(300, 6)) * scale * np.exp(rng.normal(size=(300, 1)))).astype(np.int64)
        v[7] = 0
        ids = rng.permutation(300)
        best = topk.search(v[:40], np.arange(40), v, ids, np.arange(300), 5)
        for q in range(40):
            exact = sorted((-int(sum(int(a) * int(b) for a, b in zip(v[q], v[c]))), int(ids[c]), c) for c in range(300) if c != q)[:5]
            assert best.lists[q] == exact


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.0, 0.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [-1.0, 0.5, 3.0]),
            (None, [9.0, 9.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (100, None), (150, [nan, nan])]
    assert got(spark, rows, 50) == brute(rows, 50, 5)
    assert got(spark, rows, 50, k=2) == brute(rows, 50, 2)
    assert got(spark, [(0, [1.0])], 50) == []
    assert got(spark, [(1, [1.0])], 50) == []
    assert got(spark, [], 50) == []


def test_scores_beyond_long_are_an_error(spark):
    with pytest.raises(ValueError):
        got(spark, [(0, [3e38, 1.0]), (1, [3e38, 1.0]), (2, [-3e38, 0.0])], 50)
    big = float(2**22)                                    # 2^30 after scaling: products of 2^60 are exact
    rows = [(0, [big, 1.0]), (1, [big, 1.5]), (2, [-big, 0.0])]
    assert got(spark, rows, 50) == brute(rows, 50, 5)


def test_chunks_that_cannot_matter_are_not_searched(spark, monkeypatch):
    """Lengths over orders of magnitude: most (block, chunk) pairs are pruned before their shuffle, and nothing is lost."""
    seen = []
    inner = topk.later_chunks

    def counted(queries, top, chunked, k):
        asked = topk.materialise(inner(queries, top, chunked, k), "counted")
        seen.append((asked.select("block", "chunk").distinct().count(), asked.count(), queries.count() * chunked.select("chunk").distinct().count()))
        return asked
    monkeypatch.setattr(topk, "later_chunks", counted)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    rng = np.random.default_rng(5)
    v = np.abs(rng.normal(size=(600, 8))) * (10.0 ** rng.uniform(-2, 2, 600))[:, None]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v.astype(np.float32))]
    assert got(spark, rows, 10) == brute(rows, 10, 5)
    pairs, asked, everything = seen[0]
    assert asked < everything / 4 and pairs < 6 * 9 / 2


def test_exact_products_beyond_doubles():
    a = np.array([[2**40 + 1, 3]])
    assert topk.exact_products(a, np.array([[2**20 + 1, -7]]))[0, 0] == (2**40 + 1) * (2**20 + 1) - 21
