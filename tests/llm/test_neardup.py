import random

import numpy as np
import pytest

from gridpanel.llm import neardup


def shingles(text, k):
    w = [x.lower() for x in (text or "").encode().split()]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    """{row: (n, smallest id reachable)}, all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d is not None, d or 0, len(sets[i]), least.get(find(i)) if least.get(find(i)) is not None else -1) for i, (d, _) in enumerate(rows))


def run(frame, k, percent=80):
    got = neardup.near_duplicates(frame, k, percent).collect()
    return sorted((r["id"] is not None, r["id"] or 0, r["n"], -1 if r["comp"] is None else r["comp"]) for r in got)


def edited(rng, base, words, share):
    w = list(base)
    for _ in range(int(len(w) * share)):
        w[rng.randrange(len(w))] = rng.choice(words)
    return " ".join(w)


@pytest.mark.parametrize("k", [4, 5])
def test_groups_equal_brute_force(docs, words, odd_texts, k):
    rng = random.Random(k)
    texts = list(odd_texts)
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 9, 30, 120]))]
        texts += [edited(rng, base, words, rng.choice([0, 0.01, 0.03, 0.06, 0.1])) for _ in range(rng.randint(1, 6))]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(30)) for _ in range(60)]       # alike, below the threshold
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[20]), (None, "alone without id")]
    rows += [rows[30], rows[31]]
    assert run(docs(rows).repartition(3), k) == brute(rows, k)


def test_dense_group_with_chains(docs, words):
    """Hundreds of near copies of one text, many linked only through lighter edits, beyond regions and blocks."""
    rng = random.Random(9)
    base = [rng.choice(words) for _ in range(150)]
    texts = [edited(rng, base, words, rng.uniform(0, 0.09)) for _ in range(420)] + [" ".join(base)] * 50
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert run(docs(rows).repartition(4), 4) == brute(rows, 4)


def test_case_and_white_space(docs):
    rows = [(3, "One  TWO\tthree four\x0bfive"), (1, "one two three four five"), (2, "Öne two three four five"), (4, "öne two three four five"),
            (5, "one two three four five")]
    assert run(docs(rows), 4) == brute(rows, 4)
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in neardup.near_duplicate_digest(docs(rows)).collect()}
    assert got[3] == (1, False) and got[1] == (1, True) and got[2][0] == 2 and got[4][0] == 4


def test_empty_table(docs):
    assert neardup.near_duplicate_digest(docs([])).count() == 0
    assert neardup.near_duplicate_digest(docs([(1, None), (2, ""), (2, None)])).filter("kept and n_shingles = 0").count() == 3


def test_keep_one(docs, words):
    base = " ".join(words[:80])
    near = " ".join([*words[:79], "other"])
    rows = [(5, base), (2, near), (9, base), (4, "something else here at all"), (4, "something else here at all"), (6, None), (7, ""),
            (None, "x y z"), (None, "x y z")]
    kept = neardup.keep_one(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted(
        [(2, near), (4, "something else here at all"), (6, ""), (7, ""), (0, "x y z")])


def test_rows_of_one_id_are_judged_by_their_own_texts(docs, words):
    """An id with several texts: each goes or stays with its own group, and groups do not merge through the id."""
    a, b = " ".join(words[:80]), " ".join(words[100:180])
    near_a = " ".join([*words[:79], "other"])
    ids = lambda rows: sorted((r["doc_id"], r["text"]) for r in neardup.keep_one(docs(rows)).collect())           # noqa: E731
    assert ids([(5, a), (7, a), (5, b), (3, b)]) == [(3, b), (5, a)]
    assert ids([(5, a), (7, a), (5, b), (9, b)]) == sorted([(5, a), (5, b)])
    assert ids([(5, a), (5, b), (9, b), (2, near_a)]) == sorted([(2, near_a), (5, b)])
    assert len(ids([(5, a), (5, near_a), (5, a.upper())])) == 1
    rows = [(5, a), (5, b), (9, b), (2, near_a), (9, a)]
    assert run(docs(rows), 5) == brute(rows, 5)
    got = {(r["id"], r["comp"]) for r in neardup.near_duplicates(docs(rows)).collect()}
    assert got == {(5, 2), (5, 5), (9, 5), (2, 2), (9, 2)}


def template_texts(rng, words, n, share=0.56, length=60):
    """Texts that share the same passage and nothing else: similarity about 0.55, no links."""
    shared = [rng.choice(words) for _ in range(int(length * share * 4 / 3))]
    return [" ".join(shared + [rng.choice(words) for _ in range(length - len(shared))]) for _ in range(n)]


def test_template_group_without_links_stays_in_proportion(spark, docs, words, monkeypatch):
    """Classes that share a template only are one candidate group; their pairs must not grow with its square."""
    rng = random.Random(12)
    pairs = []
    inner = neardup.prefix_pairs

    def counted(placed, percent):
        out = neardup.materialise(inner(placed, percent), "counted")
        pairs.append((placed.select("rep").distinct().count(), out.count()))
        return out
    monkeypatch.setattr(neardup, "prefix_pairs", counted)
    texts = template_texts(rng, words, 1200)
    planted = [" ".join(t.split()[:-1] + ["planted"]) for t in texts[:40]]
    for n in (600, 1200):
        part = texts[:n] + planted
        got = {r["id"]: r["comp"] for r in neardup.near_duplicates(docs(list(enumerate(part))).repartition(4), 4).collect()}
        assert all(got[n + i] == i for i in range(40)) and sum(i != c for i, c in got.items()) == 40
    (m1, p1), (m2, p2) = pairs
    assert m1 > 300 and m2 > 800                        # the groups did go this way
    assert p2 < 3 * p1 + 200 and p2 < 3 * m2            # all pairs of the larger one would be 700,000


@pytest.mark.parametrize("light", [0, 10**9])
def test_both_ways_of_settling_equal_brute_force(docs, words, monkeypatch, light):
    """A dense group with unsettled classes, all of it by blocks, and all of it by prefixes."""
    monkeypatch.setattr(neardup, "LIGHT", light)
    rng = random.Random(13)
    base = [rng.choice(words) for _ in range(60)]
    texts = [edited(rng, base, words, rng.uniform(0, 0.12)) for _ in range(260)]
    rows = list(enumerate(texts))
    assert run(docs(rows).repartition(4), 4) == brute(rows, 4)


def test_prefixes_share_a_shingle():
    """Sets of the similarity meet in their prefixes whatever the counters say."""
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.r_[a[:max(1, n - int(rng.integers(0, 1 + n // 8)))], rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 8)), dtype=np.uint64)]
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            counters = rng.integers(0, 5, neardup.COUNTERS)
            assert len(np.intersect1d(neardup.prefix(a, counters, 80), neardup.prefix(b, counters, 80)))
    assert len(neardup.prefix(np.arange(10, dtype=np.uint64), np.zeros(neardup.COUNTERS, np.int64), 80)) == 3
    assert len(neardup.prefix(np.arange(10, dtype=np.uint64), np.zeros(neardup.COUNTERS, np.int64), 100)) == 1


def test_large_regions_are_taken_deeper():
    rng = np.random.default_rng(0)
    n = 400
    minima = rng.integers(0, 2**32, (n, neardup.DEEPEST), dtype=np.uint64).astype(np.uint32)
    minima[:, :neardup.DEPTH] = 5                                   # one region
    minima[[3, 300]] = minima[3]                                    # two equal prefixes in it
    keys = np.zeros((n, 1 + 4 * neardup.DEEPEST), np.uint8)
    keys[:, 1:] = minima.astype(">u4").view(np.uint8)
    order = np.lexsort(keys.T[::-1])
    sigs = np.zeros((n, neardup.HASHES), np.uint8)
    a, b = neardup.region_pairs(keys[order], sigs)
    assert {tuple(sorted((order[i], order[j]))) for i, j in zip(a, b)} == {(3, 300)}
    a, b = neardup.region_pairs(keys[order][:20], sigs[:20])        # a small region: all of it meets
    assert len(a) == 20 * 19 // 2


def test_smallest_label():
    a, b = np.array([1, 2, 7, 4]), np.array([2, 3, 5, 9])
    assert neardup.smallest_label(10, a, b).tolist() == [0, 1, 1, 1, 4, 5, 6, 5, 8, 4]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r["node"]: r["comp"] for r in neardup.components(edges, "chain").collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
    assert neardup.components(edges.filter("a < 0"), "none").count() == 0


def classes_of(docs, rows):
    sketch = neardup.sketch(docs(rows), "doc_id", "text", 4)
    return sketch.filter("hi is not null").selectExpr("id as rep", "sig").cache()


def groups(frame):
    edges = [(r["a"], r["b"]) for r in frame.collect()]
    n = 1 + max(max(e) for e in edges)
    return neardup.smallest_label(n, np.array([e[0] for e in edges]), np.array([e[1] for e in edges]))


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_few_classes_over_many_partitions(docs, words, many_partitions):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(words) for _ in range(100))) for i in range(5)]
    rows += [(5 + i, text + " more") for i, text in rows]
    label = groups(neardup.neighbours(classes_of(docs, rows)))
    assert label.tolist() == [0, 1, 2, 3, 4] * 2


@pytest.mark.parametrize("range_rows, one_range", [(8, 65_536), (300, 65_536), (300, 500)])
def test_cuts_lose_no_pair(docs, words, many_partitions, monkeypatch, range_rows, one_range):
    """Ranges far shorter than a seam, longer ones, and a second level of cuts, against one range for all rows."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(90)]
    texts += [edited(rng, t.split(), words, 0.04) for t in texts]
    classes = classes_of(docs, list(enumerate(texts)))
    monkeypatch.setattr(neardup, "RANGE_ROWS", 10**9)
    whole = groups(neardup.neighbours(classes))
    monkeypatch.setattr(neardup, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(neardup, "ONE_RANGE", one_range)
    cut = groups(neardup.neighbours(classes))
    assert (whole != np.arange(len(whole))).sum() > 60
    assert (cut[whole] == cut[:len(whole)]).all()
