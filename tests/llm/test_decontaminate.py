import random
import time

import numpy as np
import pytest

from gridpanel.llm import decontaminate as D


def tiling(item, doc, least):
    """Greedy string tiling by comparing all places."""
    used_a, used_b, out = [False] * len(item), [x < 0 for x in doc], []
    while True:
        best = 0
        found = []
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n > best:
                    best, found = n, []
                if n == best and n:
                    found.append((i, j))
        if best < least:
            return sum(used_a), out
        for i, j in found:
            if not any(used_a[i:i + best]) and not any(used_b[j:j + best]):
                used_a[i:i + best] = used_b[j:j + best] = [True] * best
                out.append(best)


@pytest.mark.parametrize("seed", range(40))
def test_tiles_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    item, doc = rng.integers(0, 4, rng.integers(1, 25)), rng.integers(-1, 4, rng.integers(0, 40))
    got = D.tiles(item, doc, 2)
    matched, lengths = tiling(item.tolist(), doc.tolist(), 2)
    assert [n for _, _, n in got] == lengths and sum(lengths) == matched
    for a, b, n in got:
        assert (item[a:a + n] == doc[b:b + n]).all()


def leaked(docs_frame, bench_frame, **options):
    return sorted((r["doc_id"], r["item_id"], round(r["coverage"], 3)) for r in D.leaks(docs_frame, bench_frame, **options).collect())


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, coverage int")


def test_leaks(spark, docs, words, odd_texts):
    rng = random.Random(1)
    item = [rng.choice(words[:300]) for _ in range(30)]
    pad = [" ".join(rng.choice(words) for _ in range(50)) for _ in range(6)]
    texts = [
        pad[0] + " " + " ".join(item) + " " + pad[1],                                                  # whole
        " ".join([pad[2], *item[20:], pad[3], *item[:10], pad[4], *item[10:20]]),                       # reordered
        " ".join([*item[:15], pad[5]]),                                                                 # half
        " ".join([*item[:14], pad[5]]),                                                                 # less than half
        "".join(w.upper() + " -- " for w in item),                                                      # other case and punctuation
        " ".join(w for x in item for w in (x, "zz")),                                                   # words only
        " ".join([" ".join(item[:6]), pad[0]] * 5),                                                     # one part again and again
        " ".join(odd_texts[5].split() + item),                                                          # at the end of a long text
        *odd_texts]
    rows = [*enumerate(texts), (0, texts[0])]
    items = [(1, " ".join(item)), (2, None), (3, ""), (4, "too short"), (5, " ".join(words[1000:1030])), (6, " ".join(item))]
    found = leaked(docs(rows).repartition(3), bench(spark, items))
    long_id = len(texts) - len(odd_texts) + 5           # that text repeats all words, so item 5 too
    expected = [(d, i, c) for d, c in ((0, 1.0), (0, 1.0), (1, 1.0), (2, 0.5), (4, 1.0), (7, 1.0)) for i in (1, 6)] + [(7, 5, 1.0), (long_id, 5, 1.0)]
    assert found == sorted(expected)
    assert leaked(docs(rows), bench(spark, items), index_bytes=64) == found                             # in many blocks
    clean = D.drop_leaks(docs(rows), bench(spark, items))
    gone = {d for d, _, _ in found}
    assert sorted(r["doc_id"] for r in clean.collect()) == [i for i in range(len(texts)) if i not in gone]
    assert clean.columns == docs(rows).columns


def test_short_and_unspaced_items(spark, docs, words):
    pad = " ".join(words[:40])
    chinese = "请问下列哪一个选项是正确的答案"
    items = [(1, "Capital of France?"), (2, "yes"), (3, "What is 2+2"), (4, chinese), (5, "ภาษาไทยไม่มีช่องว่างระหว่างคำ"), (6, " ".join(words[100:110])), (7, "!?")]
    texts = [f"{pad} capital OF france {pad}", "capital of, and france", "Yes!", f"{pad} yes", "what is 2 2", "what is 2",
             f"{pad}{chinese}。{pad}", chinese[:5] + "天" + pad, "x ภาษาไทยไม่มีช่องว่างระหว่างคำ y", " ".join(words[100:105]) + " " + pad, " ".join(words[100:108])]
    got = {(d, i) for d, i, _ in leaked(docs(list(enumerate(texts))).repartition(2), bench(spark, items))}
    assert got == {(0, 1), (2, 2), (4, 3), (6, 4), (8, 5), (10, 6)}
    gone = {d for d, _ in got}
    assert sorted(r["doc_id"] for r in D.drop_leaks(docs(list(enumerate(texts))), bench(spark, items)).collect()) == [i for i in range(len(texts)) if i not in gone]


def test_common_opener_of_many_items(words, monkeypatch):
    """Thousands of items that begin alike cost a text a count each; results are those of plain tiling."""
    rng = random.Random(2)
    opener = "which of the following is"
    items = [(i, opener + " " + " ".join(rng.choice(words) for _ in range(12))) for i in range(16_000)]
    index = D.Index(items, 5)
    texts = [f"{opener} " + " ".join(rng.choice(words) for _ in range(200)) for _ in range(20)] + [items[777][1], None, ""]
    start = time.perf_counter()
    got = [(d, i) for d, i, _ in index.covered(texts)]
    assert time.perf_counter() - start < 0.1 * len(texts) and got == [(20, 777)]
    monkeypatch.setattr(D, "PAIRS", 1000)                       # fewer than one text has
    assert [(d, i) for d, i, _ in index.covered(texts)] == got


@pytest.mark.parametrize("seed", range(4))
def test_pruned_pairs_equal_plain_tiling(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 22)))) for i in range(25)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(25)]
    index = D.Index(items, 5)
    got = {(d, i) for d, i, _ in index.covered(texts)}
    want = set()
    for d, t in enumerate(texts):
        doc = [index.number.get(w, -1) for w in D.words(t)]
        for i, (_, seq) in enumerate(index.items):
            n = len(seq)
            matched = tiling(seq.tolist(), doc, min(5, n))[0]
            if matched >= max(0.5 * n, min(n, D.ENOUGH)):
                want.add((d, i))
    assert got == want and want


def test_empty_tables(spark, docs):
    assert leaked(docs([]), bench(spark, [(1, "a b c d e f")])) == []
    assert leaked(docs([(1, "a b c d e f")]), bench(spark, [])) == []
    assert D.drop_leaks(docs([(1, "a b c d e f"), (2, None)]), bench(spark, [])).count() == 2


def test_query_finds_what_plain_search_finds(spark):
    sf = "/root/testdata/sf0.01"
    frame, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    found = {(d, i) for d, i, _ in leaked(frame, items)}
    texts = {r["doc_id"]: " " + " ".join(D.words(r["text"])) + " " for r in frame.collect()}
    for r in items.collect():
        w = D.words(r["text"])
        whole = " " + " ".join(w) + " "
        assert {d for d, t in texts.items() if whole in t} <= {d for d, i in found if i == r["item_id"]}
        seeds = [" " + " ".join(w[k:k + 5]) + " " for k in range(len(w) - 4)]
        assert {d for d, i in found if i == r["item_id"]} <= {d for d, t in texts.items() if any(s in t for s in seeds)}
