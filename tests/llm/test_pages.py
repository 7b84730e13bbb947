"""WARC archives and URL filters."""
import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

from gridpanel.llm import urlfilter, warc

SCHEMA = "page_id long, url string, html string, host string, digest string, ts string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x", "x") for i, u, h in rows], SCHEMA).repartition(3)


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


HARD = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n é 𝒳 \x00"
ROWS = [(3, "http://b.example/x", "same"), (1, "http://a.example/y", "same"), (2, "http://a.example/y", "same"), (4, None, None), (5, "", ""),
        (6, "https://a.b.example:80/p?q=1#f", HARD), (7, "http://a.example/y\n%0A", HARD), (8, "no scheme", "long " * 50000), (-5, "http://z/", "neg"),
        (9, "http://z/", "neg")]


def test_archive_round_trip(spark):
    rows = ROWS + [(100 + i, f"http://h{i % 7}.example/{i}", f"page {i % 40}") for i in range(300)] + [(1000 + i, "http://hot/", "hot") for i in range(200)]
    got = {r["page_id"]: r for r in warc.digest_query(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        first[h or ""] = min(i, first.get(h or "", i))
    for i, _, h in rows:
        lead = first[h or ""]
        assert tuple(got[i])[1:] == (len((h or "").encode()), b32(h), "response" if lead == i else "revisit", None if lead == i else lead)


def test_index_is_globally_ordered(spark):
    rng = random.Random(1)
    rows = [(i, f"http://{rng.choice('abc')}.example/{rng.randrange(9)}", f"p{i}") for i in range(400)]
    index = [r.asDict() for r in warc.archive_and_index(pages(spark, rows)).collect()]
    index.sort(key=lambda r: (r["part"], r["pos"]))
    keys = [(r["url_key"], r["ts"], r["page_id"]) for r in index]
    assert keys == sorted(keys) and len({r["run"] for r in index}) > 1
    assert index[0]["url_key"].startswith("example,a)")


def test_written_archives_are_valid(spark, tmp_path):
    warc.write(warc.records(pages(spark, ROWS)), str(tmp_path / "w"), 1500)
    seen, ids = [], set()
    for f in (tmp_path / "w").glob("**/part-*"):
        for head, block, _ in warc.parse(zlib.decompress(f.read_bytes(), 31)):
            seen.append(head["WARC-Type"])
            ids.add(head["WARC-Record-ID"])
            assert ("WARC-Profile" in head) == (head["WARC-Type"] == "revisit")
            if head["WARC-Type"] == "response":
                assert head["WARC-Payload-Digest"] == "sha1:" + warc.base32_sha1(block)
            else:
                assert block == b"" and head["WARC-Refers-To"]
    assert sorted(seen) == sorted(["revisit"] * 5 + ["response"] * 5)        # "same" twice, HARD, "neg", and "" after null


def test_files_are_cut_by_bytes(spark, tmp_path):
    """A run of large pages after small ones: no file holds more than the bound, but for single records beyond it."""
    rng = random.Random(3)
    rows = [(i, "http://a/", f"small {i}") for i in range(200)] + [(1000 + i, "http://b/", "".join(rng.choices("abcdef", k=20_000))) for i in range(40)]
    rows += [(5000, "http://c/", "".join(rng.choices("abcdef", k=200_000))), (None, "http://c/", "no id"), (None, "http://c/", "no id either")]
    warc.write(warc.records(pages(spark, rows)), str(tmp_path / "w"), 100_000)
    sizes, ids, single = [], [], 0
    for f in (tmp_path / "w").glob("**/part-*"):
        data = zlib.decompress(f.read_bytes(), 31)
        found = list(warc.parse(data))
        ids += [h["WARC-Record-ID"] for h, _, _ in found]
        single += len(found) == 1 and len(data) > 100_500
        sizes.append((len(data), len(found)))
    assert all(size <= 100_000 + 4 * n for size, n in sizes if n > 1) and single == 1
    assert len(ids) == len(set(ids)) == len(rows) and len(sizes) < 40
    assert warc.read_runs(spark, str(tmp_path / "w")).count() == len(rows)


def test_min_bytes_repeated_and_missing_ids(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef"), (4, "u", "abcdef"), (None, "u", "abcdef"), (None, "u", "only")]
    got = sorted((r["page_id"] or 0, r["type"], r["refers_to"]) for r in warc.records(pages(spark, rows), min_bytes=3).collect())
    assert got == [(0, "response", None), (0, "revisit", 3), (1, "response", None), (2, "response", None), (3, "response", None),
                   (4, "revisit", 3), (4, "revisit", 3)]
    assert warc.digest_query(pages(spark, rows)).count() == 7
    assert warc.digest_query(pages(spark, [])).count() == 0


@pytest.mark.parametrize("runs", [[], [[]], [[3]], [[1, 4], [2, 3], []], [[1, 1], [1], [0, 5], [1, 2, 9], [7]]])
def test_loser_tree(runs):
    merged = [runs[r][i] for r, i in warc.LoserTree(runs)]
    assert merged == sorted(x for r in runs for x in r)
    places = list(warc.LoserTree(runs))
    assert all(a[1] < b[1] for a, b in zip(places, places[1:]) if a[0] == b[0])


def test_loser_tree_random():
    rng = random.Random(0)
    for k in range(1, 20):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(30))) for _ in range(k)]
        assert [runs[r][i] for r, i in warc.LoserTree(runs)] == sorted(x for r in runs for x in r)


def judged(spark, rows):
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages(spark, rows)).collect()}


def test_rules(spark):
    urls = {1: ("http://Shop.Net/x", "shop.net", "/x", "net/", "block"), 2: ("https://a.EXAMPLE.net/en/p?q#f", "a.example.net", "/en/p", "example.net/en/", "allow"),
            3: ("http://example.net/EN/p", "example.net", "/EN/p", "net/", "block"), 4: ("x://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
            5: ("x://notexample.com/de/", "notexample.com", "/de/", None, None), 6: ("http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
            7: ("http://net/", "net", "/", "net/", "block"), 8: ("http://net", "net", "", None, None), 9: ("http://a.net?x=/", "a.net", "", None, None),
            10: (None, "", "", None, "allow"), 11: ("example.net/en/", "", "", None, "allow"), 12: ("", "", "", None, "allow"),
            13: ("http://ÄB.org/fr/é", "Äb.org", "/fr/é", "org/fr/", "allow"), 14: ("a://b://c.net/", "b:", "//c.net/", None, None), 15: ("http://orgx/fr/", "orgx", "/fr/", None, None)}
    got = judged(spark, [(i, u[0], None) for i, u in urls.items()])
    for i, (_, host, path, rule, verdict) in urls.items():
        assert got[i][:3] == (host, path, rule) and (verdict is None or got[i][3] == verdict)
    assert judged(spark, []) == {}


def test_propagation(spark):
    link = '<a href="http://{}/">x</a>'
    rows = [(1, "http://good.org/fr/", link.format("friend.io") * 2), (2, "http://bad.net/", ""), (3, "http://spam.io/", link.format("bad.net") * 5),
            (4, "http://friend.io/", "<A HREF='//Other.io/p'>y</A>"), (5, "http://other.io/", None), (6, "http://lone.io/", "<a href='/local'>"),
            (7, "http://spammer.io/", link.format("spam.io"))]
    got = judged(spark, rows)
    assert {i: got[i][3] for i in got} == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block"}
    assert judged(spark, rows + rows)[3][3] == "block"


def test_edges(spark):
    rows = pages(spark, [(1, "", "<a href=http://b.c.d/x><a href='https://B.C.D'><a href='//e'>")]).selectExpr("'a.b.c.d' as host", "html")
    got = {(r["src"], r["dst"]): r["w"] for r in urlfilter.host_edges(rows).collect()}
    assert got == {("a.b.c.d", "b.c.d"): 3, ("a.b.c.d", "e"): 1, ("b.c.d", "c.d"): 1}


def walked(spark, edges, seeds, **kw):
    """{host: score} of ``(src, dst, w)`` and ``(host, base)``."""
    e = spark.createDataFrame([("allow", *x) for x in edges], "kind string, src string, dst string, w long")
    s = spark.createDataFrame([("allow", *x) for x in seeds], "kind string, host string, base long")
    return {r["host"]: float(r["score"]) for r in urlfilter.propagate(e, s, **kw).collect()}


def test_far_hosts_are_reached(spark):
    link = '<a href="http://{}/">x</a>'
    rows = [(0, "http://bad.net/", "")] + [(i, f"http://h{i}.io/", link.format(f"h{i - 1}.io" if i > 1 else "bad.net")) for i in range(1, 15)]
    got = judged(spark, rows)
    assert {got[i][3] for i in range(15)} == {"block"}


def test_scores_converge(spark):
    """A chain of twelve hosts and a cycle behind it against the solved equations."""
    hosts = [f"h{i}" for i in range(12)] + ["a", "b", "c"]
    edges = [(f"h{i}", f"h{i + 1}", 1) for i in range(11)] + [("h11", "a", 2), ("h11", "h3", 1), ("a", "b", 1), ("b", "c", 3), ("b", "a", 1), ("c", "a", 1)]
    m = np.zeros((len(hosts),) * 2)
    for s, d, w in edges:
        m[hosts.index(d), hosts.index(s)] = w / sum(x[2] for x in edges if x[0] == s)
    base = np.zeros(len(hosts))
    base[0] = 10**9
    exact = np.linalg.solve(np.eye(len(hosts)) - 0.85 * m, 0.15 * base)
    got = walked(spark, edges, [("h0", 10**9)])
    assert [got[h] for h in hosts] == pytest.approx(exact, rel=1e-6)
    with pytest.raises(RuntimeError, match="rounds"):
        walked(spark, edges, [("h0", 10**9)], limit=12)


def test_hub_among_millions_of_seed_pages(spark):
    """A host of one blocked page, 10,000 hosts that link to it, and millions of other blocked pages."""
    pages_of = spark.createDataFrame([("block", "big.net", 3_000_000), ("block", "hub.net", 1)], "kind string, host string, n long")
    edges = spark.range(10_000).selectExpr("'block' as kind", "'hub.net' as src", "concat('h', id, '.io') as dst", "1L as w")
    got = {r["host"]: r["score"] for r in urlfilter.propagate(edges, urlfilter.seed_shares(pages_of)).collect()}
    assert len(got) == 10_002
    assert got["h7.io"] == pytest.approx(0.15 * 0.85 / 3_000_001 / 10_000)
    assert sum(got.values()) == pytest.approx(0.15 + 0.15 * 0.85 / 3_000_001)


def test_hub_verdicts(spark):
    """Through the whole query: 40,000 hosts link to one blocked page beside 40,000 other blocked pages."""
    link = "'<a href=http://hub.net/>'"
    rows = spark.range(40_000).selectExpr("id as page_id", "concat('http://big.net/', id) as url", "'' as html").unionAll(
        spark.range(40_000).selectExpr("id + 100000 as page_id", "concat('http://h', id, '.io/') as url", f"{link} as html")).unionAll(
        spark.range(1).selectExpr("id - 1 as page_id", "'http://hub.net/' as url", "'' as html"))
    got = {r["verdict"]: r["count"] for r in urlfilter.judge(rows).groupBy("verdict").count().collect()}
    assert got == {"block": 80_001}


def test_equal_scores_allow(spark):
    link = '<a href="http://{}/">x</a>'
    rows = [(1, "http://good.org/fr/", link.format("mid.io")), (2, "http://bad.net/", ""), (3, "http://mid.io/", link.format("bad.net"))]
    assert judged(spark, rows)[3][3] == "allow"
