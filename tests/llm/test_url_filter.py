from __future__ import annotations

import numpy as np
import pytest

from comptoir.llm import url_filter
from comptoir.llm.url_filter import ALLOW, BLOCK


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    ends = lambda s, stops: min([s.index(c) for c in stops if c in s], default=len(s))
    at = ends(rest, "/?#")
    path = rest[at:]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
    return lower, path[:ends(path, "?#")]


def verdict(host, path, entries):
    fits = [(len(h) + len(p), len(h), h + p, a) for h, p, a in entries if (host == h or host.endswith("." + h)) and path.startswith(p) and host]
    return max(fits)[2:] if fits else None


URLS = [
    None, "", "no scheme", "http://", "http:///en/x", "HTTP://WWW.Example.COM/en/1?x#y", "https://example.com/en/", "https://example.com/en",
    "https://a.b.example.com/en/2", "https://example.com", "https://example.com?q=/en/", "https://badexample.com/en/", "https://x.net/es/1",
    "https://net/fr/", "https://x.net/de/1", "https://x.org/en/1", "a://b://c.com/", "https://İ.com/x", "https://casino.x.org/",
    "https://www.cheap-pills.x.org/", "https://pills-shop.x.org/a", "https://padspace.org/", "ftp://com/", "x://.com/", "x://com./",
    "https://" + "a." * 5000 + "com/en", "https://y.com/" + "p/" * 20000, "https://x.org\n.com/a\nb",
]


def test_pages(spark):
    rows = [(i, u, "<html>", "x", 1, "y") for i, u in enumerate(URLS)] + [(3, "https://casino.x.org/", None, None, None, None)] * 2 + [(None, "https://q.com/", "", "", 1, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, list int, verdict string")
    got = url_filter.judged_pages(pages).collect()
    hosts = {parts(u)[0] for _, u, *_ in rows}
    words = set(url_filter.BLOCKED_WORDS)
    listed = [(h, "", BLOCK) for h in hosts if words & set(h.replace("-", ".").split("."))]
    expected = []
    for i, u, *_ in rows:
        host, path = parts(u)
        rule = verdict(host, path, url_filter.RULES)
        final = rule or verdict(host, path, listed) or (None, ALLOW)
        expected.append(repr((i, host, path, rule and rule[0], final[1])))
    assert sorted(repr((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in got) == sorted(expected)
    assert url_filter.judged_pages(pages.limit(0)).count() == 0


def test_listed_hosts_are_these(spark):
    """Written out, so that a word that is missing from the list is seen."""
    blocked = [
        "adult-x.example.net", "www.adult-x.example.net", "sex.example.org", "a.xxx", "free-porn.example.org", "pornhouse.example.net",
        "ads-track.example.net", "free-bets.example.net", "bet.example.net", "casino-win.example.org", "bestcasino.example.net",
        "casinos24.net", "poker24.net", "cheap-pills.example.org", "buyviagra.net", "m.spam-farm.example.org"]
    allowed = [
        "padspace.org", "essex.example.net", "alphabet.example.net", "adulthood.example.org", "spills.example.net", "pornic.example.org",
        "pornichet.net", "antispam.example.org", "example.org", "blog.example.net", "downloads.example.net", "xxxl.example.net"]
    rows = [(i, f"https://{h}/de/1") for i, h in enumerate(blocked + allowed)]
    got = url_filter.judged_pages(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert {r.host for r in got if r.verdict == BLOCK} == set(blocked)
    assert {r.host for r in got if r.verdict == ALLOW} == set(allowed)


def judged(spark, urls, entries, **options):
    known = url_filter.UrlList(spark.createDataFrame(entries, "host string, path string, verdict string"), **options)
    frame = spark.createDataFrame([(i, h, p) for i, (h, p) in enumerate(urls)], "n long, host string, path string")
    rows = sorted(known.judged(frame).collect(), key=lambda r: r.n)
    return known, [r.found and tuple(r.found) for r in rows]


@pytest.mark.parametrize("range_rows, asked_rows", [(1 << 16, 1 << 20), (5, 1 << 20), (7, 3)])
def test_random_lists(spark, monkeypatch, range_rows, asked_rows):
    """One range or many, one block or many."""
    monkeypatch.setattr(url_filter, "ASKED_ROWS", asked_rows)
    pick = np.random.default_rng(6)
    label = lambda: str(pick.choice(["a", "bb", "c-c", "d", "é"]))
    host = lambda n: ".".join(label() for _ in range(pick.integers(1, n)))
    path = lambda: "".join("/" + label() for _ in range(pick.integers(0, 4)))
    entries = list({(h, p): (h, p, str(pick.choice([ALLOW, BLOCK]))) for h, p in [(host(4), path()) for _ in range(60)]}.values())
    urls = [(host(6), path()) for _ in range(500)] + [("", "/a")]
    known, got = judged(spark, urls, entries + entries[:9], range_rows=range_rows)
    assert got == [verdict(h, p, entries) for h, p in urls]
    held = known.ranges.collect()
    assert sum(len(r.digests) // 8 for r in held) == len(entries) and (len(held) > 4) == (range_rows < 10)
    for r in held:
        arrays = url_filter.DigestArrays(r.asDict())
        assert isinstance(arrays.digests, np.memmap) and list(arrays.digests) == sorted(arrays.digests)


def test_collisions_are_told_apart():
    """With all digests equal only the stored texts decide."""
    same = np.full(3, 7, np.uint64)
    known = url_filter.DigestArrays(url_filter.DigestArrays.packed(same, [b"a", b"bb", b""], np.array([1, 0, 1])))
    assert known.find(np.array([7, 7, 7, 7, 8], np.uint64), [b"bb", b"c", b"", b"a", b"a"]).tolist() == [1, -1, 2, 0, -1]


def test_equal_entries_and_an_empty_list(spark):
    urls = [("a", "/x"), ("b", "/"), ("c", "/"), ("", "")]
    entries = [("a", "/", BLOCK), ("b", "/", ALLOW), ("b", "/", BLOCK), (None, "/", BLOCK), ("", "/", BLOCK), ("c", None, ALLOW)]
    assert judged(spark, urls, entries)[1] == [("a/", BLOCK), ("b/", BLOCK), ("c", ALLOW), None]
    assert judged(spark, urls, [])[1] == [None] * 4


def test_a_list_of_half_the_hosts(spark):
    """A list as large as the pages, given as a table; a host in a third of the rows."""
    rows = [(i, f"https://h{0 if i % 3 == 0 else i}.example.org/p{i}") for i in range(20_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.range(0, 20_000, 2).selectExpr("concat('h', id, '.example.org') AS host", "'' AS path", "'block' AS verdict")
    got = {r.page_id: r.verdict for r in url_filter.judged_pages(pages, listed).collect()}
    assert got == {i: BLOCK if i % 3 == 0 or i % 2 == 0 else ALLOW for i in range(20_000)}


def test_hosts_under_a_listed_one_go(spark):
    hosts = ["a.b.c", "b.c", "xb.c", "c.d", "e.c.d.e", "a.a.b.c", "d.e", "z", "z"]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    assert sorted(r.host for r in url_filter.without_subdomains(frame).collect()) == ["b.c", "c.d", "d.e", "xb.c", "z"]
