"""The URL filter against a plain reading of its rules, broadcast and joined, and on odd rows."""

import random
import re

import pytest

from jobtide.llm import url_trie

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("WWW.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
    ("b.net", "/f", "allow"), ("net", "/fr/a/b", "allow"), ("net", "/fr/a/bc", "block"), ("org", "", "block"), ("a.org", "/x", "allow"), ("a.org", "/x", "BLOCK "),
    ("c.org", "/x/", "allow"), ("d", None, "block"), ("..e", "//", "block"),
]
URLS = [
    None, "", "no scheme", "http://", "://", "HTTP://Example.COM/en/1?x=/fr/#y", "https://www.EXAMPLE.com/en/", "https://www.example.com/en", "https://xexample.com/en/", "https://a.www.example.com/en/é",
    "http://net/es/", "http://x.net/es", "http://x.net/fr/a/bcd", "http://x.net/fr/a/b/c", "http://a.b.net/fr/", "http://b.net/foo", "http://org", "http://org?x", "http://a.org#/x", "http://a.org/xy", "http://c.org/x//", "http://q.c.org/x",
    "http://user@org:80/", "http://d", "http://.d/", "http://...e//a", "http://e//", "x\ny://org/\nz", "ftp://a://org/x", "http://ÀÉ.com/", "http://org./", "http://" + "a." * 5000 + "net/es/" + "b/" * 5000, "http://com/" + "x" * 200_000,
]


def plain(url, rules, default="allow"):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1].translate(upper), found[2]) if found else ("", "")
    fits = []
    for h, p, action in rules:
        h, p, action = h.translate(upper), p or "", action.strip().lower()
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h) + len(p), len(h), action == "block", h + p, action))
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


def judged(spark, urls, rules, **more):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_trie.judge_urls(pages, table, keep=["page_id"], **more).collect()}


@pytest.mark.parametrize("most", [url_trie.BROADCAST_BYTES, 0])
def test_verdicts_equal_plain_reading(spark, most):
    expected = {i: plain(u, RULES) for i, u in enumerate(URLS)}
    assert judged(spark, URLS, RULES, broadcast_bytes=most) == expected
    assert {v[3] for v in expected.values()} == {"allow", "block"}
    everywhere = [*RULES, ("", "", "block"), ("", "/en/", "allow")]
    assert judged(spark, URLS, everywhere, broadcast_bytes=most, default="x") == {i: plain(u, everywhere, "x") for i, u in enumerate(URLS)}


@pytest.mark.parametrize("most", [url_trie.BROADCAST_BYTES, 0])
def test_many_random_entries(spark, most):
    dice = random.Random(3)
    host = lambda: ".".join(dice.choice(["a", "b", "ab"]) for _ in range(dice.randint(1, 3)))
    path = lambda: "/".join(["", *(dice.choice(["a", "b", "ab", ""]) for _ in range(dice.randint(0, 3)))])
    rules = [(host(), path(), dice.choice(["allow", "block"])) for _ in range(150)]
    urls = [f"http://{host()}{path()}" for _ in range(400)]
    assert judged(spark, urls, rules, broadcast_bytes=most, default="none") == {i: plain(u, rules, "none") for i, u in enumerate(urls)}


def test_odd_tables(spark):
    rows = [(1, "http://org/a", "h", "p", "r", 5, "x"), (1, "http://org/a", "h", "p", "r", 5, "x"), (None, None, None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, rule string, verdict int, action string")
    table = spark.createDataFrame(RULES, "host string, path string, action string")
    for most in (url_trie.BROADCAST_BYTES, 0):
        found = url_trie.judge_urls(pages, table, broadcast_bytes=most)
        assert found.columns == ["page_id", "url", "action", "host", "path", "rule", "verdict"]
        assert [tuple(r) for r in found.orderBy("page_id").collect()] == [(None, None, None, "", "", None, "allow"), *[(1, "http://org/a", "x", "org", "/a", "org", "block")] * 2]
        assert url_trie.judge_urls(pages.limit(0), table, broadcast_bytes=most).count() == 0
    left = url_trie.keep_allowed(pages, table)
    assert left.columns == pages.columns and [tuple(r) for r in left.collect()] == [(None,) * 7]
    assert {r.verdict for r in url_trie.judge_urls(pages, table.limit(0), default="block").select("verdict").collect()} == {"block"}
    with pytest.raises(Exception, match="no action of a URL entry: deny"):
        url_trie.judge_urls(pages, spark.createDataFrame([("a", "/", "deny")], table.schema)).count()
