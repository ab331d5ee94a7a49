from __future__ import annotations

from collections import Counter

from tests.llm.support import pages

from plumbline.llm import urls
from plumbline.llm.common import literal_rows


def brute(url, rules):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else None
    if rest is None:
        host = path = ""
    else:
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


URLS = [
    "http://example.com/en/1", "https://WWW.Example.com/en/2?x=/fr/", "http://m.example.com/en", "http://a.b.net/es/9#/x", "http://net/fr/",
    "http://notexample.com/en/", "http://example.com?x", "http://example.com", "ftp://x.net/ES/", "nothing", "", None, "http://", "://com/",
    "http://u:p@example.com:80/en/", "http://ÉXAMPLE.com/en/", "http://a.com//en/://b.net/es/", "http://" + "a." * 500 + "com/" + "y" * 5000,
]


def test_rules(spark):
    rows = [(k, u, None) for k, u in enumerate(URLS)] + [(None, URLS[0], ""), (0, URLS[0], None)]
    got = Counter(tuple(r) for r in urls.filter_urls(pages(spark, rows), urls.rules_frame(spark)).drop("by_alias").collect())
    want = Counter()
    for k, u, _ in rows:
        host, path, best = brute(u, urls.RULES)
        want[(k, host, path, best and best[0], best[1] if best else "allow")] += 1
    assert got == want


def test_no_rules_and_no_pages(spark):
    none = urls.rules_frame(spark).limit(0)
    got = urls.filter_urls(pages(spark, [(1, "http://net/es/", None)]), none).collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "allow")]
    assert urls.filter_urls(pages(spark, []), urls.rules_frame(spark)).count() == 0


def test_blocks_pass_to_aliases_but_not_over_an_allow(spark):
    canonical = '<link href="{}" rel="canonical">'
    rows = [
        (1, "http://alias.org/a", canonical.format("http://x.net/es/1")),  # links to a blocked page that is not in the table
        (2, "http://other.org/b#frag", '<META http-equiv=refresh content="0; URL=http://alias.org/a">'),  # two steps away
        (3, "http://shop.com/c", canonical.format("http://x.net/es/1")),  # allowed by its own rule
        (4, "http://clean.org/d", canonical.format("/d2")),
        (5, "http://clean.org/d2", None),
        (6, "http://x.net/fr/z", canonical.format("http://mirror.org/z?a=1&amp;b=2")),
        (7, "http://mirror.org/z?a=1&b=2", "<link rel=stylesheet href='http://x.net/es/1'>"),
        (8, "http://late.org/", None),
    ]
    redirects = literal_rows(spark, [("http://late.org/", "http://other.org/b")], ["a", "b"])
    got = {r.page_id: (r.rule, r.verdict, r.by_alias) for r in urls.filter_urls(pages(spark, rows), urls.rules_frame(spark), redirects).collect()}
    assert got == {
        1: (None, "block", True), 2: (None, "block", True), 3: ("com/", "allow", False), 4: (None, "allow", False), 5: (None, "allow", False),
        6: ("net/fr/", "block", False), 7: (None, "block", True), 8: (None, "block", True),
    }


def test_relative_links(spark):
    rows = [(k, "http://h.org/a/b?q", f'<link rel="canonical" href="{h}">') for k, h in enumerate(["c", "/d", "//i.org/e", "https://j.org/f#g"])]
    got = {(r.a, r.b) for r in urls.page_edges(pages(spark, rows)).collect()}
    assert {b for _, b in got} == {"http://h.org/a/c", "http://h.org/d", "http://i.org/e", "https://j.org/f"}
