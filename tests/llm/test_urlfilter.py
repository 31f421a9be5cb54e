"""URL rules and aliases against a plain Python version."""

import random
import time

import pytest

from scholaris.llm import urlfilter
from scholaris.llm.urlfilter import RULES, Rule


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def rule_of(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "allow"), default=None)


def brute(pages, rules, links):
    """`links`: pairs of URLs that are aliases, as far as the pages declare them."""
    def node(url):
        plain = url.split("#")[0]
        cut = plain.find("://")
        end = min([plain.find(c, cut + 3) for c in "/?" if plain.find(c, cut + 3) >= 0], default=len(plain))
        return plain[:end].lower() + plain[end:] if cut > 0 else plain

    group = {}
    for a, b in [(node(a), node(b)) for a, b in links]:
        joined = group.get(a, {a}) | group.get(b, {b})
        for x in joined:
            group[x] = joined
    rows = []
    for page, url, _ in pages:
        rule = rule_of(url, rules)
        verdict = rule.verdict if rule else None
        if verdict is None:
            given = {r.verdict for x in group.get(node(url or ""), ()) if (r := rule_of(x, rules))}
            verdict = "block" if given == {"block"} else "allow"
        rows.append((page, *parts(url), rule and rule.host + rule.path, verdict))
    return rows


def table(spark, pages):
    rows = [(*p, "clash", "clash") for p in pages]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, node string").repartition(3)


def rules_table(spark, rules=RULES):
    return spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


URLS = [
    None, "", "no scheme", "http://", "://x.org/fr/a", "http://net", "http://net/", "HTTP://A.EXAMPLE.NET/en/1", "https://example.net/EN/1",
    "https://x.example.net/de/2?a=/en/", "https://example.net?x=/en/", "https://notexample.com/de/", "http://example.com/de/#top",
    "http://m.example.com/de", "http://w.org/fr/9.html#x", "http://w.org/frx", "http://example.net:80/en/", "a://b://c.net/", "http://ünï.net/a",
    "http://xn--a.İ.net/", "http://u@example.net/en/", "http://..net/", "http://example.net\n/en/",
]


def test_rules(spark):
    pages = [(i, u, "<html></html>") for i, u in enumerate(URLS)] + [(None, URLS[7], None), (3, URLS[7], None), (3, URLS[7], None)]
    found = urlfilter.judged(table(spark, pages), rules_table(spark)).collect()
    assert ordered(found) == ordered(brute(pages, RULES, []))


def test_many_rules_and_ties(spark):
    rng = random.Random(1)
    hosts = ["a.b.c", "b.c", "c", "x.b.c", "bb.c"]
    paths = ["", "/", "/p", "/p/", "/p/q"]
    rules = [Rule(rng.choice(["allow", "block"]), h, p) for h in hosts for p in paths if rng.random() < 0.6]
    rules += [Rule("allow", "b.c", "/p"), Rule("block", "b.c", "/p")]
    pages = [(i, f"http://{rng.choice(['', 'w.'])}{rng.choice(hosts)}{rng.choice([*paths, '/p/q/r', '/z'])}", "") for i in range(200)]
    found = urlfilter.judged(table(spark, pages), rules_table(spark, rules)).collect()
    assert ordered(found) == ordered(brute(pages, rules, []))
    none = urlfilter.judged(table(spark, pages), rules_table(spark).limit(0)).collect()
    assert ordered(none) == ordered(brute(pages, [], []))


ALIASES = [
    # (page, html, what it points to)
    ("http://free.com/a", '<LINK rel="canonical" href="http://shop.net/a">', "http://shop.net/a"),
    ("http://free.com/b", "<link href='//example.com/de/b' rel=canonical>", "http://example.com/de/b"),
    ("http://free.com/c", '<meta http-equiv="Refresh" content="0; URL=/d">', "http://free.com/d"),
    ("http://free.com/d", '<link rel="canonical" href="http://one.com/1?a=1&amp;b=2">', "http://one.com/1?a=1&b=2"),
    ("http://one.com/1?a=1&b=2#frag", '<meta http-equiv=refresh content="5;url=http://bad.net/x">', "http://bad.net/x"),
    ("http://free.com/e/f", '<link rel="canonical" href="g">', "http://free.com/e/g"),
    ("http://free.com/e/g", '<link rel="canonical" href="http://w.org/fr/">', "http://w.org/fr/"),
    ("http://w.org/fr/", '<link rel="canonical" href="http://evil.net/">', "http://evil.net/"),
    ("http://example.net/en/ok", '<link rel="canonical" href="http://evil2.net/">', "http://evil2.net/"),
    ("http://bare.com", '<link rel="canonical" href="here">', "http://bare.com/here"),
    ("http://many.com/1", '<link rel="alternate canonical" href="http://one.net/x">', "http://one.net/x"),
    ("http://many.com/2", '<link rel="canonical" href="http://w.com/"><p><link rel=canonical href="http://two.net/">', "http://two.net/"),
    ("http://many.com/a/b/3", '<link rel="canonical" href="../../v/./four">', "http://many.com/v/four"),
    ("http://many.com/v/four", '<link data-rel="x" href="http://four.net/" rel="CANONICAL">', "http://four.net/"),
    ("http://many.com/5?q=1", '<link rel="canonical" href="?q=2#f">', "http://many.com/5?q=2"),
    ("http://many.com/5?q=2", '<meta content="0;url=http://five.net/" http-equiv="refresh">', "http://five.net/"),
    ("http://many.com/6/", '<link rel="canonical" href="./../../../example.com/..">', "http://many.com/"),
    ("http://many.com/", '<meta http-equiv="refresh" content="9"><meta http-equiv="refresh" content="1; url=http://six.net/">', "http://six.net/"),
    ("http://many.com/7", '<link rel="canonicals" href="http://no.net/"><link rel="canonical" href="#top">', None),
    ("http://many.com/8", '<link rel="canonical" href="http://example.com/x/../de/8">', "http://example.com/de/8"),
    ("http://free.com/s", '<link rel="stylesheet" href="http://evil.net/"> canonical', None),
    (None, '<link rel="canonical" href="http://evil.net/">', None),
    ("http://free.com/z", None, None),
]


def test_aliases(spark):
    pages = [(i, u, h and f"<html><head>{h}</head>") for i, (u, h, _) in enumerate(ALIASES)]
    links = [(u, target) for u, _, target in ALIASES if target]
    found = urlfilter.judged(table(spark, pages), rules_table(spark)).collect()
    assert ordered(found) == ordered(brute(pages, RULES, links))
    verdicts = {r.page_id: r.verdict for r in found}
    assert [verdicts[i] for i in range(6)] == ["block"] * 5 + ["allow"]
    assert verdicts[6] == verdicts[7] == verdicts[8] == "allow"
    by_url = {u: verdicts[i] for i, (u, _, _) in enumerate(ALIASES)}
    blocked = {u for u, v in by_url.items() if u and u.startswith("http://many.com") and v == "block"}
    assert {u for u in by_url if u and u.startswith("http://many.com")} - blocked == {"http://many.com/7"}


def test_names_that_only_look_like_links(spark):
    """What is no canonical link: other words of rel, other attributes, comments on content."""
    pages = [
        (1, "http://a.com/", '<a rel="canonical" href="http://x.net/">'),
        (2, "http://b.com/", '<link rel="icon" title="canonical" href="http://x.net/">'),
        (3, "http://c.com/", '<meta name="http-equiv" content="0;url=http://x.net/">'),
        (4, "http://d.com/", '<meta http-equiv="refresh" content="http://x.net/">'),
        (5, "http://e.com/", '<link rel="canonical">'),
    ]
    found = urlfilter.judged(table(spark, pages), rules_table(spark)).collect()
    assert {r.verdict for r in found} == {"allow"} and ordered(found) == ordered(brute(pages, RULES, []))


def test_very_long_hosts_and_paths(spark):
    """Hosts of very many labels make as few strings as any other."""
    many = ".".join(["a"] * 300_000)
    deep = "/".join([".."] * 600 + ["p"] * 300_000)
    pages = [
        (1, f"http://{many}.net/x", ""), (2, f"http://{many}.com/de/", ""), (3, f"http://{many}.example.com/de/", ""),
        (4, "http://f.com/" + "q" * 1_000_000, ""), (5, "http://g.com/", f'<link rel="canonical" href="{deep}">'),
    ]
    started = time.monotonic()
    found = urlfilter.judged(table(spark, pages), rules_table(spark)).collect()
    assert ordered(found) == ordered(brute(pages, RULES, []))
    assert time.monotonic() - started < 30


@pytest.mark.parametrize(
    ("path", "plain"),
    [("/a/b", "/a/b"), ("/a/./b", "/a/b"), ("/a/../b", "/b"), ("/../..", "/"), ("/a/..", "/"), ("/a/b/.", "/a/b/"), ("/a//../b", "/a/b"), ("/a.../..b", "/a.../..b")],
)
def test_dots_in_paths(spark, path, plain):
    assert spark.range(1).select(urlfilter.without_dots(urlfilter.F.lit(path))).first()[0] == plain


def test_given_redirects(spark):
    pages = [(1, "http://q.com/", ""), (2, "http://r.com/", "")]
    redirects = spark.createDataFrame([("http://q.com/#x", "http://Z.net/"), (None, "http://r.com/")], "source string, target string")
    found = urlfilter.judged(table(spark, pages), rules_table(spark), redirects).collect()
    assert ordered(found) == ordered(brute(pages, RULES, [("http://q.com/", "http://z.net/")]))


def test_empty_table_and_no_python(spark):
    judged = urlfilter.judged(table(spark, []), rules_table(spark))
    assert judged.count() == 0
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("url", URLS)
def test_parts_of_urls(url):
    assert parts(url)[1] == "" or parts(url)[1][0] == "/"
