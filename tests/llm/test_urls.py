import pytest

from paddock.llm.urls import UrlRule, judge

RULES = [UrlRule("allow", "com", "/"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
         UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr/")]


def _verdicts(spark, rows, rules=RULES, edges=None):
    pages = spark.createDataFrame([(i, u, h, "old") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, verdict string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge(pages, rules, edges).collect()}


def test_rules(spark):
    urls = [None, "", "no scheme/en/", "HTTP://WWW.Example.COM/en/1?x#y", "https://a.example.com/en/2", "https://example.com/en", "https://example.com/EN/",
            "http://x.net/es/?q", "http://net/fr/a://b", "http://notexample.com/en/", "http://example.com", "http://b.org#/en/", "http://ünï.net/fr/é"]
    got = _verdicts(spark, [(u, None) for u in urls])
    assert [got[i] for i in range(len(urls))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("a.example.com", "/en/2", "example.com/en/", "block"), ("example.com", "/en", "com/", "allow"), ("example.com", "/EN/", "com/", "allow"),
        ("x.net", "/es/", "net/es/", "block"), ("net", "/fr/a://b", "net/fr/", "block"), ("notexample.com", "/en/", "com/", "allow"),
        ("example.com", "", None, "allow"), ("b.org", "", None, "allow"), ("ünï.net", "/fr/é", "net/fr/", "block")]


def _canonical(url):
    return f"<head><link href='{url}' rel=canonical></head>"


def test_decisions_reach_aliases(spark):
    rows = [
        ("http://a.org/1", _canonical("http://b.org/2")), ("http://b.org/2", '<meta http-equiv="refresh" content="0; url=https://x.net/es/3">'),
        ("https://x.net/es/3#top", None), ("http://a.org/1", None), ("http://c.org/", _canonical("/other")), ("http://d.org/", _canonical("http://x.net/fr/1")),
        ("http://d.org/2", _canonical("http://d.org/")), ("http://d.org/3", _canonical("http://ok.com/")), ("http://d.org/3?q", _canonical("http://d.org/")),
        ("http://ok.com/", _canonical("http://d.org/")),
    ]
    got = {i: v[3] for i, v in _verdicts(spark, rows).items()}
    # 0-3: blocked over two links. 5-9: the allowed alias outweighs the blocked one.
    assert got == {0: "block", 1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow"}


def test_relative_and_escaped_targets(spark):
    def refresh(url):
        return f'<meta http-equiv="refresh" content="0; url={url}">'

    blocked = _canonical("http://x.net/es/1")
    cases = [("http://a{}.org/d/1?x=2", "?id=3", "/d/1?id=3"), ("http://a{}.org/d/e/1", "../x", "/d/x"), ("http://a{}.org/d/1", "index.html", "/d/index.html"),
             ("http://a{}.org", "./b/./c/..", "/b/"), ("http://a{}.org/p", "/q?a=1&amp;b=2&#38;c=&#xe9;&#8364;", "/q?a=1&b=2&c=é€"),
             ("http://a{}.org/p", "/go?u=http://c.org/", "/go?u=http://c.org/"), ("http://a{}.org/p", "http://a{}.org", "/"),
             ("http://a{}.org/p", "/amp?x=&amp;lt;&#0;&#xD800;", "/amp?x=&lt;\ufffd\ufffd")]
    rows = []
    for i, (page, target, _) in enumerate(cases):
        rows.append((page.format(i), (refresh if i % 2 == 0 else _canonical)(target.format(i))))
    rows += [(f"https://a{i}.org{path}", blocked) for i, (_, _, path) in enumerate(cases)]
    rows += [("http://b.org/1", _canonical("mailto:x@x.net")), ("http://b.org/2", refresh("#top"))]
    got = [v[3] for _, v in sorted(_verdicts(spark, rows).items())]
    assert got == ["block"] * 2 * len(cases) + ["allow"] * 2


def test_known_redirects_and_long_chains(spark):
    rows = [(f"http://h.org/{i}", None) for i in range(40)] + [("http://h.net/es/0", None)]
    chain = [(f"http://h.org/{i}", f"http://h.org/{i + 1}") for i in range(39)] + [("http://h.org/39", "http://h.net/es/0")]
    got = _verdicts(spark, rows, edges=spark.createDataFrame(chain, "src string, dst string"))
    assert {v[3] for v in got.values()} == {"block"}


def test_limits(spark):
    assert _verdicts(spark, [("http://a.com/", None)], []) == {0: ("a.com", "/", None, "allow")}
    with pytest.raises(ValueError):
        _verdicts(spark, [], [UrlRule("allow", f"h{i}", "/") for i in range(10_001)])
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert judge(pages, RULES).count() == 0
