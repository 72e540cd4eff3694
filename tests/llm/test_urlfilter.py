import re

import pytest

from stratalake.llm.urlfilter import BLOCK, GlobRule, PathRule, ShiftAnd, filter_urls, split_url


def as_regex(glob):
    out = ""
    for part in re.findall(r"\*\*+|\*|\?|[^*?]", glob, re.S):
        out += {"*": "[^/]*", "?": "[^/]"}.get(part, ".*" if part.startswith("**") else re.escape(part))
    return re.compile(out, re.S)


def test_automaton_equals_regexes():
    globs = ["*.com/**", "**x?y**", "", "*", "**", "a*b*c", "?" * 70 + "**", "**" + "ab" * 40, "*.example.com/en/**"]
    urls = ["", ".a.com/", ".com", "xay", "x/y", "abc", "a/bc", "aXbYc", "q" * 69, "q" * 71, "z" + "ab" * 40,
            ".www.example.com/en/1", ".example.com/de/", "/" * 100, "é.com/x"]
    found = ShiftAnd(globs).matches([u.encode() for u in urls])
    for u, row in zip(urls, found):
        for g, hit in zip(globs, row):
            assert bool(hit) == bool(as_regex(g).fullmatch(u)), (g, u)


@pytest.mark.parametrize("url, parts", [
    (None, ("", "")), ("", ("", "")), ("abc", ("", "")), ("http://A.Com", ("a.com", "")),
    ("http://a.com?x/y", ("a.com", "")), ("http://a.com/p?q#r", ("a.com", "/p")), ("x://y://z", ("y:", "//z")),
    ("h://É.com/A#", ("É.com", "/A")),
])
def test_split(url, parts):
    assert split_url(url) == parts


def test_rules_and_edges(spark):
    rows = [(1, "http://www.Example.com/en/x"), (2, "http://a.example.com/en/x"), (3, "http://b.net/es/"),
            (4, None), (5, "http://x.cheap-pills.org/a"), (5, "http://x.cheap-pills.org/a"), (None, "https://a.com"),
            (7, "https://a.com/" + "p" * 5000), (8, "http://fooexample.com/en/"), (9, "http://c.org/b.net/es/")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS verdict", "1 AS Host")
    out = filter_urls(df)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "own_glob"]
    got = [(r.page_id, r.rule, r.verdict) for r in out.collect()]
    assert sorted(got, key=str) == sorted([
        (1, "www.example.com/en/", "allow"), (2, "example.com/en/", "block"), (3, "net/es/", "block"),
        (4, None, "allow"), (5, None, "block"), (5, None, "block"), (None, None, "allow"), (7, "com/", "allow"),
        (8, "com/", "allow"), (9, None, "allow")], key=str)
    assert filter_urls(df.limit(0)).count() == 0


def test_own_rules(spark):
    df = spark.createDataFrame([("http://a.b/c",), ("http://a.b/d",)], "u string")
    out = filter_urls(df, "u", [PathRule(BLOCK, "b/c")], [GlobRule(BLOCK, "**/d")])
    assert [r.verdict for r in out.collect()] == ["block", "block"]
