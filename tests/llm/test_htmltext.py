import html
import re

import numpy as np
import pytest

from stratalake.llm import htmltext
from stratalake.llm.htmltext import ARTICLE, LONG, boilerplate, host_of, main_text, op3_main_text, page_blocks, suffix_classes
from stratalake.llm.urlfilter import split_url


def text(page):
    return " ".join(t for _, t in page_blocks(page))


@pytest.mark.parametrize("page, expected", [
    ("", ""), ("plain &lt; text", "plain < text"), ("a < b", "a < b"), ("<p>a<b>b</b>c<br>d", "abc d"),
    ("<p>&eacute;&#233;&#xe9;&amp&nosuch;</p>", "ééé&&nosuch;"), ("<p>x&nbsp; y\n\tz </p>", "x y z"),
    ("<script>var t='</p><p>no';</script><p>yes", "yes"), ("<style>p{}</style><title>t</title>ok", "ok"),
    ("<nav>menu</nav><article>body</article><footer>f</footer>", "body"),
    ("<nav>menu<article>body</article>", "body"), ("<div class='ad'>buy</div>text", "text"),
    ("<div class='header-x ReadMore'>buy</div><div class=reader>text</div>", "text"),
    ("<article><p>one<p class=ad>buy<p>two</article>", "one two"),
    ("<article>a</article><section id=comments><article>c</article></section>", "a"),
    ("<article>a<form>name <input> <p>x</form>b</article>", "a b"),
    ("<article><header><h1>Title</h1><p>by me</p></header><p>text</article>", "Title text"),
    ("<main><p>m</p></main><p>other", "m"), ("<p>cut off <a hre", "cut off"), ("<p>q <a title='>'>x</a> <i>y", "q x y"),
    ("<!-- <p>no</p> --><p>yes<!-- open", "yes"), ("<ul><li>a<li>b</ul>", "a b"), ("<article></article><p>x", "x"),
    ("<article><div>a</article></div><p>b", "a"), ("<ARTICLE>A<SCRIPT>x</SCRIPT >b</ARTICLE>", "Ab"),
    ("<p hidden>no</p><p style='display: none'>no</p>yes", "yes"), ('<p title="open>x</p><p>y', "x y"),
    ("<aside>s</aside><div role=navigation>n</div><p>x</p></aside>", "x"),
])
def test_structure(page, expected):
    assert text(page) == expected


def expected_article(page):
    """The article of the test pages, whose markup has one form."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner))
    return " ".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_query_returns_articles(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = op3_main_text(spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == expected_article(pages[r.page_id].html)


def test_suffix_classes_equal_prefixes():
    rng = np.random.default_rng(2)
    for long in (1, 2, 3, 5, 8):
        tokens = rng.integers(0, 3, 300).astype(np.int64)
        rank = suffix_classes(tokens, long)
        keys = [tuple(tokens[i : i + long]) for i in range(len(tokens))]
        order = sorted(set(keys))
        assert rank.tolist() == [order.index(k) for k in keys]


def test_repeated_runs_go_and_unique_ones_stay():
    rng = np.random.default_rng(3)
    notice = "we use small files to keep your visit going please say yes to them"
    own = [" ".join(f"w{rng.integers(10**6)}" for _ in range(40)) for _ in range(12)]
    pages = [[(0, own[k]), (0, notice), (0, f"u{k} " + own[(k + 1) % 12][:20])] for k in range(12)]
    got = boilerplate(pages, [False] * 12)
    assert got == [f"{own[k]} u{k} {own[(k + 1) % 12][:20]}" for k in range(12)]
    assert boilerplate(pages, [True] * 12) == got
    copies = [[(0, own[0])]] * 12
    assert boilerplate(copies, [True] * 12) == [own[0]] * 12 == boilerplate(copies, [False] * 12)
    near = [[(0, own[0] + f" x{k}")] for k in range(12)]
    assert boilerplate(near, [True] * 12) == [f"{own[0]} x{k}" for k in range(12)]
    assert LONG <= len(notice.split()) and ARTICLE == 2


def test_edges(spark, monkeypatch):
    rows = [(1, "http://a.b/x", None), (2, None, "<p>x"), (2, None, "<p>x"), (None, "http://a.b/y", "<article>y</article>"),
            (5, "nohost", ""), (6, "http://a.b/z", "<p>" + "word " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS Text", "2 AS host")
    for size in (1_000_000, 10):
        monkeypatch.setattr(htmltext, "CHUNK_BYTES", size)
        got = [(r.page_id, r.url, r.n_chars) for r in main_text(pages).collect()]
        assert sorted(got, key=str) == sorted([(1, "http://a.b/x", 0), (2, None, 1), (2, None, 1), (None, "http://a.b/y", 1),
                                               (5, "nohost", 0), (6, "http://a.b/z", 999_999)], key=str)
    assert main_text(pages.limit(0)).count() == 0


def test_hosts_are_judged_whole(spark, monkeypatch):
    """The size of a chunk has no influence: runs in more than the share of a host's different pages go, others stay."""
    often, seldom = "this often seen notice has nine words in all", "that seldom seen notice has nine words in all"
    rows = []
    for k in range(40):
        words = " ".join(f"w{k}x{i}" for i in range(20))
        tag = "article" if k % 4 == 0 else "p"
        rows.append((k, "http://a.b/x", f"<{tag}>{words} {often if k % 3 == 0 else ''} {seldom if k % 4 == 1 else ''} t{k}</{tag}>"))
    rows += [(100 + k, "http://a.b/x", rows[1][2]) for k in range(30)]  # copies of a page with the seldom notice
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    results = []
    for size in (10**6, 2000, 500, 10):
        monkeypatch.setattr(htmltext, "CHUNK_BYTES", size)
        results.append({r.page_id: r.text for r in main_text(pages).collect()})
    assert results[1:] == results[:1] * 3
    whole = boilerplate([page_blocks(h) for _, _, h in rows], [h.startswith("<article>") for _, _, h in rows])
    assert results[0] == {r[0]: t for r, t in zip(rows, whole)}
    assert all((often in t) == (k % 12 == 0) and (seldom in t) == (k % 4 == 1) for k, t in results[0].items() if k < 40)
    assert seldom in results[0][100]


def test_hosts_equal_the_url_filter(spark):
    urls = [None, "", "abc", "http://A.Com", "http://a.com?x/y", "x://y://z", "h://É.com/A#", "a://", "://b/c", "http://u@A.b:80/x#y"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", host_of("url").alias("h")).collect()
    assert all(r.h == split_url(r.url)[0] for r in rows)
