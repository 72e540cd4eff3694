"""Main text of web pages: page structure first, then suffix arrays over the pages of a host.

A page is cut into blocks of text. Blocks inside menus, headers, footers, sidebars, forms, scripts and the like, or
inside elements whose class, id or role says so, go. If an ``article`` is left, its blocks are
the page's; else those of ``main``; else those of the body.

What structure can't tell is told by repetition over a whole host: a run of ``LONG`` tokens that lies in enough distinct pages of the
host is boilerplate, its tokens are removed and the unique runs stay. Equal pages count once, so copies of a page do not
make it boilerplate; inside an article a run must lie in more than half of at least ``LEAST_ARTICLES`` pages and in less than half of the
article, so an article that is only copied stays whole.

The runs are found in three passes over the pages:

1. The distinct texts of a host are dealt by a hash of the text into chunks of about ``CHUNK_BYTES`` of markup (a small host is one chunk, a hot
   one many), the token streams of a chunk are concatenated, and its suffixes are ordered by their first ``LONG`` tokens. Neighbours
   that agree in all of them are a repeated substring. A run in more than a share of a host's texts is in more than
   that share of them in one chunk at least, so the runs above the share in a chunk are all that can be boilerplate.
2. These are counted over all distinct texts of the host, so the size of a chunk has no influence on the result.
3. Every page gets the runs of its host that are boilerplate, and loses them.

Defined results: a null or empty html has an empty text; a null URL is a host of its own, and so is a URL without one;
repeated rows are extracted row by row. Runs are told apart by 64-bit hashes.
"""

from __future__ import annotations

import html as entities
import re
import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch, map_batches, partitions, run_hashes, table, word_hashes

LONG = 8
CHUNK_BYTES = 1_000_000
LEAST_PAGES, LEAST_SHARE = 3, 0.3
LEAST_ARTICLES, ARTICLE_SHARE = 5, 0.5

#: HTML elements by their role.
RAW = frozenset("script style template textarea title noscript iframe xmp noembed noframes svg math".split())
SKIPPED = frozenset("nav header footer aside form button select dialog menu head fieldset datalist object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SECTIONS = frozenset("article main nav header footer aside form section body head".split())
BLOCKS = SECTIONS | SKIPPED | frozenset(
    "address blockquote center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html li ol p "
    "pre summary table tbody td tfoot th thead tr ul caption br option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role that name what is not the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification popup modal overlay newsletter subscribe subscription signup login sidebar sidebars menu menus "
    "nav navbar navigation breadcrumb breadcrumbs footer header masthead toolbar comment comments commentlist respond "
    "disqus related recommended share sharing social widget widgets pagination pager search contentinfo complementary "
    "alert disclaimer skiplink".split())
#: An element closes these open elements, as HTML leaves out their end tags.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

BODY, MAIN, ARTICLE = 0, 1, 2


def _unwanted(tag: str, attributes: str) -> bool:
    if tag in SKIPPED:
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return bool(attributes) and tag in ("article", "main") and any(
            w.lower() in ("comment", "comments") for m in _NAMED.finditer(attributes) for w in _WORD.findall(m[1]))
    if _HIDDEN.search(attributes):
        return True
    return any(w.lower() in NAMES for m in _NAMED.finditer(attributes) for w in _WORD.findall(m[1]))


def page_blocks(html: str) -> list[tuple[int, str]]:
    """Blocks of a page that structure leaves, in page order, each with its zone."""
    found: list[tuple[int, str]] = []
    words: list[str] = []
    stack: list[tuple[str, bool, int]] = []  # element, unwanted, zone
    skip, zone = False, BODY

    def flush():
        if words:
            text = " ".join("".join(words).split())
            if text:
                found.append((zone, text))
            words.clear()

    def close(at: int):
        nonlocal skip, zone
        del stack[at:]
        _, skip, zone = stack[-1] if stack else ("", False, BODY)

    at, size = 0, len(html)
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            mark = size
        if mark > at and not skip:
            words.append(entities.unescape(html[at:mark]))
        if mark == size:
            break
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        follows = html[mark + 1 : mark + 2]
        if follows in ("!", "?") or html.startswith("</", mark) and not html[mark + 2 : mark + 3].isalpha():
            end = html.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        tag = _TAG.match(html, mark) if follows.isalpha() or follows == "/" else None
        if tag is None:
            if follows.isalpha() or follows == "/":
                break  # a tag that is cut off by the end of the page
            if not skip:
                words.append("<")
            at = mark + 1
            continue
        at = tag.end()
        ending, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        name = name.lower()
        if name in BLOCKS:
            if name == "br":
                words.append(" ")
                continue
            flush()
        if ending:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if stack[k][0] in SECTIONS and name not in SECTIONS:
                    break
            continue
        if name in RAW:
            if not attributes.rstrip().endswith("/") or name not in ("svg", "math"):
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                at = end.end() if end else size
            continue
        if name in VOID or name in ("body", "html"):
            if name == "body":
                close(0)
            continue
        if name in BLOCKS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or stack[k][0] in CLOSES.get(name, ()):
                    close(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if name in ("article", "main"):
            # A menu, header or footer that was never closed ends here.
            for k, (open_name, unwanted, _) in enumerate(stack):
                if unwanted:
                    if open_name in ("nav", "header", "footer", "head"):
                        close(k)
                    break
        if name == "header" and zone == ARTICLE and not skip:
            # The header of an article: its headings stay.
            stack.append((name, True, zone))
            skip = True
            continue
        lifted = skip and name in HEADINGS and zone == ARTICLE and [e for e, s, _ in stack if s][:1] == ["header"]
        skip = (skip and not lifted) or _unwanted(name, attributes)
        zone = max(zone, ARTICLE if name == "article" and not skip else MAIN if name == "main" and not skip else BODY)
        stack.append((name, skip, zone))
    flush()
    best = max((z for z, _ in found), default=BODY)
    return [(z, text) for z, text in found if z == best]


def suffix_classes(tokens: np.ndarray, long: int = LONG) -> np.ndarray:
    """For each suffix the class of its first ``long`` tokens, in suffix order; by doubling the length compared."""
    rank, length = tokens, 1
    while length < long:
        step = min(length, long - length)
        later = np.zeros(len(rank), dtype=np.int64)
        later[:-step] = rank[step:] + 1
        rank = np.unique(rank * (int(later.max(initial=0)) + 1) + later, return_inverse=True)[1]
        length += step
    return rank


def repeated_runs(texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the runs of ``LONG`` tokens in at least ``least`` and more than ``LEAST_SHARE`` of the distinct texts, in how many, and
    how many distinct texts there are."""
    texts = list(dict.fromkeys(texts))
    names: dict[str, int] = {}
    streams = [text.split(" ") if text else [] for text in texts]
    codes = [np.fromiter((names.setdefault(w, len(names)) for w in s), dtype=np.int64, count=len(s)) for s in streams]
    # Each page ends with a token of its own, so that no substring runs over its end.
    joined = np.concatenate([np.append(c, len(names) + k) for k, c in enumerate(codes)] or [np.empty(0, np.int64)])
    if not len(names):
        return np.empty(0, np.int64), np.empty(0, np.int64), len(texts)
    owner = np.repeat(np.arange(len(codes)), [len(c) + 1 for c in codes])
    rank = suffix_classes(joined)
    pairs = np.unique(rank * len(codes) + owner)
    spread = np.bincount(pairs // len(codes), minlength=int(rank.max()) + 1)
    first = np.unique(rank, return_index=True)[1]
    ends = np.cumsum([len(c) + 1 for c in codes])
    often = (spread >= least) & (spread > LEAST_SHARE * len(texts))
    often &= first + LONG < ends[owner[first]]
    own = np.concatenate([_padded(text, len(c) + 1) for text, c in zip(texts, codes)])
    return own[first[often]], spread[often], len(texts)


def text_runs(text: str) -> np.ndarray:
    """The hash of each run of ``LONG`` tokens of a text."""
    return run_hashes(word_hashes(text.encode("utf-8", "surrogatepass")), LONG).view(np.int64)


def _padded(text: str, size: int) -> np.ndarray:
    runs = text_runs(text)
    return np.concatenate((runs, np.zeros(size - len(runs), np.int64)))


def without_runs(text: str, runs: np.ndarray, is_article: bool) -> str:
    """The text without its tokens in the given runs (hashes); an article that would lose half of them stays whole."""
    hits = np.flatnonzero(np.isin(text_runs(text), runs)) if len(runs) else runs
    if not len(hits):
        return text
    stream = text.split(" ")
    edges = np.zeros(len(stream) + 1, dtype=np.int64)
    np.add.at(edges, hits, 1)
    np.add.at(edges, hits + LONG, -1)
    covered = np.cumsum(edges[:-1]) > 0
    if is_article and 2 * covered.sum() >= len(stream):
        return text
    return " ".join(w for w, c in zip(stream, covered) if not c)


def boilerplate(pages: list[list[tuple[int, str]]], articles: list[bool]) -> list[str]:
    """The text of each page of a host without repeated runs."""
    texts = [" ".join(text for _, text in blocks) for blocks in pages]
    runs, spread, different = repeated_runs(texts, LEAST_PAGES)
    inside = runs[(spread >= LEAST_ARTICLES) & (spread > ARTICLE_SHARE * different)]
    return [without_runs(text, inside if is_article else runs, is_article) for text, is_article in zip(texts, articles)]


def host_of(url: str) -> Column:
    """The host of a URL, as ``split_url`` gives it."""
    host = F.regexp_extract(F.substr(F.col(url), F.instr(F.col(url), "://") + 3), r"^[^/?#]*", 0)
    lower = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.contains(F.col(url), F.lit("://")), lower).otherwise(F.lit(""))


def _plain(html: str | None) -> tuple[str, bool]:
    """The text that structure leaves of a page, and whether it is an article."""
    blocks = page_blocks(html or "")
    return " ".join(text for _, text in blocks), bool(blocks) and blocks[0][0] == ARTICLE


def _mark(text: str) -> int:
    """A hash that tells the texts of a host apart."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))).view(np.int64))


def _distinct(batches):
    """(host, mark, text) of each text of a host, once a task."""
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        rows = []
        for host, html in zip(*[c.to_pylist() for c in batch.columns]):
            text = _plain(html)[0]
            mark = _mark(text)
            if (host, mark) not in seen:
                seen.add((host, mark))
                rows.append((host, mark, text))
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()))],
                                         names=["host", "mark", "text"])


def _candidates(batches):
    """Stream texts sorted by chunk; the runs of a chunk that can be boilerplate are told when the next one begins."""
    texts: list[str] = []
    chunk = None

    def done():
        # What is rare in the one chunk of a host is rare in the host.
        runs, _, _ = repeated_runs(texts, LEAST_PAGES if chunk[2] == 1 else 1)
        return pa.RecordBatch.from_arrays([pa.array([chunk[0]] * len(runs), pa.string()), pa.array(runs, pa.int64())], names=["host", "run"])

    for batch in batches:
        for *own, text in zip(*[c.to_pylist() for c in batch.columns]):
            if texts and own != chunk:
                yield done()
                texts = []
            chunk = own
            texts.append(text)
    if texts:
        yield done()


def _found(batches):
    """(host, mark, runs): which runs of its host each text holds, once a task for each text."""
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        runs, starts = batch.column(2).flatten().to_numpy(), batch.column(2).offsets.to_numpy() - batch.column(2).offsets[0].as_py()
        rows = []
        for k, (host, html) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            text = _plain(html)[0]
            mark = _mark(text)
            if (host, mark) not in seen:
                seen.add((host, mark))
                rows.append((host, mark, np.intersect1d(runs[starts[k] : starts[k + 1]], text_runs(text))))
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.list_(pa.int64())))], names=["host", "mark", "runs"])


def _without(batches):
    for batch in batches:
        texts = []
        for html, own, inside in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4)]):
            text, is_article = _plain(html)
            texts.append(without_runs(text, np.array((inside if is_article else own) or [], np.int64), is_article))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def host_boilerplate(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, own, inside): the runs that are boilerplate outside and inside articles, of hosts that have some."""
    # Only hosts beyond one chunk are listed; texts of the others need no part number.
    sizes = rows.groupBy("host").agg(F.ceil(F.sum(F.octet_length("html")) / CHUNK_BYTES).alias("parts"))
    large = scratch.write(sizes.where("parts > 1"), "large-hosts")
    texts = map_batches(rows.select("host", "html"), _distinct, "host string, mark long, text string").join(large, "host", "left")
    parts = F.coalesce("parts", F.lit(1))
    dealt = texts.select("host", F.pmod("mark", parts).alias("part"), parts.alias("parts"), "text")
    dealt = dealt.repartition(partitions(rows), "host", "part").sortWithinPartitions("host", "part")
    found = map_batches(dealt, _candidates, "host string, run long").groupBy("host").agg(F.collect_set("run").alias("runs"))
    candidates = scratch.write(found, "candidates")
    held = map_batches(rows.select("host", "html").join(candidates, "host"), _found, "host string, mark long, runs array<long>")
    held = scratch.write(held.dropDuplicates(["host", "mark"]), "held")
    different = held.groupBy("host").agg(F.count("*").alias("different"))
    spread = held.select("host", F.explode("runs").alias("run")).groupBy("host", "run").agg(F.count("*").alias("n"))
    own = (F.col("n") >= LEAST_PAGES) & (F.col("n") > LEAST_SHARE * F.col("different"))
    inside = (F.col("n") >= LEAST_ARTICLES) & (F.col("n") > ARTICLE_SHARE * F.col("different"))
    common = spread.join(different, "host").where(own).groupBy("host").agg(
        F.collect_list("run").alias("own"), F.collect_list(F.when(inside, F.col("run"))).alias("inside"))
    return scratch.write(common, "boilerplate")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    scratch = Scratch(pages.sparkSession)
    rows = pages.select("page_id", "url", "html", host_of("url").alias("host"))
    common = host_boilerplate(rows, scratch)
    scratch.drop("large-hosts", "candidates", "held")
    whole = rows.join(common, "host", "left").select("page_id", "url", "html", "own", "inside")
    return map_batches(whole, _without, "page_id long, url string, text string, n_chars long")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op3_main_text": op3_main_text}
