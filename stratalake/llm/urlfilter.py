"""URL filters: all glob rules are simulated at once, bit by bit, over each canonical URL.

A URL's canonical form is ``.`` + host (A-Z lower-cased) + path; query and fragment go. A glob is
matched against the whole of it: ``*`` stands for any bytes but ``/``, ``**`` for any bytes, ``?``
for one byte but ``/``; anything else stands for itself. Every pattern owns a run of bits in a
multiword mask, one bit per literal or ``?``, plus one for the state before its first symbol. Per
byte of the URL the state words are shifted left by one (the top bit carries over into the next
word), masked with the words of that byte, and joined with the bits whose state may stay where it
is. All patterns and all URLs of a batch advance together.

Defined results: a null URL, or one without ``://``, has empty host and path and is judged like
any other; repeated rows are judged row by row; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stratalake.llm.common import add_columns, table

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class PathRule:
    """A host and a path prefix; fits the host and its subdomains."""

    verdict: str
    rule: str

    @property
    def glob(self) -> str:
        return f"*.{self.rule}**"


@dataclass(frozen=True)
class GlobRule:
    """A free glob over the canonical URL, used where no path rule fits."""

    verdict: str
    glob: str

    @property
    def rule(self) -> str:
        return self.glob


#: The rules of the query.
PATH_RULES = (
    PathRule(ALLOW, "com/"),
    PathRule(BLOCK, "example.com/en/"),
    PathRule(ALLOW, "www.example.com/en/"),
    PathRule(BLOCK, "net/es/"),
    PathRule(BLOCK, "net/fr/"),
)

#: The method's own globs: hosts that sell pills, bets or games, adult and advertising hosts,
#: and machine-made paths.
OWN_GLOBS = (
    GlobRule(BLOCK, "*pills*/**"),
    GlobRule(BLOCK, "*casino*/**"),
    GlobRule(BLOCK, "*-bets.*/**"),
    GlobRule(BLOCK, "*.adult*/**"),
    GlobRule(BLOCK, "*.ads-*/**"),
    GlobRule(BLOCK, "*.spam-*/**"),
    GlobRule(BLOCK, "**/wp-admin/**"),
    GlobRule(BLOCK, "**/cgi-bin/**"),
)


class ShiftAnd:
    """The masks of a set of globs and their simulation."""

    def __init__(self, globs: Sequence[str]):
        symbols: list[tuple[object, bool, bool]] = []  # what is read, any bytes after it, all but / after it
        self.first: list[int] = []
        self.last: list[int] = []
        for glob in globs:
            parts = re.findall(rb"\*\*+|\*|\?|[^*?]", glob.encode(), re.S)
            self.first.append(len(symbols))
            states: list[list] = [[None, False, False]]
            for part in parts:
                if part == b"*":
                    states[-1][2] = True
                elif part.startswith(b"**"):
                    states[-1][1] = True
                else:
                    states.append([part, False, False])
            symbols.extend(tuple(s) for s in states)
            self.last.append(len(symbols) - 1)
        self.words = max(1, -(-len(symbols) // 64))
        self.step = np.zeros((256, self.words), dtype=np.uint64)
        self.stay = np.zeros((256, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        for position in self.first:
            self._set(self.start, position)
        for position, (symbol, anything, segment) in enumerate(symbols):
            for byte in range(256):
                if symbol is not None and (byte == symbol[0] if symbol != b"?" else byte != 0x2F):
                    self._set(self.step[byte], position)
                if anything or segment and byte != 0x2F:
                    self._set(self.stay[byte], position)

    @staticmethod
    def _set(mask: np.ndarray, position: int) -> None:
        mask[position // 64] |= np.uint64(1 << (position % 64))

    def matches(self, urls: Sequence[bytes]) -> np.ndarray:
        """A row per URL, a column per glob."""
        lengths = np.array([len(u) for u in urls], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(urls), dtype=np.uint8)
        offsets = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(urls) else lengths
        at, ordered = offsets[order], lengths[order]
        state = np.tile(self.start, (len(urls), 1))
        one, top = np.uint64(1), np.uint64(63)
        live, place = len(urls), 0
        while True:
            while live and ordered[live - 1] <= place:
                live -= 1
            if not live:
                break
            byte = data[at[:live] + place]
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = moved & self.step[byte] | now & self.stay[byte]
            place += 1
        found = np.zeros((len(urls), len(self.last)), dtype=bool)
        for column, position in enumerate(self.last):
            bit = np.uint64(1 << (position % 64))
            found[order, column] = (state[:, position // 64] & bit) != 0
        return found


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; both empty without ``://``."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    end = re.search(r"[/?#]", rest)
    host = rest[: end.start()] if end else rest
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]+", lambda m: m[0].lower(), host)
    return host, path


FIELDS = {name: pa.string() for name in ("host", "path", "rule", "verdict", "own_glob")}


def filter_urls(df: DataFrame, url: str = "url", path_rules: Sequence[PathRule] = PATH_RULES,
                own_globs: Sequence[GlobRule] = OWN_GLOBS) -> DataFrame:
    """The frame with ``host``, ``path``, ``rule``, ``verdict`` and ``own_glob``.

    ``rule`` is the longest path rule that fits, else null. ``own_glob`` is the first of the
    method's globs that fits. The verdict is that of the rule, else of the glob, else ``allow``.
    Columns of these names that the frame already has are replaced.
    """
    ranked = sorted(path_rules, key=lambda r: (-len(r.rule), r.rule))
    automaton = ShiftAnd([r.glob for r in (*ranked, *own_globs)])

    def judge(urls):
        parts = [split_url(u) for u in urls]
        found = automaton.matches([f".{host}{path}".encode() for host, path in parts])
        rules, verdicts, globs = [], [], []
        for row in found:
            fits = next((r for r, hit in zip(ranked, row) if hit), None)
            glob = next((g for g, hit in zip(own_globs, row[len(ranked) :]) if hit), None)
            rules.append(fits.rule if fits else None)
            globs.append(glob.glob if glob else None)
            verdicts.append((fits or glob).verdict if fits or glob else ALLOW)
        return [[h for h, _ in parts], [p for _, p in parts], rules, verdicts, globs]

    return add_columns(df, url, FIELDS, judge)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the URL of every page."""
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


SQL = """
WITH parts AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN regexp_replace(substr(url, strpos(url, '://') + 3), '[/?#](.|\\n)*$', '') ELSE '' END AS raw_host,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), urls AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_replace(substr(rest, length(raw_host) + 1), '[?#](.|\\n)*$', '') AS path
  FROM parts
), ruled AS (
  SELECT *, '.' || host AS h,
    CASE WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
         WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
    CASE WHEN path = '' THEN NULL
         WHEN contains(host, 'pills') THEN '*pills*/**'
         WHEN contains(host, 'casino') THEN '*casino*/**'
         WHEN contains(host, '-bets.') THEN '*-bets.*/**'
         WHEN contains('.' || host, '.adult') THEN '*.adult*/**'
         WHEN contains('.' || host, '.ads-') THEN '*.ads-*/**'
         WHEN contains('.' || host, '.spam-') THEN '*.spam-*/**'
         WHEN contains(path, '/wp-admin/') THEN '**/wp-admin/**'
         WHEN contains(path, '/cgi-bin/') THEN '**/cgi-bin/**' END AS own_glob
  FROM urls
)
SELECT page_id, host, path, rule, own_glob,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN own_glob IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

QUERIES = {"op2_url_filter": op2_url_filter}
ORACLES = {"op2_url_filter": SQL}
