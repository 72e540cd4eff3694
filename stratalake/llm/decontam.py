"""Benchmark decontamination by pigeonhole edit matching.

Documents and test items are brought to one form: lower case, no ASCII punctuation, one space between words. An
item of ``n`` bytes may differ from a passage in ``e = n // PIECE - 1`` edits. It is split into ``e + 1`` pieces; in a passage
within that budget at least one piece is untouched. All pieces of a block of items are searched at once with an
Aho-Corasick automaton over each whole document; a hit tells where the item would lie, hits of an item that
agree on this within the budget are one candidate, and each candidate is verified with Myers' bit-parallel distance over
the passage and the budget on both sides. Items shorter than ``LEAST`` bytes allow no edit and must stand there as whole words.

Items are held in blocks of about ``BLOCK_BYTES`` of text; each block is matched against all
documents, so the benchmark may be of any size. Only items are on the driver, one block at a time.

Defined results: a null text matches nothing; items without text, or without a word in that form, are evidence of nothing and are
left out; items of equal form are reported under each id; items without an id count when documents are filtered and are
reported with a null id on request; repeated rows are matched row by row.
"""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import add_columns, free_name, share, table

PIECE = 16
LEAST = 32
BLOCK_BYTES = 8_000_000

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_MARKS = string.punctuation.encode()

Items = tuple[tuple[int | None, str], ...]
Hit = tuple[int | None, int, int, int]


def _by_id(entry: tuple) -> tuple:
    """The order of items and hits, those without an id first."""
    return entry[0] is not None, entry[0] or 0, *entry[1:]


def plain(text: str) -> str:
    """The compared form of a text, one character a byte."""
    raw = text.lower().encode("utf-8", "replace").translate(_LOWER, _MARKS)
    return b" ".join(raw.split()).decode("latin-1")


def budget(item: str) -> int:
    """Edits allowed in an item."""
    return max(0, len(item) // PIECE - 1)


def pieces(item: str) -> list[tuple[int, str]]:
    """One piece more than edits allowed, with their places; together they are the item."""
    count = budget(item) + 1
    edges = [len(item) * k // count for k in range(count + 1)]
    return [(low, item[low:high]) for low, high in zip(edges, edges[1:])]


class Myers:
    """The bit-parallel distance of one item to the best passage of a text."""

    def __init__(self, item: str):
        self.size = len(item)
        self.full = (1 << self.size) - 1
        self.top = 1 << (self.size - 1)
        self.equal: dict[str, int] = {}
        for k, c in enumerate(item):
            self.equal[c] = self.equal.get(c, 0) | 1 << k

    def best(self, text: str) -> tuple[int, int]:
        """The least distance of the item to any passage of the text, and where that ends first."""
        plus, minus, score, best, end = self.full, 0, self.size, self.size, 0
        full, top, equal = self.full, self.top, self.equal.get
        for k, c in enumerate(text, 1):
            eq = equal(c, 0)
            vertical = eq | minus
            horizontal = (((eq & plus) + plus) ^ plus) | eq
            up = minus | full & ~(horizontal | plus)
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = up << 1 & full
            down = down << 1 & full
            plus = down | full & ~(vertical | up)
            minus = up & vertical
            if score < best:
                best, end = score, k
        return best, end


class Matcher:
    """The automaton over the pieces of a block of items."""

    def __init__(self, items: Items):
        import ahocorasick

        self.items = [text for _, text in items]
        self.ids = [number for number, _ in items]
        self.budgets = [budget(t) for t in self.items]
        self.verify: dict[int, Myers] = {}
        where: dict[str, list[tuple[int, int]]] = {}
        for k, text in enumerate(self.items):
            for place, piece in pieces(text):
                where.setdefault(piece, []).append((k, place))
        self.automaton = ahocorasick.Automaton()
        for piece, found in where.items():
            self.automaton.add_word(piece, (len(piece), found))
        if where:
            self.automaton.make_automaton()

    def _myers(self, k: int) -> Myers:
        if k not in self.verify:
            self.verify[k] = Myers(self.items[k])
        return self.verify[k]

    def find(self, text: str | None) -> list[Hit]:
        """Item id, least distance, and about where in the compared form, of each item found."""
        if not text or not self.items:
            return []
        form = plain(text)
        starts: dict[int, set[int]] = {}
        exact: dict[int, int] = {}
        for last, (size, found) in self.automaton.iter(form):
            for k, place in found:
                start = last + 1 - size - place
                if len(self.items[k]) >= LEAST:
                    starts.setdefault(k, set()).add(start)
                elif k not in exact and form[start - 1 : start] in ("", " ") and form[last + 1 : last + 2] in ("", " "):
                    exact[k] = start
        hits = [(self.ids[k], 0, start, start + len(self.items[k])) for k, start in exact.items()]
        for k, places in starts.items():
            allowed, size = self.budgets[k], len(self.items[k])
            best = None
            low = high = None
            for start in [*sorted(places), None]:
                if low is not None and (start is None or start > high + allowed):
                    first = max(0, low - allowed)
                    distance, end = self._myers(k).best(form[first : high + size + allowed])
                    if distance <= allowed and (best is None or distance < best[0]):
                        best = distance, max(0, first + end - size), first + end
                    low = None
                if start is None or best is not None and best[0] == 0:
                    break
                low, high = (start, start) if low is None else (low, start)
            if best is not None:
                hits.append((self.ids[k], *best))
        return sorted(hits, key=_by_id)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", unnamed: bool = False):
    """The usable items, block by block; those without an id only if ``unnamed``."""
    rows = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.dropna(subset=["text"] if unnamed else None).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        found = [(r["item_id"], plain(r["text"])) for r in rows.where(part == k).collect()]
        items = tuple(sorted(((i, form) for i, form in found if form), key=_by_id))
        if items:
            yield items


HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def find_items(df: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None,
               name: str = "hits", unnamed: bool = False) -> DataFrame:
    """The frame (or its columns ``keep``) with an array of the items found in each text.

    With ``unnamed`` items without an id are found too. An entry has item_id, distance, and start and end in the compared form. A column of that name is replaced.
    """
    spark = df.sparkSession
    columns = [c for c in (df.columns if keep is None else keep) if c.lower() != name.lower()]
    source = free_name(df, "_to_match")
    out = df.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias(source))
    found = []
    for items in blocks(benchmark, unnamed=unnamed):
        shared = share(spark, items)

        def matching(shared=shared):
            matcher = Matcher(shared.value)
            keys = ("item_id", "distance", "start", "end")
            return lambda texts: [[[dict(zip(keys, hit)) for hit in matcher.find(t)] for t in texts]]

        found.append(free_name(out, f"_hits{len(found)}"))
        out = add_columns(out, source, {found[-1]: HITS}, matching, per_task=True)
    empty = F.array().cast("array<struct<item_id:bigint,distance:bigint,start:bigint,end:bigint>>")
    hits = F.concat(*[F.col(f) for f in found]) if found else empty
    return out.select(*[F.col(f"`{c}`") for c in columns], hits.alias(name))


def clean_documents(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no item, with an id or without."""
    name = free_name(df, "_found")
    return find_items(df, benchmark, text, name=name, unnamed=True).where(F.size(name) == 0).drop(name)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with each item and its distance."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_items(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"], unnamed=True)
    return found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.item_id", "h.distance")


QUERIES = {"op6_decontamination": op6_decontamination}
