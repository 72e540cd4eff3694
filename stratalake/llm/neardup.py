"""MinHash near-duplicates by an inverted join over signature coordinates.

1. A text's words become the set of its distinct shingles, and the set ``COORDINATES`` minimum hashes. Equal
   sets are one node, so exact copies cost one node however many they are.
2. Every node is posted under each pair (coordinate, value). Pairs of one node only are dropped;
   a node left with fewer postings than the match threshold has no partner at all.
3. Postings of a node are ordered by how rare they are. Two signatures that agree in ``t`` of ``K``
   coordinates share at least ``COLLISIONS`` of their ``K - t + COLLISIONS`` rarest postings, so only those are
   kept (prefix). The threshold ``t`` is set so that a pair at the very similarity asked for agrees less often
   with a chance below ``MISS``.
4. First every list hands out a star: its members against its most central node, the one whose postings are the most
   common ones of its family. Pairs that agree in ``t`` coordinates are confirmed on the full sets and joined to
   components, and each node is given the pivot that most others share. A group of thousands of near copies
   collapses here without its pairs ever being made.
5. What a star does not link is told by the pivot: with ``a`` and ``b`` shingles of x and y in their pivot, the two share at most
   ``min(a, b)`` of the pivot's and the shingles both have beside it. So pairs of one pivot are only made where
   they share shingles outside it (an inverted join on those) or where ``min(a, b)`` is enough by itself. The bound
   holds for any set in the pivot's place, so what many members share beside the pivot is added to it first, and
   members are compared once more, with the one that has most of this widened pivot. What a member lacks of its pivot is kept as
   ``BITS`` bits, so that ``min(a, b)`` is lowered by what one of two members lacks and the other has.
   Texts that share a passage are near one pivot only by chance, so nodes whose lists hold members of a larger pivot are
   compared with that one as well (regroup). So they are told by their shingles, not by pairs of those that only resemble each other.
   Pairs of different pivots, in different components, are made from the lists that hold both (skip); those with
   ``COLLISIONS`` common postings and ``t`` equal coordinates count. All are confirmed on the full sets.
6. Components are found with small tables of ids; a document's component is the least ``doc_id`` in it.

Confirming streams texts grouped by one side of the pair, so a task holds one set of each side at a time;
large groups are salted.

Defined results: a null text or one without words has no shingles and is linked with nothing. Rows with a
null ``doc_id`` take part; a component of such rows only has a null id. ``kept`` is whether ``doc_id`` is the
component's (null equals null). Repeated rows are copies of each other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import (Scratch, free_name, map_batches, partitions, shingle_hashes, table, text_bytes,
                                   word_hashes)
from stratalake.llm.components import components

COORDINATES = 64
COLLISIONS = 4
MISS = 1e-6
#: Texts compared with one anchor in one group before the group is split.
GROUP = 256
#: A shingle beside the pivot that so many of its members have counts as the pivot's.
POPULAR = 16
#: Bits that tell which shingles of its pivot a member lacks.
BITS = 256
#: A pivot of a larger group is taken if a node has such a part of its own shingles in common with it.
COVERED = 1 / 3

_rng = np.random.default_rng(64)
_XOR = _rng.integers(0, 2**32, COORDINATES, dtype=np.uint32)[:, None]
_ODD = (_rng.integers(0, 2**31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_LAST = np.uint32(0x9E3779B1)


def match_threshold(percent: int) -> int:
    """Most equal coordinates to ask for so that a pair at the similarity is missed with at most ``MISS``."""
    chance, below = percent / 100, 0.0
    for t in range(COORDINATES + 1):
        below += math.comb(COORDINATES, t) * chance**t * (1 - chance) ** (COORDINATES - t)
        if below > MISS:
            return t
    return COORDINATES


def shingle_set(raw: bytes | None, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; A-Z are lower-cased."""
    if not raw:
        return np.empty(0, dtype=np.uint64)
    return np.unique(shingle_hashes(word_hashes(raw.lower()), size))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of 64 hash orders over a set, in pieces of bounded size."""
    small = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for low in range(0, len(small), 4096):
        values = (small[None, low : low + 4096] ^ _XOR) * _ODD
        values ^= values >> np.uint32(15)
        values *= _LAST
        np.minimum(best, values.min(axis=1), out=best)
    return best.view(np.int32)


def _sign(size: int):
    def work(batches):
        for batch in batches:
            counts, keys, signatures = [], [], []
            for raw in text_bytes(batch.column(2)):
                shingles = shingle_set(raw, size)
                counts.append(len(shingles))
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(signature(shingles) if len(shingles) else None)
            flat = np.concatenate([s for s in signatures if s is not None] or [np.empty(0, np.int32)])
            sizes = [0 if s is None else COORDINATES for s in signatures]
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))],
                names=["doc_id", "text_key", "n_shingles", "key", "sig"])

    return work


PAIR = "a long, b long, alike boolean, common long, n_a long, n_b long, rest array<long>, lost array<long>"


def lost_bits(shingles: np.ndarray) -> np.ndarray:
    """A set as ``BITS`` bits; their number is never more than the size of the set."""
    bits = np.zeros(BITS, dtype=bool)
    bits[shingles % np.uint64(BITS)] = True
    return np.packbits(bits).view(np.int64)


def _compare(size: int, percent: int, with_rest: bool):
    """Stream texts sorted by anchor; the anchor comes first, then those to compare with it.

    ``rest`` holds the shingles of b that a has not, ``lost`` those of a that b has not, as bits.
    """

    def work(batches):
        anchor, own = None, None
        for batch in batches:
            rows: list[tuple] = []
            for a, b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                if b is None:
                    if a != anchor:
                        anchor, own = a, shingle_set(raw, size)
                elif a == anchor:
                    other = shingle_set(raw, size)
                    outside = np.setdiff1d(other, own, assume_unique=True)
                    both = len(other) - len(outside)
                    alike = 100 * both >= percent * (len(own) + len(outside))
                    lost = lost_bits(np.setdiff1d(own, other, assume_unique=True)) if with_rest else []
                    rows.append((a, b, alike, both, len(own), len(other), outside.view(np.int64) if with_rest else [], lost))
            columns = list(zip(*rows)) or [()] * 8
            types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)],
                                             names=["a", "b", "alike", "common", "n_a", "n_b", "rest", "lost"])

    return work


class _Join:
    """One run over a corpus: its tables of nodes and postings, and the steps on them."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.spark = docs.sparkSession
        self.scratch = Scratch(self.spark)
        self.docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
        self.words, self.percent = words, percent
        self.least = match_threshold(percent)
        self.prefix = COORDINATES - self.least + COLLISIONS

    def sign(self) -> None:
        schema = "doc_id long, text_key long, n_shingles long, key binary, sig array<int>"
        signed = self.scratch.write(map_batches(self.docs, _sign(self.words), schema), "signed")
        self.rows = signed.drop("sig")
        nodes = signed.where("key IS NOT NULL").groupBy("key").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"),
            F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
        self.nodes = self.scratch.write(
            nodes.select(F.monotonically_increasing_id().alias("id"), "key", "first.doc_id", "first.text_key", "n", "sig"), "nodes")

    def post(self) -> None:
        token = F.explode(F.transform("sig", lambda v, i: F.shiftleft(i.cast("long"), 32) + v.cast("long") + 2**31))
        tokens = self.nodes.select("id", "n", token.alias("token"))
        common = self.scratch.write(
            tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "common")
        shared = tokens.join(common, "token").groupBy("id", "n").agg(
            F.sort_array(F.collect_list(F.struct("df", "token"))).alias("own"), F.sum("df").alias("central"))
        kept = shared.where(F.size("own") >= self.least).select(
            "id", "n", "central", F.explode(F.slice("own", F.lit(1), F.size("own") - (COORDINATES - self.prefix))).alias("x"))
        self.postings = self.scratch.write(kept.select("id", "n", "central", F.col("x.token").alias("token")), "postings")
        self.scratch.drop("common")

    def _close(self, a, b):
        return (100 * F.least(a, b) >= self.percent * F.greatest(a, b))

    def _matching(self, pairs: DataFrame, least: int) -> DataFrame:
        """Pairs a, b whose signatures agree in at least so many coordinates."""
        sig = self.nodes.select("id", "sig")
        both = (pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
                .join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b"))
        equal = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        return both.where(equal >= least).select("a", "b")

    def confirm(self, pairs: DataFrame, label: str, with_rest: bool = False) -> DataFrame:
        """The pairs compared as full sets."""
        pairs = self.scratch.write(pairs, f"{label}-pairs")
        groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        first = ids.join(self.nodes.select("id", "doc_id", "text_key"), "id")
        docs = self.docs.alias("d")
        same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key"))
        texts = self.scratch.write(docs.join(first.alias("f"), same).select("f.id", "d.text"), f"{label}-texts")
        anchors = groups.join(texts.withColumnRenamed("id", "a"), "a").select(
            "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "text")
        others = (pairs.join(groups, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
                  .join(texts.withColumnRenamed("id", "b"), "b").select("a", "part", "b", "text"))
        dealt = (anchors.union(others).repartition(partitions(self.docs), "a", "part")
                 .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first()).select("a", "b", "text"))
        compared = map_batches(dealt, _compare(self.words, self.percent, with_rest), PAIR)
        compared = self.scratch.write(compared, f"{label}-compared")
        self.scratch.drop(f"{label}-texts", f"{label}-pairs")
        return compared

    def star(self) -> DataFrame:
        """Members of each list compared with its most central node."""
        rank = F.struct("central", (-F.col("id")).alias("id"), "n")
        heads = self.postings.groupBy("token").agg(F.max(rank).alias("head"))
        heads = heads.select("token", (-F.col("head.id")).alias("a"), F.col("head.n").alias("n_a"))
        pairs = (self.postings.join(self.scratch.write(heads, "heads"), "token")
                 .where((F.col("id") != F.col("a")) & self._close(F.col("n"), F.col("n_a")))
                 .select("a", F.col("id").alias("b")).distinct())
        return self.confirm(self._matching(pairs, min(self.least, COORDINATES // 2)), "star", with_rest=True)

    def pivots(self, compared: DataFrame, found: DataFrame, label: str = "members") -> DataFrame:
        """Each node's pivot: of the nodes it was compared with the one with most others, or the node if it is one."""
        weight = compared.groupBy("a").agg(F.count("*").alias("members"))
        of = compared.join(weight, "a").select(
            F.col("b").alias("id"), F.struct("members", "common", (-F.col("a")).alias("a")).alias("best"),
            "alike", F.col("n_b").alias("n"), F.col("n_a").alias("whole"), "rest", "lost")
        best = of.groupBy("id").agg(F.max_by(F.struct("best", "alike", "n", "whole", "rest", "lost"), "best").alias("x")).select(
            "id", (-F.col("x.best.a")).alias("pivot"), F.col("x.best.members").alias("members"),
            F.col("x.best.common").alias("common"), "x.alike", "x.n", "x.whole", "x.rest", "x.lost")
        own = compared.groupBy(F.col("a").alias("id")).agg(F.max("n_a").alias("n"), F.count("*").alias("members")).select(
            "id", F.col("id").alias("pivot"), "members", F.col("n").alias("common"), F.lit(True).alias("alike"), "n",
            F.col("n").alias("whole"), F.array().cast("array<long>").alias("rest"),
            F.array_repeat(F.lit(0).cast("long"), BITS // 64).alias("lost"))
        both = best.union(own).groupBy("id").agg(
            F.max_by(F.struct("pivot", "members", "common", "alike", "n", "whole", "rest", "lost"), F.struct("members", "common")).alias("x")).select("id", "x.*")
        return self.scratch.write(both.join(found, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component"), label)

    def regroup(self, members: DataFrame, found: DataFrame) -> DataFrame:
        """Nodes of lists with several pivots and components compared with the pivot of most members there.

        Such a pivot only groups: pairs in it are told by ``beside``, others by ``across``, whichever a node gets. A node is compared
        at most once for each of its postings.
        """
        labelled = self.scratch.write(self._mixed_lists(members, found, "regroup"), "regroup-lists")
        weight = members.groupBy(F.col("pivot").alias("p")).agg(F.max("members").alias("members"))
        heads = labelled.select("token", "p").distinct().join(weight, "p").groupBy("token").agg(
            F.max(F.struct("members", (-F.col("p")).alias("p"))).alias("head")).select("token", (-F.col("head.p")).alias("a"))
        pairs = (labelled.join(self.scratch.write(heads, "regroup-heads"), "token").where((F.col("id") != F.col("a")) & (F.col("p") != F.col("a")))
                 .groupBy("a", F.col("id").alias("b")).count().where(F.col("count") >= COLLISIONS).select("a", "b"))
        compared = self.confirm(pairs, "regroup", with_rest=True)
        return compared.where(F.col("alike") | (F.col("common") >= F.col("n_b") * COVERED))

    def _mixed_lists(self, members: DataFrame, found: DataFrame, label: str) -> DataFrame:
        """The lists that hold nodes of different pivots and components, with both."""
        labelled = (self.postings.join(members.select("id", "pivot"), "id", "left").join(found, "id", "left").select(
            "token", "id", "n", F.coalesce("pivot", "id").alias("p"), F.coalesce("component", "id").alias("c")))
        labelled = self.scratch.write(labelled, f"{label}-labelled")
        mixed = labelled.groupBy("token").agg(
            F.min("c").alias("low"), F.max("c").alias("high"), F.min("p").alias("first"), F.max("p").alias("last"))
        return labelled.join(mixed.where("low < high AND first < last").select("token"), "token", "left_semi")

    def _enough(self, common, total):
        """Whether so many common shingles suffice for sets of this total size."""
        return (100 + self.percent) * common >= self.percent * total

    def widen(self, members: DataFrame) -> DataFrame:
        """Members of pivots with several components; what many of them share beside the pivot counts as the pivot's.

        The bound of ``beside`` holds for any set in the pivot's place, so shingles in at least ``POPULAR`` members join it.
        What stays outside is in short lists only. The set is not needed itself, only how much of it a member has.
        """
        mixed = members.groupBy("pivot").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("pivot")
        group = self.scratch.write(members.join(mixed, "pivot", "left_semi"), "mixed-pivots")
        outside = self.scratch.write(group.select("pivot", F.explode("rest").alias("shingle"), "id"), "outside-all")
        popular = self.scratch.write(outside.groupBy("pivot", "shingle").agg(F.count("*").alias("held"))
                                     .where(F.col("held") >= POPULAR).select("pivot", "shingle"), "popular")
        gained = outside.join(popular, ["pivot", "shingle"]).groupBy("id").agg(F.count("*").alias("gained"))
        self.outside = self.scratch.write(outside.join(popular, ["pivot", "shingle"], "left_anti"), "outside")
        wide = group.drop("rest").join(gained, "id", "left").withColumn("gained", F.coalesce("gained", F.lit(0)))
        wide = wide.withColumn("common", F.col("common") + F.col("gained"))
        return self.scratch.write(wide, "wide")

    def second_star(self, wide: DataFrame) -> DataFrame:
        """The members outside its component compared with the one that has most of the widened pivot."""
        rank = F.struct("common", (-F.col("n")).alias("n"), (-F.col("id")).alias("id"), "c")
        best = wide.groupBy("pivot").agg(F.max(rank).alias("x")).select(
            "pivot", (-F.col("x.id")).alias("a"), (-F.col("x.n")).alias("n_a"), F.col("x.c").alias("c_a"))
        pairs = wide.join(self.scratch.write(best, "second-pivots"), "pivot").where(
            (F.col("c") != F.col("c_a")) & self._close(F.col("n"), F.col("n_a"))).select("a", F.col("id").alias("b"))
        return self.confirm(pairs, "second").where("alike").select("a", "b")

    def beside(self, wide: DataFrame, found: DataFrame) -> DataFrame:
        """Pairs of one pivot, in different components, that may still be alike."""
        group = self.scratch.write(
            wide.drop("c").join(found, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component"), "wide-now")
        outside = self.scratch.write(self.outside.join(group.select("id", "c", "n", "common"), "id"), "outside-now")
        several = outside.groupBy("pivot", "shingle").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
        lists = self.scratch.write(outside.join(several.select("pivot", "shingle"), ["pivot", "shingle"], "left_semi"), "outside-lists")
        a, b = lists.alias("a"), lists.alias("b")
        shared = (a.join(b, ["pivot", "shingle"])
                  .where((F.col("a.id") < F.col("b.id")) & (F.col("a.c") != F.col("b.c")) & self._close(F.col("a.n"), F.col("b.n")))
                  .groupBy(F.col("a.id").alias("a"), F.col("b.id").alias("b")).agg(
                      F.count("*").alias("more"), F.first(F.least("a.common", "b.common")).alias("most"),
                      F.first(F.col("a.n") + F.col("b.n")).alias("total"))
                  .where(self._enough(F.col("most") + F.col("more"), F.col("total"))).select("a", "b"))
        # Those that the pivot alone can make alike: first by the sizes that occur, then by the nodes of these sizes.
        several = group.groupBy("pivot").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.max_by("c", "common").alias("main"))
        main = self.scratch.write(several.where("low < high").select("pivot", "main"), "main-components")
        outsiders = group.join(main, "pivot").where("c <> main").select("pivot", F.col("id").alias("a"), F.col("c").alias("c_a"),
                                                        F.col("n").alias("n_a"), F.col("common").alias("common_a"),
                                                        F.col("gained").alias("gained_a"), F.col("lost").alias("lost_a"), "whole")
        sizes = group.groupBy("pivot", "n").agg(F.max("common").alias("top"))
        fits = self._enough(F.least("common_a", "top"), F.col("n_a") + F.col("n")) & self._close(F.col("n_a"), F.col("n"))
        possible = self.scratch.write(outsiders.join(sizes, "pivot").where(fits).drop("top"), "possible")
        lacking = sum((F.bit_count(F.col("lost_a")[k].bitwiseOR(F.col("lost")[k])) for k in range(BITS // 64)), F.lit(0))
        most = F.least("common_a", "common", F.col("whole") - lacking + F.least("gained_a", "gained"))
        near = (possible.join(group.select("pivot", "n", F.col("id").alias("b"), "c", "common", "gained", "lost"), ["pivot", "n"])
                .where((F.col("a") != F.col("b")) & (F.col("c_a") != F.col("c")) & self._enough(most, F.col("n_a") + F.col("n")))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        return shared.union(near)

    def across(self, members: DataFrame, found: DataFrame) -> DataFrame:
        """Pairs of different pivots and components that some lists hold together."""
        lists = self.scratch.write(self._mixed_lists(members, found, "across"), "lists")
        groups = lists.select("token", "p").distinct()
        two = (groups.join(groups.withColumnRenamed("p", "q"), "token").where("p < q"))
        a = lists.select("token", "p", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("c").alias("c_a"))
        b = lists.select("token", F.col("p").alias("q"), F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("c").alias("c_b"))
        return (two.join(a, ["token", "p"]).join(b, ["token", "q"])
                .where((F.col("c_a") != F.col("c_b")) & self._close(F.col("n_a"), F.col("n_b")))
                .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).count()
                .where(F.col("count") >= COLLISIONS).select("a", "b"))

    def run(self) -> DataFrame:
        self.sign()
        self.post()
        compared = self.star()
        links = self.scratch.write(compared.where("alike").select("a", "b"), "links")
        found = self.scratch.write(components(links, self.scratch, "star"), "found")
        members = self.pivots(compared, found)
        again = self.regroup(members, found)
        if not again.isEmpty():
            alike = again.where("alike").select("a", "b")
            if not alike.isEmpty():
                links = self.scratch.write(links.union(alike), "links-1")
                found = self.scratch.write(components(links, self.scratch, "regroup"), "found-1")
            members = self.pivots(compared.union(again), found, "members-1")
        wide = self.widen(members)
        second = self.second_star(wide)
        if not second.isEmpty():
            links = self.scratch.write(links.union(second), "links-2")
            found = self.scratch.write(components(links, self.scratch, "second"), "found-2")
        more = self._matching(self.across(members, found), self.least).union(self.beside(wide, found)).distinct()
        more = self.confirm(more, "more").where("alike").select("a", "b")
        if not more.isEmpty():
            found = self.scratch.write(components(links.union(more), self.scratch, "all"), "found-all")
        groups = self.nodes.join(found, "id", "left").select(
            "key", "doc_id", F.coalesce("component", "id").alias("group"))
        least = groups.groupBy("group").agg(F.min("doc_id").alias("component_id"))
        classes = self.scratch.write(groups.join(least, "group").select("key", "group", "component_id"), "classes")
        self.scratch.drop("nodes", "postings", "heads", "star-compared", "members", "regroup-labelled", "regroup-lists", "regroup-heads",
                          "regroup-compared", "members-1", "links-1", "found-1", "mixed-pivots", "outside-all",
                          "popular", "outside", "outside-now", "outside-lists", "wide", "wide-now", "second-pivots", "second-compared",
                          "main-components", "possible", "across-labelled", "lists", "more-compared", "links", "links-2", "found", "found-2")
        named = self.rows.where("key IS NOT NULL").join(classes, "key").select(
            "doc_id", "text_key", "n_shingles", "group", "component_id")
        bare = self.rows.where("key IS NULL").select(
            "doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("group"), F.col("doc_id").alias("component_id"))
        return named.union(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """A row per document: doc_id, text_key, n_shingles, group, component_id, kept.

    Documents are linked if their sets of ``words``-word shingles have at least ``percent`` percent in
    common; ``group`` numbers the components and is null without words.
    """
    return _Join(docs, words, percent).run()


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each component the row with the least doc_id, whole.

    Texts without words stay. Ties between equal ids go to the least hash of the text, and of equal
    rows one stays.
    """
    found = near_duplicates(docs, words, percent)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    least = found.where("`group` IS NOT NULL").groupBy("group").agg(F.min(rank).alias("m"))
    one = free_name(docs, "_one")
    stays = least.select(F.col("m.doc_id").alias("_id"), F.col("m.text_key").alias("_key"), F.lit(True).alias(one))
    bare = found.where("`group` IS NULL").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    scratch = Scratch(docs.sparkSession)
    chosen = scratch.write(stays.union(bare.withColumn(one, F.lit(False))), "chosen")
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    same = F.col("d.doc_id").eqNullSafe(F.col("c._id")) & (F.xxhash64(F.col("d.text")) == F.col("c._key"))
    joined = docs.alias("d").join(chosen.alias("c"), same)
    repeated = scratch.write(found.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"), "repeated")
    again = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.xxhash64(F.col("d.text")) == F.col("r.text_key"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    single = joined.select(*columns, F.col(f"c.`{one}`")).alias("d").join(repeated.alias("r"), again, "left_anti").select(*columns)
    if repeated.isEmpty():
        return single
    several = joined.select(*columns, F.col(f"c.`{one}`")).alias("d").join(repeated.alias("r"), again, "left_semi")
    kept = several.where(F.col(one)).dropDuplicates(["doc_id", "text"]).select(*own)
    return single.union(kept).union(several.where(~F.col(one)).select(*own))


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their three-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


QUERIES = {"op1_near_duplicates": op1_near_duplicates}
