"""Spelling variants: words one edit apart, found by a relational frontier over a trie.

1. The corpus is counted to words. An edit leaves one half of a word alone, so words are followed from their middle on, over the trie
   of all words and once more over that of all words reversed. Prefixes are nodes, named by a hash of their letters and counted in
   Spark; chains without a branch are compacted to one edge with a label of several letters (``paths.py``), so the number of
   levels is that of branching nodes, not of letters.
2. The edge table (node, label, child) stays distributed. The frontier holds states (word, position, node, edits), first every word at
   the node of its first half. Level by level it is joined with the edges on the node: a state that may still make its edit tries all
   edges of its node and takes each label as it is, with one letter replaced, one more or one less; the others follow only the
   edge that begins with their next letter. A node knows, in a mask of 64 bits, the hashes of what follows it in the words that pass it; a
   state that has made its edit must go on with one of these, and is not kept if the rest of its word cannot be among them.
3. A state that ends where a word ends, with its one edit, is a neighbour. Pairs are compared once more as words, so two prefixes
   with one hash cost time, never a result.
4. Each word's form is its most frequent neighbour, if at least twice as frequent; forms are followed to the last by pointer doubling in
   joins. Frequencies double at each step, so there is no cycle.

Nodes that many words pass are salted: a node with a share s of the words, more than one in 64, has its edges ``64 s`` times,
and its states are dealt over them by word. A word has at most some 90 neighbours for each of its letters.

Defined results: a null or empty text has no words. A null ``doc_id`` is written as nothing in the rule that deletes letters. Repeated rows
count again. An empty table gives no rows. Extra columns are not used; the result has only its own. Words may be of any length.
"""

from __future__ import annotations

from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch, map_batches, mix, table
from stratalake.llm.paths import compact

LEAST_LETTERS = 5
#: Maximal runs of letters; shorter ones are not words, with or without one letter.
LETTERS = rf"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}"
LEAST_COUNT = 3
#: One run in so many loses a letter (by hash), which plants variants.
DELETE = 97
#: Salts of a node that all words pass; a smaller share has fewer.
SALTS = 64
ROOT = 0

_STEP = np.uint64(0x9E3779B97F4A7C15)


def corpus_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, some without one letter by the hash rule, counted over all texts."""
    lower = F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    label = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    runs = docs.select(F.concat(label, F.lit(":")).alias("label"), F.explode(F.regexp_extract_all(lower, F.lit(LETTERS), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("label", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(h % DELETE == 0, shorter).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each prefix of each word, from the empty one on, and where each word's hashes begin."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    depths = np.arange(len(codes)) - np.repeat(starts[:-1], sizes) + 1
    powers = np.multiply.accumulate(np.full(int(sizes.max(initial=0)), _STEP))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers[depths - 1])))
    own = mix((sums[1:] - np.repeat(sums[starts[:-1]], sizes)) ^ mix(depths.astype(np.uint64))).view(np.int64)
    places = np.arange(len(words)) + starts[:-1]
    out = np.full(len(codes) + len(words), ROOT, np.int64)
    out[depths + np.repeat(places, sizes)] = own
    return out, places


def _anchors(batches):
    """Each word with the node of the letters that stay as they are."""
    for batch in batches:
        hashes, places = _hashes(batch.column(1).to_pylist())
        nodes = hashes[places + batch.column(2).to_numpy()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], names=["id", "word", "exact", "node"])


def _prefixes(batches):
    """A row for each letter of each word behind the fixed ones, and one for the node where they end (no letter).

    ``rest`` is the bit of the letters that follow the node (``_rest`` in Spark), ``height`` their number.
    """
    for batch in batches:
        words, exact = batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(np.int64)
        hashes, places = _hashes(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        rows = sizes - exact + 1
        starts = np.cumsum(rows) - rows
        nth = np.arange(rows.sum()) - np.repeat(starts, rows)
        depths = np.repeat(exact, rows) + nth
        at = np.repeat(places, rows) + depths
        letters = np.frombuffer("".join(" " + w[n:] for w, n in zip(words, exact.tolist())).encode("utf-32-le"), np.uint32).astype(np.int32)
        rest = [crc32(w[k:].encode()) % 64 for w, n in zip(words, exact.tolist()) for k in range(n, len(w) + 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(), rows)), pa.array(depths), pa.array(hashes[np.maximum(0, at - 1)]), pa.array(hashes[at]),
             pa.array(letters, pa.int32(), mask=nth == 0), pa.array((np.uint64(1) << np.array(rest, np.uint64)).view(np.int64)),
             pa.array(np.repeat(sizes, rows) - depths)], names=["id", "depth", "parent", "node", "letter", "rest", "height"])


def _rest(word, at):
    """The bit of the letters of a word behind the first ``at``."""
    return F.expr("1L << CAST(crc32(CAST(x AS BINARY)) % 64 AS INT)".replace("x", f"substring({word}, {at} + 1)"))


def _nodes(words: DataFrame, scratch: Scratch) -> DataFrame:
    """The nodes of all words behind their fixed letters: by how many words they are reached, who ends there and what follows."""
    rows = map_batches(words.select("id", "word", "exact"), _prefixes,
                       "id long, depth long, parent long, node long, letter int, rest long, height long")
    passes = F.col("letter").isNotNull()
    return scratch.write(rows.groupBy("node").agg(
        F.min(F.when(passes, F.col("parent"))).alias("parent"), F.min("letter").alias("letter"), F.min("depth").alias("depth"),
        F.max(F.when(F.col("height") == 0, F.col("id"))).alias("ends"), F.max(F.when(passes, F.col("id"))).alias("some"),
        F.count("letter").alias("below"), F.count("*").alias("passed"), F.max((~passes).cast("int")).alias("stops"),
        F.bit_or("rest").alias("rests"), F.max("height").alias("height")), "nodes")


def trie_edges(words: DataFrame, heavy: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, salt, first, label, size, child, child_salts, rests, height, ends) of the compacted trie of ``words`` (id, word, exact).

    ``rests`` and ``height`` are what follows the child. Nodes where words begin (behind their fixed letters) stay nodes.
    """
    letter = F.decode(F.unhex(F.lpad(F.hex("letter"), 8, "0")), "UTF-32")
    inside, is_thin = nodes.where("below > 0"), (F.col("below") == 1) & (F.col("stops") == 0)
    # Nodes of one word only, down to its end, are its tail: one edge.
    step = F.struct("depth", "parent", "node", "letter", "rests", "height")
    thin = inside.where(is_thin).groupBy(F.col("some").alias("id")).agg(F.sort_array(F.collect_list(step), asc=False).alias("steps"))
    thin = thin.join(words.select("id", "word"), "id")
    run = F.size(F.filter("steps", lambda x, i: x["depth"] + i == F.length("word")))
    thin = scratch.write(thin.withColumn("run", run), "thin")
    tails = thin.where("run > 0").select(
        F.element_at("steps", F.col("run"))["parent"].alias("node"), F.element_at("steps", F.lit(1))["node"].alias("child"),
        F.col("id").alias("ends"), F.substring("word", F.length("word") - F.col("run") + 1, F.col("run")).alias("label"),
        F.element_at("steps", F.lit(1))["rests"].alias("rests"), F.lit(0).cast("long").alias("height"))
    others = thin.where(F.size("steps") > F.col("run")).select(F.explode(F.slice("steps", F.col("run") + 1, F.size("steps"))).alias("x"))
    others = others.select("x.node", "x.parent", "x.letter", F.lit(None).cast("bigint").alias("ends"), F.lit(1).cast("bigint").alias("below"),
                           F.lit(0).alias("stops"), "x.rests", "x.height")
    thick = inside.where(~is_thin).select("node", "parent", "letter", "ends", "below", "stops", "rests", "height").union(others)
    thick = scratch.write(thick.withColumn("letter", letter), "thick")
    above = thick.where("stops = 0 AND ends IS NULL").select(F.col("node").alias("id"), F.col("below").alias("all_below"))
    links = thick.join(above, F.col("parent") == F.col("id")).where("below = all_below")
    links = scratch.write(links.select("id", F.col("node").alias("next"), F.lit(1).cast("long").alias("size")), "links")
    on_path = compact(links, scratch, "chains").withColumnRenamed("id", "node")
    placed = thick.join(on_path, "node", "left").withColumn("path", F.coalesce("path", "node")).withColumn("offset", F.coalesce("offset", F.lit(0)))
    chain = F.sort_array(F.collect_list(F.struct("offset", "letter")))
    chains = placed.groupBy("path").agg(
        F.min_by("parent", "offset").alias("node"), F.max_by("node", "offset").alias("child"), F.max("ends").alias("ends"),
        F.array_join(F.transform(chain, lambda c: c["letter"]), "").alias("label"), F.max_by("rests", "offset").alias("rests"),
        F.max_by("height", "offset").alias("height"))
    edges = tails.unionByName(chains.drop("path")).withColumn("first", F.substring("label", 1, 1))
    edges = edges.join(F.broadcast(heavy), "node", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    child = F.broadcast(heavy.select(F.col("node").alias("child"), F.col("salts").alias("child_salts")))
    return scratch.write(edges.join(child, "child", "left").select(
        "node", "salt", "first", "label", F.length("label").alias("size"), "child", F.coalesce("child_salts", F.lit(1)).alias("child_salts"),
        "rests", "height", "ends"), "salted")


def _advance(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """The states that the frontier reaches over one edge and that can end there or go on."""
    left, size = F.length("word") - F.col("at"), F.col("size")
    to = ["id", "word", "child", "child_salts", "height", "ends"]

    def taken(n):
        return F.substring("word", F.col("at") + 1, n)

    def may_follow(n):
        return F.col("rests").bitwiseAND(_rest("word", f"(at + {n})")) != 0

    moves = [(0, size, F.col("label") == taken(size))]
    moves += [(1, n, may_follow(name) & (F.levenshtein("label", taken(n), 1) == 1))
              for n, name in ((size, "size"), (size + 1, "size + 1"), (size - 1, "size - 1"))]
    options = F.array(*[F.when((left >= n) & fits, F.struct((F.col("at") + n).alias("at"), F.lit(e).alias("edits"))) for e, n, fits in moves])
    whole = frontier.where("edits = 0").join(edges, ["node", "salt"])
    whole = whole.select(*to, F.explode(F.filter(options, lambda o: o.isNotNull())).alias("s")).select(*to, "s.at", "s.edits")
    spent = frontier.where("edits = 1").withColumn("first", F.substring("word", F.col("at") + 1, F.lit(1)))
    spent = spent.join(edges, ["node", "salt", "first"]).where((F.col("label") == taken(size)) & may_follow("size")).select(
        *to, (F.col("at") + size).alias("at"), "edits")
    goes_on = (F.col("height") > 0) & ((F.col("edits") == 0) | (F.col("at") < F.length("word")))
    return whole.union(spent).withColumn("ended", F.col("ends").isNotNull() & (F.length("word") - F.col("at") + F.col("edits") == 1)).withColumn(
        "goes_on", goes_on).where("ended OR goes_on")


def _reached(words: DataFrame, total: int, scratch: Scratch, way: str) -> DataFrame:
    """(id, near): where ``words`` (id, word, exact) end with one edit that leaves their first ``exact`` letters alone."""
    nodes = _nodes(words, scratch)
    # Less than SALTS nodes of each depth.
    heavy = nodes.where(F.col("passed") * SALTS > total).select("node", F.ceil(F.col("passed") * SALTS / total).cast("int").alias("salts"))
    edges = trie_edges(words, heavy, nodes, scratch)
    begin = map_batches(words.select("id", "word", "exact"), _anchors, "id long, word string, exact int, node long")
    frontier = begin.join(F.broadcast(heavy), "node", "left").select(
        "id", "word", F.col("exact").alias("at"), "node", F.lit(0).alias("edits"),
        F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    # Words of one letter more than the fixed ones are near a word that ends at their node.
    short = begin.where(F.length("word") == F.col("exact") + 1).join(nodes.where("ends IS NOT NULL").select("node", "ends"), "node")
    parts, level = [short.select("id", F.col("ends").alias("near"))], 0
    while level == 0 or not frontier.isEmpty():
        found = scratch.write(_advance(frontier, edges), f"{way}-{level}")
        parts.append(found.where("ended").select("id", F.col("ends").alias("near")))
        frontier, level = found.where("goes_on").select(
            "id", "word", "at", F.col("child").alias("node"), "edits",
            F.pmod(F.xxhash64("id"), F.col("child_salts")).cast("int").alias("salt")), level + 1
    pairs = scratch.write(reduce(DataFrame.union, parts).distinct(), f"reached-{way}")
    scratch.drop("nodes", "thin", "thick", "links", "salted", *[f"{way}-{k}" for k in range(level)])
    return pairs


def neighbours(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, near): all pairs of ``words`` (id, word) that one inserted, deleted or replaced letter tells apart, both ways.

    An edit leaves the first or the second half of a word alone, so the words are followed from the middle to the end over
    the trie of all words, and from the middle to the begin over that of all words reversed.
    """
    total = words.count()
    if not total:
        return words.select("id", F.col("id").alias("near"))
    half = F.floor(F.length("word") / 2).cast("int")
    onward = words.select("id", "word", half.alias("exact"))
    back = words.select("id", F.reverse("word").alias("word"), (F.length("word") - half).alias("exact"))
    pairs = _reached(onward, total, scratch, "onward").union(_reached(back, total, scratch, "back")).distinct()
    own, near = words.select("id", "word"), words.select(F.col("id").alias("near"), F.col("word").alias("near_word"))
    pairs = pairs.join(own, "id").join(near, "near").where(F.levenshtein("word", "near_word", 1) == 1)
    return scratch.write(pairs.select("id", "near"), "pairs")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) from (id, form): forms are followed until there is none."""
    known = scratch.write(forms.select("id", F.coalesce("form", "id").alias("root"), F.col("form").isNull().alias("done")), "roots-0")
    step = 0
    while not known.where("NOT done").isEmpty():
        step += 1
        a, b = known.where("NOT done").alias("a"), known.alias("b")
        further = a.join(b, F.col("a.root") == F.col("b.id")).select("a.id", "b.root", "b.done")
        known = scratch.write(known.where("done").union(further), f"roots-{step}")
        scratch.drop(f"roots-{step - 1}")
    return known.select("id", "root")


def spelling_groups(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n), each word once."""
    scratch = Scratch(words.sparkSession)
    words = scratch.write(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    pairs = neighbours(words, scratch)
    near = words.select(F.col("id").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    best = pairs.join(near, "near").groupBy("id").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near_word", "near")).alias("best"))
    joined = words.join(best, "id", "left").withColumn("best_n", -F.col("best.col1"))
    taken = F.col("best_n") >= 2 * F.col("n")
    forms = scratch.write(joined.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best.near")).alias("form_id"),
        F.when(taken, F.col("best.near_word")).alias("form"), F.when(taken, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(forms.select("id", F.col("form_id").alias("form")), scratch)
    names = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    return forms.join(roots.join(names, "root"), "id").select("word", "form", F.col("root_word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent words they are variants of."""
    return spelling_groups(corpus_words(table(spark, sf_dir, "documents")))


QUERIES = {"op11_spelling_variants": op11_spelling_variants}
