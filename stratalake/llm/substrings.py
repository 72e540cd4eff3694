"""Long repeated substrings by De Bruijn compaction.

The graph's edges are the k-mers of words, k the window length, that occur more than once; two follow each other where they
overlap by all but one word. Finding the repeated ones does not need every k-mer in a shuffle:

1. Every window has an anchor, its run of ``anchor`` words with the least hash (the leftmost of equals). Equal windows
   have equal anchors at the same place, so a window can only repeat where its anchor occurs again. Anchors are
   counted by hash (a long for each), the rest of the text stays where it is.
2. Consecutive windows with one anchor form a stretch. Stretches whose anchor repeats travel once, as (text key, place,
   anchor hash, one 32-bit print for each window), and equal ones are counted together before anything else is done,
   so a passage copied a million times is a few rows.
3. Windows are counted by (anchor hash, print), 96 bits; those that start at two places or more are the edges. Maximal runs of
   edges in a stretch are compacted on the spot to pieces, named by a 128-bit hash of their words' prints.
4. Pieces that follow each other in some text are linked, and nonbranching paths of pieces are compacted by pointer
   doubling in joins (``paths.py``): each piece gets its path and its offset there.
5. Source coordinates verify the paths: pieces are brought back to the places (text, word) where their windows were counted, and
   only those that lie side by side in a text and in their path are one span; the others start a new one.

Texts are identified by their MD5, so equal texts are worked on once and counted as often as they occur. No step groups the
occurrences of a key in one task: hot keys only pass through partial aggregates and joins whose other side is unique
(which adaptive execution splits).

Defined results: a null or empty text has no words and no span; a text shorter than the window has no window. Rows
with a null ``doc_id`` and repeated rows take part like all others (a repeated row is a repeated text). Extra
columns pass through ``remove_repeats``; those named like its results are replaced by them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import (Scratch, add_columns, free_name, map_batches, mix, run_hashes, table, text_bytes,
                                   word_bounds, word_hashes)
from stratalake.llm.paths import compact, nonbranching

WINDOW = 35
#: Anchors with more than this part (one in so many) of all repeated anchors are split.
HOT = 1000
_PRINT = np.uint64(0x2545F4914F6CDD1D)


def anchor_words(window: int) -> int:
    """Words of an anchor: about a third of a window, and so many that a stretch has at most 62 windows."""
    return max(1, -(-window // 3), window - 61)


def stretches(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window and anchor hash of each stretch of a text, and the print of every window."""
    size = anchor_words(window)
    if len(words) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    grams = run_hashes(words, size)
    near = np.lib.stride_tricks.sliding_window_view(grams, window - size + 1)
    place = near.argmin(axis=1) + np.arange(len(near))
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    prints = (mix(run_hashes(words, window) ^ _PRINT) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return first, grams[place[first]].view(np.int64), prints


def _anchors(window: int):
    def work(batches):
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for raw in text_bytes(batch.column(0)):
                if raw:
                    found.append(stretches(word_hashes(raw), window)[1])
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], names=["anchor", "n"])

    return work


def _stretches(window: int):
    def work(batches):
        for batch in batches:
            keys, starts, anchors, prints, sizes = [], [], [], [], []
            for key, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                if not raw:
                    continue
                first, anchor, own = stretches(word_hashes(raw), window)
                keys += [key] * len(first)
                starts.append(first)
                anchors.append(anchor)
                prints.append(own)
                sizes.append(np.diff(np.append(first, len(own))))
            ends = np.concatenate([np.zeros(1, np.int64), *sizes]).cumsum().astype(np.int32)
            flat = np.concatenate(prints or [np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(np.concatenate(starts or [np.empty(0, np.int64)]), pa.int64()),
                 pa.array(np.concatenate(anchors or [np.empty(0, np.int64)]), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["key", "start", "anchor", "prints"])

    return work


def _pieces(batches):
    """Runs of set bits of each stretch, with a name made of the anchor and the prints of the run."""
    for batch in batches:
        rows = []
        columns = [batch.column(k).to_pylist() for k in range(4)]
        for stretch, anchor, prints, mask in zip(*columns):
            at, size = 0, len(prints)
            while at < size:
                if not mask >> at & 1:
                    at += 1
                    continue
                end = at + 1
                while end < size and mask >> end & 1:
                    end += 1
                name = hashlib.blake2b(np.array([anchor, *prints[at:end]], np.int64).tobytes(), digest_size=16).digest()
                rows.append((stretch, at, end - at, name))
                at = end
        made = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(made, kinds)],
                                         names=["stretch", "at", "size", "piece"])


def text_key(text: str = "text"):
    return F.unhex(F.md5(F.col(f"`{text}`").cast("binary")))


def repeated_spans(docs: DataFrame, window: int = WINDOW, text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(key, start, n_words, path, path_offset): maximal stretches of repeated windows on one path, by text key.

    ``start`` counts words from 0; ``n_words`` includes the last window's whole length. Spans of one text may overlap or
    touch where paths meet.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    texts = docs.where(F.col(f"`{text}`").isNotNull()).select(text_key(text).alias("key"), F.col(f"`{text}`").alias("text"))

    counted = map_batches(texts.select("text"), _anchors(window), "anchor long, n long")
    again = scratch.write(counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"), "anchors")
    found = map_batches(texts, _stretches(window), "key binary, start long, anchor long, prints array<int>")
    # An anchor with more than one part in ``HOT`` of all is dealt over several tasks; there are less than ``HOT`` of them.
    total = again.agg(F.sum("n")).first()[0] or 1
    hot = again.where(F.col("n") * HOT > total).select("anchor", F.ceil(F.col("n") * HOT / total).cast("int").alias("salts"))
    hot = F.broadcast(hot)
    salt = F.pmod(F.xxhash64("key", "start"), F.coalesce("salts", F.lit(1))).cast("int")
    found = found.join(hot, "anchor", "left").withColumn("salt", salt)
    again = again.join(hot, "anchor", "left").select("anchor", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    # Rows of one anchor and salt lie together after the join, so copies of a text are counted there before they travel on.
    found = found.join(again, ["anchor", "salt"], "left_semi").groupBy("key", "start", "anchor", "salt", "prints").agg(
        F.count("*").alias("copies"))
    places = scratch.write(found.drop("salt").withColumn("mark", F.xxhash64("prints")), "places")

    distinct = places.groupBy("anchor", "mark", "prints").agg(F.sum("copies").alias("copies"))
    distinct = scratch.write(distinct.select(F.monotonically_increasing_id().alias("stretch"), "*"), "stretches")
    scratch.drop("anchors")
    windows = distinct.select("stretch", "anchor", "copies", F.posexplode("prints").alias("at", "print"))
    edges = scratch.write(windows.groupBy("anchor", "print").agg(F.sum("copies").alias("n")).where("n > 1").select("anchor", "print"), "edges")
    whole = distinct.where("copies > 1").selectExpr("stretch", "shiftleft(1L, size(prints)) - 1L AS mask")
    part = (windows.where("copies = 1").join(edges, ["anchor", "print"], "left_semi")
            .groupBy("stretch").agg(F.sum(F.expr("shiftleft(1L, at)")).alias("mask")))
    masks = scratch.write(whole.union(part), "masks")
    pieces = map_batches(distinct.join(masks, "stretch").select("stretch", "anchor", "prints", "mask"), _pieces,
                         "stretch long, at long, size long, piece binary")
    named = distinct.select("stretch", "anchor", "mark").join(
        pieces.groupBy("stretch").agg(F.collect_list(F.struct("at", "size", "piece")).alias("pieces")), "stretch")
    located = places.select("key", "start", "anchor", "mark").join(named.drop("stretch"), ["anchor", "mark"])
    located = located.select("key", "start", F.explode("pieces").alias("p")).select(
        "key", (F.col("start") + F.col("p.at")).alias("start"), F.col("p.size").alias("size"), F.col("p.piece").alias("piece"))
    in_text = Window.partitionBy("key").orderBy("start")
    follows = F.when(F.lead("start").over(in_text) == F.col("start") + F.col("size"), F.lead("piece").over(in_text))
    located = located.withColumn("next", follows)
    goes_on = F.coalesce(F.lead("next").over(in_text).isNotNull(), F.lit(False))
    came_from = F.coalesce(F.lag("next").over(in_text).isNotNull(), F.lit(False))
    located = scratch.write(located.withColumn("goes_on", goes_on).withColumn("came_from", came_from), "located")
    scratch.drop("edges", "masks", "stretches", "places")

    steps = located.where("next IS NOT NULL").groupBy(F.col("piece").alias("id"), "next").agg(
        F.max("goes_on").alias("goes_on"), F.max("came_from").alias("came_from"), F.first("size").alias("size"))
    steps = scratch.write(steps, "steps")
    links = scratch.write(nonbranching(steps).join(steps, ["id", "next"]).select("id", "next", "size"), "links")
    on_path = scratch.write(compact(links, scratch, "paths"), "on-path").withColumnRenamed("id", "piece")
    placed = located.join(on_path, "piece", "left").select(
        "key", "start", "size", F.coalesce("path", "piece").alias("path"), F.coalesce("offset", F.lit(0)).alias("offset"))
    fresh = ((F.lag("path").over(in_text) != F.col("path"))
             | (F.lag("start").over(in_text) + F.lag("size").over(in_text) != F.col("start"))
             | (F.lag("offset").over(in_text) + F.lag("size").over(in_text) != F.col("offset")))
    numbered = placed.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("long")).withColumn("span", F.sum("fresh").over(in_text))
    spans = numbered.groupBy("key", "span").agg(
        F.min("start").alias("start"), (F.sum("size") + window - 1).alias("n_words"),
        F.min_by("path", "start").alias("path"), F.min("offset").alias("path_offset"))
    return spans.drop("span")


def _cut(rows: list) -> list[list]:
    words, removed, kept = [], [], []
    for row in rows:
        text, spans = row["text"], row["spans"]
        if text is None:
            words.append(0), removed.append(0), kept.append("")
            continue
        raw = text.encode()
        starts, ends = word_bounds(np.frombuffer(raw, np.uint8))
        edge = np.zeros(len(starts) + 1, np.int64)
        for span in spans or ():
            edge[span["start"]] += 1
            edge[span["start"] + span["n_words"]] -= 1
        stays = np.flatnonzero(edge[:-1].cumsum() == 0)
        words.append(len(starts))
        removed.append(len(starts) - len(stays))
        if len(stays) == 0:
            kept.append("")
        else:
            kept.append(b" ".join([raw[a:b] for a, b in zip(starts[stays].tolist(), ends[stays].tolist())]).decode())
    return [words, removed, kept]


def remove_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``: the words that no repeated window covers, joined by a space."""
    scratch = Scratch(docs.sparkSession)
    spans = repeated_spans(docs, window, text, scratch).groupBy("key").agg(
        F.collect_list(F.struct("start", "n_words")).alias("spans"))
    spans = scratch.write(spans, "spans")
    key, source = free_name(docs, "_key"), free_name(docs, "_words")
    cut = docs.withColumn(key, text_key(text)).join(spans.select(F.col("key").alias(key), F.col("spans").alias(source)), key, "left")
    cut = cut.withColumn(source, F.struct(F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").alias("spans")))
    fields = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_text": pa.string()}
    return add_columns(cut, source, fields, _cut, keep=docs.columns)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words that a repeated run of 35 words covers."""
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {"op13_substring_dedup": op13_substring_dedup}
