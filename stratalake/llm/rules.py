"""Quality rules in DataFrame functions only.

Base rules: a document needs at least ``LEAST_WORDS`` words, and at most ``MOST_REPEATED`` percent of
its words may lie in windows of five words that the text holds twice or more.

Method: words and word pairs are hashed into ``BUCKETS`` buckets. Two multinomials with add-one
smoothing are counted, one over the whole corpus and one over trusted documents; a document's score is the
sum over its words and pairs of ``log(p_trusted / p_raw)``, divided by their number. Weights are whole
millionths, so the sum is exact in any order. A document stays if its score is at least the threshold:
the score below which ``TRUSTED_LOSS`` of the trusted documents that were not counted lie.

Trusted documents are all that are labelled with quality 1 and not toxic. By a hash of the id two thirds of
them are counted and the others set the threshold, so it fits documents that the ratios have not seen. Corpus counts
cover every document.

Defined results: a null or empty text has no words, zero counts and fails; without trusted documents
the method lets every document pass; rows with a null ``doc_id`` are judged but never trusted; repeated rows are
judged row by row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch, free_prefix, table
from stratalake.operators.joins import BROADCAST_ROWS

BUCKETS = 4096
TRUSTED_LOSS = 0.01
LEAST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5
#: Millionths; scores are kept within a bound so that the threshold is found by counting.
UNIT = 1_000_000
_STEPS_PER_UNIT = 1000

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none if it is null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _with_hashes(df: DataFrame, text: str, name: str) -> DataFrame:
    return df.withColumn(name, F.transform(words_of(F.col(f"`{text}`")), lambda w: F.xxhash64(w)))


def _zipped(left: Column, right: Column, skip: int, combine=lambda a, b: F.xxhash64(a, b)) -> Column:
    """``combine`` of each element of ``left`` and the one ``skip`` places on in ``right``.

    Arrays are cut and zipped and never indexed inside a lambda, where a pushed-down filter could put
    the whole expression of the array and have it computed for every element.
    """
    n = F.greatest(F.least(F.size(left), F.size(right) - skip), F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(1 + skip), n), combine)


def _pairs(hashes: Column) -> Column:
    """A hash of each pair of neighbours."""
    return _zipped(hashes, hashes, 1)


def _bucket(value: Column) -> Column:
    return F.pmod(value, F.lit(BUCKETS)).cast("int")


def base_counts(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """The frame with ``prefix`` + n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and hashes.

    Windows of five words are compared by a hash of two pairs and a word. Only where two are equal are they
    sorted with their places; places next to an equal window stay, and the words under them count once.
    """
    c = lambda name: F.col(prefix + name)
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    df = _with_hashes(df, text, prefix + "hashes").withColumn(prefix + "pairs", _pairs(c("hashes")))
    fours = _zipped(c("pairs"), c("pairs"), 2)
    df = df.withColumns({prefix + "lines": lines, prefix + "windows": _zipped(fours, c("hashes"), WINDOW - 1)})
    df = df.withColumn(prefix + "placed", F.when(
        F.size(F.array_distinct(c("windows"))) < F.size(c("windows")),
        F.array_sort(F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    equal_next = _zipped(c("placed"), c("placed"), 1, lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(prefix + "repeated", F.array_sort(F.array_distinct(F.flatten(equal_next))))
    covered = F.aggregate(
        c("repeated"), F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n")),
        lambda a: a["n"])
    return df.withColumns({
        prefix + "n_words": F.size(c("hashes")).cast("long"),
        prefix + "word_chars": F.length(F.translate(value, SPACES, "")).cast("long"),
        prefix + "n_symbols": (F.length(value) - F.length(F.translate(value, SYMBOLS, ""))).cast("long"),
        prefix + "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
        prefix + "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
    })


class Weights:
    """Frozen log ratios by bucket, in millionths, and the threshold of the mean ratio."""

    def __init__(self, values: list[int], threshold: float):
        self.values, self.threshold = values, threshold

    def score(self, hashes: Column) -> Column:
        """The mean log ratio of the words and pairs; null without words."""
        weights = F.split(F.lit(",".join(map(str, self.values))), ",").cast("array<bigint>")
        add = lambda a, h: a + F.get(weights, _bucket(h))
        zero = F.lit(0).cast("long")
        total = F.aggregate(hashes, zero, add) + F.aggregate(_pairs(hashes), zero, add)
        return F.when(F.size(hashes) > 0, total / (2 * F.size(hashes) - 1) / UNIT)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all documents labelled good."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def apart(doc_id: str) -> Column:
    """Trusted documents that set the threshold."""
    return F.pmod(F.xxhash64(doc_id), F.lit(3)) == 0


def learn(docs: DataFrame, labels: DataFrame) -> Weights:
    """Ratios over the whole corpus, and the threshold from the trusted documents."""
    scratch = Scratch(docs.sparkSession)
    ids = scratch.write(trusted_ids(labels).withColumn("apart", apart("doc_id")), "trusted-ids")
    found = ids.count()
    if not found:
        return Weights([0] * BUCKETS, float("-inf"))
    # Both joins give the same rows; only ids that were counted are broadcast.
    marks = F.broadcast(ids) if found <= BROADCAST_ROWS else ids
    hashed = _with_hashes(docs.select("doc_id", "text"), "text", "hashes")
    good = scratch.write(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(marks, "doc_id")
                         .transform(lambda d: _with_hashes(d, "text", "hashes")).select("apart", "hashes"), "trusted-words")
    raw, trusted = [1] * BUCKETS, [1] * BUCKETS
    for counts, rows in ((raw, hashed), (trusted, good.where(~F.col("apart")))):
        values = rows.select(F.explode(F.concat("hashes", _pairs(F.col("hashes")))).alias("h"))
        for bucket, n in values.groupBy(_bucket(F.col("h")).alias("bucket")).count().collect():
            counts[bucket] += n
    whole = math.log(sum(raw) / sum(trusted))
    weights = Weights([round((math.log(t / r) + whole) * UNIT) for t, r in zip(trusted, raw)], float("-inf"))
    scored = good.where("apart").select(F.floor(weights.score(F.col("hashes")) * _STEPS_PER_UNIT).alias("step"))
    steps = sorted((r["step"], r["count"]) for r in scored.groupBy("step").count().collect() if r["step"] is not None)
    scratch.drop("trusted-ids", "trusted-words")
    allowed = TRUSTED_LOSS * sum(n for _, n in steps)
    below = 0
    for step, n in steps:
        if below + n > allowed:
            weights.threshold = step / _STEPS_PER_UNIT
            break
        below += n
    return weights


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")


def judge(df: DataFrame, weights: Weights, text: str = "text") -> DataFrame:
    """The frame with the counts, ``base_failed``, ``llr`` and ``kept``; columns so named are replaced."""
    prefix = free_prefix(df, "_rules_")
    c = lambda name: F.col(prefix + name)
    others = [F.col(f"`{x}`") for x in df.columns if x.lower() not in RESULTS]
    counted = base_counts(df, text, prefix)
    failed = (c("n_words") < LEAST_WORDS) | (100 * c("n_repeat_words") > MOST_REPEATED * c("n_words"))
    llr = weights.score(c("hashes"))
    counted = counted.withColumns({prefix + "base_failed": failed, prefix + "llr": llr})
    passed = F.coalesce(c("llr") >= F.lit(weights.threshold), F.lit(False))
    return counted.withColumn(prefix + "kept", ~c("base_failed") & passed).select(
        *others, *[c(x).alias(x) for x in RESULTS])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    weights = learn(docs, table(spark, sf_dir, "labels"))
    return judge(docs.select("doc_id", "text"), weights).drop("text")


QUERIES = {"op5_quality_rules": op5_quality_rules}
