import math
import re

import xxhash
from pyspark.sql import functions as F

from stratalake.llm.rules import BUCKETS, UNIT, Weights, judge, learn, op5_quality_rules, trusted_ids

BLANK = r"[^\x20\x09-\x0D]+"


def signed(n):
    return n - 2**64 if n >= 2**63 else n


def word_hash(w):
    return signed(xxhash.xxh64_intdigest(w.encode(), seed=42))


def pair_hash(a, b):
    first = xxhash.xxh64_intdigest(a.to_bytes(8, "little", signed=True), seed=42)
    return signed(xxhash.xxh64_intdigest(b.to_bytes(8, "little", signed=True), seed=first))


def brute(text):
    text = text or ""
    words = re.findall(BLANK, text)
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), failed)


def xxhash_of_long(i):
    return signed(xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), seed=42))


def grams(text):
    h = [word_hash(w) for w in re.findall(BLANK, text or "")]
    return [x % BUCKETS for x in h + [pair_hash(a, b) for a, b in zip(h, h[1:])]]


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    good = {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0} & set(texts)
    counted = {i for i in good if xxhash_of_long(i) % 3}
    raw, trusted = [1] * BUCKETS, [1] * BUCKETS
    for i, text in texts.items():
        for g in grams(text):
            raw[g] += 1
            trusted[g] += i in counted
    whole = math.log(sum(raw) / sum(trusted))
    weights = [round((math.log(t / r) + whole) * UNIT) for t, r in zip(trusted, raw)]
    llr = {i: sum(weights[g] for g in grams(t)) / len(grams(t)) / UNIT for i, t in texts.items()}
    steps = sorted(math.floor(llr[i] * 1000) for i in good - counted)
    threshold = steps[int(0.01 * len(steps))] / 1000
    rows = op5_quality_rules(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        b = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == b
        assert abs(r.llr - llr[r.doc_id]) < 1e-9
        assert r.kept == (not b[5] and llr[r.doc_id] >= threshold)
    kept = {r.doc_id for r in rows if r.kept}
    assert len(kept & good) > 0.85 * len(good)


def test_edges(spark):
    line = "one two three four five six seven"
    texts = [None, "", " \n ", "a b", f"{line}\n{line}\n\n{line}", "a a a a a a a a a a a a", "\x0bx\x0c<>|é😀 y" * 3,
             " ".join(f"w{i % 977}" for i in range(60_000)), "a b c d e", "a b c d e a b c d e"]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(4, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "9 AS Kept", "'q' AS _rules_hashes")
    out = judge(df, Weights([0] * BUCKETS, float("-inf")))
    assert out.columns[:3] == ["doc_id", "text", "_rules_hashes"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        b = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == b, r
        assert r.kept == (not b[5])
    assert judge(df.limit(0), Weights([0] * BUCKETS, 0.0)).count() == 0


def test_nothing_trusted(spark):
    labels = spark.createDataFrame([(1, 0, 0), (2, None, None), (None, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert trusted_ids(labels).count() == 0
    assert learn(docs, labels).threshold == float("-inf")
    more = labels.union(labels.selectExpr("5L", "1", "0")).union(labels.selectExpr("5L", "1", "0"))
    assert [r.doc_id for r in trusted_ids(more).collect()] == [5]


def test_all_trusted_documents_count(spark):
    """No document labelled good is left out, however many there are."""
    labels = spark.range(20_500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert trusted_ids(labels).count() == 20_500


def test_trusted_ids_that_are_not_broadcast_give_the_same_weights(spark, monkeypatch):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[
        F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50)).cast("string")) for k in range(20)]).alias("text"))
    labels = docs.where("doc_id % 4 = 0").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    whole = learn(docs, labels)
    monkeypatch.setattr("stratalake.llm.rules.BROADCAST_ROWS", 0)
    dealt = learn(docs, labels)
    assert (dealt.values, dealt.threshold) == (whole.values, whole.threshold) and any(whole.values)
