"""Columns of the input that are named like columns an operator makes on its way."""

import gc
import weakref

import pyarrow as pa
from pyspark.sql import functions as F

from stratalake.llm import common, cotrain, neardup, rules


def test_marks_of_near_duplicates(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text, "a"), (2, text + " more", "b"), (2, text + " more", "b"), (3, "other words altogether", "c"), (4, None, "d"), (4, None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _one string").withColumn("_ID", F.lit(1)).withColumn("_key", F.lit(2))
    out = neardup.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r._one) for r in out.collect()) == [(1, "a"), (3, "c"), (4, "d"), (4, "d")]


def test_prefix_of_rules(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "doc_id long, text string")
    docs = docs.withColumn("_rules_hashes", F.lit("mine")).withColumn("_RULES_llr", F.lit(7))
    out = rules.judge(docs, rules.Weights([0] * rules.BUCKETS, float("-inf")))
    row = out.first()
    assert row["_rules_hashes"] == "mine" and row["_RULES_llr"] == 7 and row["n_words"] == 11 and row["kept"]
    assert common.free_prefix(docs, "_rules_") == "__rules_"


def test_row_of_the_classifier(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    out = cotrain.classify(docs.withColumn("_ROW", F.lit("mine")), {task: None for task in cotrain.TASKS})
    row = out.first()
    assert row["_ROW"] == "mine" and row["kept"] and row["score"] == 1.0


def test_shared_values_live_as_long_as_their_frames(spark):
    """Outside of a scope nothing but frames holds a value, so it does not stay from stage to stage."""
    made = common.share(spark, [1, 2, 3])
    frame = common.add_columns(spark.range(2), "id", {"n": pa.int64()}, lambda ids, made=made: [[len(made.value)] * len(ids)])
    gone = weakref.ref(made)
    del made
    gc.collect()
    assert gone() is None
    spark._jvm.java.lang.System.gc()
    assert [r.n for r in frame.collect()] == [3, 3]


def test_shared_values_are_released(spark):
    with common.shared_within():
        made = common.share(spark, [1, 2, 3])
        assert spark.range(2).rdd.map(lambda x: len(made.value)).collect() == [3, 3]
    assert made not in common._shared


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    text = ("word " * 50 + "x" * 300 + " é ").encode() * 20
    whole_words, words = common.word_hashes(text), common.word_hashes(text)
    runs = common.run_hashes(words, 7)
    monkeypatch.setattr(common, "BLOCK", 64)
    assert (common.word_hashes(text) == whole_words).all()
    assert (common.run_hashes(words, 7) == runs).all() and len(runs) == len(words) - 6


def test_a_worker_keeps_things_of_one_kind_only():
    common.begin_task("a")
    first = common.kept("k", list)
    common.begin_task("a")
    assert common.kept("k", list) is first
    common.begin_task("b")
    assert common._kept["things"] == {} and common.kept("k", list) is not first
