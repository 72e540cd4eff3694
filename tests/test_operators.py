from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratalake.operators import aggregates, dedup, filters, joins, quality, sampling, shape, surrogate


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a tenth without a key."""
    n = 9000
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(n).select(F.col("id"), key.cast("bigint").alias("k"), (F.col("id") % 91).alias("v"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(400).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join(skewed, dim, rows, how):
    hot = joins.find_hot_keys(skewed, ["k"], share=0.05, min_rows=100)
    seven = skewed.filter("k = 7").select(F.xxhash64("k").alias("h")).first().h
    assert list(hot) == [seven] and hot[seven] > 1
    spread = joins.spread_left_join(skewed, dim, ["k"], ["id"], how, share=0.05, min_rows=100)
    assert rows(spread, "id", "k", "name") == rows(skewed.join(dim, "k", how), "id", "k", "name")


def test_spread_join_splits_hot_and_null_keys(spark, skewed, dim):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = joins.spread_left_join(skewed, dim, ["k"], ["id"], share=0.001, min_rows=100)
        sizes = spread.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 9000 / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("limit", [10_000, 10])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_by_broadcast_and_by_spread(spark, skewed, rows, limit, null_safe):
    kinds = spark.createDataFrame(
        [(k, None if k % 2 else "t", k + 1000) for k in range(50)] + [(None, None, 1)],
        "k long, t string, kind long",
    )
    facts = skewed.withColumn("t", F.when(F.col("k") % 2 == 0, "t"))
    found = joins.lookup(facts, kinds, ["k", "t"], ["id"], null_safe=null_safe, broadcast_rows=limit)
    same = (
        facts["k"].eqNullSafe(kinds["k"]) & facts["t"].eqNullSafe(kinds["t"])
        if null_safe else (facts["k"] == kinds["k"]) & (facts["t"] == kinds["t"])
    )
    expected = facts.join(kinds, same, "left").select(facts["id"], kinds["kind"])
    assert rows(found, "id", "kind") == rows(expected)


def test_semi_and_anti_join(skewed, dim, rows):
    inside = joins.present(skewed, dim.union(dim), ["k"])
    outside = joins.not_present(skewed, dim, ["k"])
    assert inside.count() + outside.count() == skewed.count()
    assert outside.filter("k is null").count() == skewed.filter("k is null").count()


def test_keep_first_handles_ties_and_null_keys(spark, rows):
    t = datetime(2020, 1, 1)
    df = spark.createDataFrame(
        [(1, None, "a"), (1, t, "b"), (2, t, "a"), (2, t, "b"), (None, t, "x"), (None, None, "y")],
        "k int, ts timestamp_ntz, id string",
    )
    found = dedup.keep_first(df, ["k"], [dedup.newest_first("ts"), F.col("id").desc_nulls_last()])
    assert rows(found, "k", "id") == [(1, "b"), (2, "b"), (None, "x")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "rows must be limited before the shuffle"


@pytest.mark.parametrize("partitions", [1, 6, None])
def test_ordered_ids_equal_a_global_row_number(skewed, rows, partitions):
    found = surrogate.ordered_ids(skewed, ["k", "id"], "n", partitions)
    order = Window.orderBy(F.col("k").asc_nulls_last(), "id")
    assert rows(found, "n", "id") == rows(skewed.withColumn("n", F.row_number().over(order)), "n", "id")


def test_unordered_ids_are_dense(skewed):
    ids = [r.n for r in surrogate.unordered_ids(skewed, "n").collect()]
    assert sorted(ids) == list(range(1, 9001))


@pytest.mark.parametrize("task_rows", [0, 1_000_000])
def test_exact_quantiles(skewed, task_rows):
    qs = {"lo": 0.0, "mid": 0.5, "p90": 0.9, "hi": 1.0}
    values = np.array([r.v for r in skewed.collect()])
    row = aggregates.exact_quantiles(skewed, "v", qs, task_rows=task_rows).first()
    assert [row[n] for n in qs] == pytest.approx([np.quantile(values, q) for q in qs.values()])
    grouped = aggregates.exact_quantiles(skewed, "v", qs, ["k"], task_rows).collect()
    assert len(grouped) == skewed.select("k").distinct().count()
    for key in (None, 7):
        mine = [r.v for r in skewed.filter(F.col("k").eqNullSafe(F.lit(key))).collect()]
        found = next(r for r in grouped if r.k == key)
        assert found.p90 == pytest.approx(np.quantile(mine, 0.9))


def test_quantiles_of_nothing(skewed):
    empty = skewed.filter("v < 0")
    for task_rows in (-1, 10):
        assert aggregates.exact_quantiles(empty, "v", {"m": 0.5}, task_rows=task_rows).first().m is None
        assert aggregates.exact_quantiles(empty, "v", {"m": 0.5}, ["k"], task_rows).count() == 0


def test_approximate_quantiles_are_close(skewed):
    row = aggregates.approximate_quantiles(skewed, "v", {"m": 0.5}).first()
    assert abs(row.m - 45) <= 1


def test_histogram_matches_numpy(skewed, spark):
    values = [r.v for r in skewed.collect()]
    counts, edges = np.histogram(values, bins=13)
    found = aggregates.histogram(skewed, "v", 13).orderBy("bin").collect()
    assert [r.n for r in found] == list(counts)
    assert [r.bin_start for r in found] == pytest.approx(list(edges[:-1]))
    single = aggregates.histogram(spark.range(5).select(F.lit(4).alias("v")), "v", 4).orderBy("bin").collect()
    assert [r.n for r in single] == list(np.histogram([4] * 5, bins=4)[0])


def test_sample_is_exact_repeatable_and_before_filters(skewed, rows):
    drawn = sampling.sample_rows(skewed, 777, ["id"])
    assert drawn.count() == 777 and drawn.distinct().count() == 777
    assert rows(drawn, "id") == rows(sampling.sample_rows(skewed.repartition(3), 777, ["id"]), "id")
    assert rows(drawn, "id") != rows(sampling.sample_rows(skewed, 777, ["id"], seed=1), "id")
    assert sampling.sample_rows(skewed, 10**6, ["id"]).count() == 9000
    assert drawn.filter("v < 10").count() < 777


def test_shares_sum_to_one(skewed):
    found = aggregates.shares(skewed, ["v"], ["k"]).groupBy("k").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in found)
    assert {r.k for r in found} >= {None, 7}


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", None)], "k string, n int")
    assert [r.k for r in aggregates.top_k(df, "n", ["k"], 3).collect()] == ["c", "a", "b"]


def test_null_profile_of_nothing(spark):
    empty = spark.createDataFrame([], "a int")
    assert tuple(aggregates.null_profile(empty, ["a"]).first()) == ("a", 0, 0, 0.0)


def test_filters(spark, rows):
    df = spark.createDataFrame(
        [(1, "x", datetime(2020, 1, 1)), (2, "it's", datetime(2020, 1, 31)), (3, None, datetime(2020, 3, 1))],
        "id int, s string, ts timestamp_ntz",
    )
    assert rows(df.filter(filters.equals({"s": "it's", "id": None})), "id") == [(2,)]
    assert df.filter(filters.in_lists({"s": []})).count() == 3
    assert rows(filters.trailing_days(df, "ts", 30), "id") == [(2,), (3,)]
    assert rows(df.filter(filters.any_not_null(["s"])), "id") == [(1,), (2,)]


def test_shape(spark, rows):
    old = spark.createDataFrame([(1, "a")], "id int, s string")
    new = spark.createDataFrame([("b", 2, 3.5)], "s string, id int, extra double")
    assert rows(shape.union_evolving(old, new), "id", "s", "extra") == [(1, "a", None), (2, "b", 3.5)]
    assert rows(shape.union_as_text(old, new.select("id", "s"))) == [("1", "a"), ("2", "b")]
    assert shape.evolve(old.schema, ["s", "z"]).names == ["id", "s", "z"]
    assert rows(shape.to_header(old, ["z", "id"])) == [(None, "1")]
    assert rows(shape.clear_null_tokens(spark.createDataFrame([("None",), ("NULL",), ("",), ("x",)], "s string"))) == [
        ("x",), (None,), (None,), (None,)]


def test_gates_report_every_failure(spark):
    df = spark.createDataFrame([(1, -5), (None, 2), (None, None)], "k long, v int")
    rules = [quality.not_empty(), quality.not_null("k"), quality.not_negative("v")]
    expectations = [
        quality.Expectation("k", ("bigint",), nullable=False, above=1),
        quality.Expectation("v", ("bigint",), at_least=0),
        quality.Expectation("gone", ("string",)),
    ]
    with pytest.raises(quality.GateError) as caught:
        quality.enforce(df, "t", rules, expectations)
    assert caught.value.failures == {
        "gone is missing": 1, "v is int, not bigint": 1, "k is null": 2, "v is negative": 1,
        "k is not above 1": 1, "v is below 0": 1,
    }
    quality.enforce(df.filter("k = 1 and v > 0 or v = 2").fillna(3, ["k"]), "t", [quality.not_null("k")])
    with pytest.raises(quality.GateError, match="table is empty"):
        quality.enforce(df.filter("v > 100"), "t", [quality.not_empty()])
