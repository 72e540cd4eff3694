"""Physical plans: what must be pushed down, pruned, limited or kept out."""

import re

import pytest
from pyspark.sql import functions as F

from examples import scalars, star
from examples.mapping import star_store, table
from stratalake.operators import aggregates, joins
from stratalake.plans import kpi, reports


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def store(spark, sf):
    return star_store(spark, sf)


def test_no_query_has_a_cartesian_product_or_python(spark, sf):
    for name, query in {**star.QUERIES, **scalars.QUERIES}.items():
        text = plan(query.run(spark, sf))
        assert "CartesianProduct" not in text, name
        assert "BatchEvalPython" not in text and "MapInPandas" not in text, name


def test_filters_reach_the_scan(spark, sf, store):
    chosen = reports.CallFilter("1995-01-01", "1996-12-31", groups=["A"])
    text = plan(chosen.apply(store.read("silver.calls_clean")))
    assert "GreaterThanOrEqual(call_date" in text and "EqualTo(call_type_group,A)" in text or "In(call_type_group" in text


def test_chosen_year_bounds_the_fact_scan(store):
    rows = kpi.with_dates(*store.read("gold.fact_incident", "gold.dim_date"))
    text = plan(kpi.volume_by_month(kpi.select_facts(rows, year=1997, month=2)))
    assert re.search(r"GreaterThanOrEqual\(date_id,19970201\)", text)
    assert re.search(r"LessThanOrEqual\(date_id,19970231\)", text)
    fact_scan = next(s for s in re.findall(r"ReadSchema: (\S+)", text) if "year" not in s)
    assert fact_scan == "struct<date_id:bigint>"


def test_scans_read_only_the_columns_they_need(spark, sf):
    text = plan(table(spark, sf, "orders").groupBy("o_orderstatus").count())
    assert "ReadSchema: struct<o_orderstatus:string>" in text


def test_top_k_needs_no_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan(scalars.top_k_ties(spark, sf))


def test_group_counts_are_partial_first(spark, sf):
    text = plan(aggregates.group_counts(table(spark, sf, "lineitem"), ["l_returnflag"]))
    assert text.count("HashAggregate") >= 2


def test_small_dimension_is_broadcast_and_large_one_is_not(spark, sf):
    facts, dim = table(spark, sf, "lineitem"), table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    spread = ["l_orderkey", "l_linenumber"]
    assert "BroadcastHashJoin" in plan(joins.lookup(facts, dim, ["l_partkey"], spread))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.lookup(facts, dim, ["l_partkey"], spread, broadcast_rows=10))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_safe_lookup_is_an_equi_join(spark, sf):
    facts = table(spark, sf, "orders").withColumn("k", F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")))
    dim = facts.select("k").distinct().withColumn("name", F.lit("x"))
    text = plan(joins.lookup(facts, dim, ["k"], ["o_orderkey"], null_safe=True))
    assert "NestedLoop" not in text
