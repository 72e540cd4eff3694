"""Headers, formats, catalogs, order, samples and empty runs, shown on the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from examples.ingest import _drop_calls_and_incidents, _orders_text
from examples.mapping import GATED_CALLS, GATED_INCIDENTS, Query, gold_cte, star_store, table
from stratalake.operators import aggregates as agg
from stratalake.operators.quality import Expectation, violations
from stratalake.operators.sampling import sample_rows
from stratalake.plans import kpi, reports
from stratalake.plans.pipeline import Pipeline
from stratalake.session import scratch_path, small_frame
from stratalake.sources import csv, tables


def csv_header_counts(spark, sf):
    """Names of a CSV file from its first line alone, with the filled values of each column."""
    path = scratch_path(spark, "csv")
    csv.write(_orders_text(spark, sf), path)
    text = csv.read_text(spark, path)
    filled = text.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in text.columns]).unpivot([], text.columns, "raw_name", "filled")
    return csv.header_table(spark, path).join(filled, "raw_name").select("ordinal", "raw_name", "name", "filled")


def read_by_suffix(spark, sf):
    """One table from Parquet and from CSV, told apart by the suffix."""
    path = scratch_path(spark, "csv")
    csv.write(table(spark, sf, "customer").select("c_custkey", "c_name"), path)
    found = {"parquet": tables.read_any(spark, f"{sf}/customer.parquet"), "csv": tables.read_any(spark, path)}
    parts = [df.agg(F.lit(kind).alias("kind"), agg.rows().alias("n"), F.sum(F.col("c_custkey").cast("long")).alias("keys"),
                    F.max("c_name").alias("last_name")) for kind, df in found.items()]
    return parts[0].union(parts[1])


def table_columns(spark, sf):
    """Columns of a stored table in their order, with the filled values of each."""
    store = star_store(spark, sf)
    dates = store.read("gold.dim_date")
    filled = dates.agg(*[F.count(c).alias(c) for c in dates.columns]).unpivot([], dates.columns, "column_name", "filled")
    return store.columns("gold.dim_date").join(filled, "column_name").select("ordinal", "column_name", "data_type", "filled")


def _in_order(df):
    """The rows with their place in the frame, which one task reads in order."""
    return df.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


def months_in_order(spark, sf):
    fact, dates = star_store(spark, sf).read("gold.fact_incident", "gold.dim_date")
    return _in_order(kpi.volume_by_month(kpi.with_dates(fact, dates)).orderBy(F.desc("year"), "month"))


def hours_in_order(spark, sf):
    """Rows of each hour, most first."""
    hours = agg.group_counts(table(spark, sf, "events").select(F.hour("ts").alias("hour")), ["hour"], "n")
    return _in_order(hours.orderBy(F.desc("n"), "hour"))


def first_orders(spark, sf):
    return reports.preview(table(spark, sf, "orders").orderBy("o_orderkey").select("o_orderkey", "o_custkey"), 200)


_EXPECTED = (Expectation("o_orderkey", ("bigint",), nullable=False, at_least=0), Expectation("o_custkey", ("bigint",), above=100),
             Expectation("o_totalprice", ("double",), at_least=1000))


def sampled_expectations(spark, sf):
    """Ranges of a sample of at most a million orders, as the gate takes it; with fewer orders it holds them all."""
    sample = sample_rows(table(spark, sf, "orders"), 1_000_000, ["o_orderkey"])
    return violations(sample, [rule for e in _EXPECTED for rule in e.rules()])


def empty_run(spark, sf):
    """A second run over the same drop stops at once: nothing pending, no new version."""
    pipe = Pipeline(spark, scratch_path(spark, "pipeline"))
    drop, rows = f"{_drop_calls_and_incidents(spark, sf)}/*", []
    for turn in range(2):
        found = pipe.run_incremental(drop)
        path = pipe.warehouse.versions().where("table_name = 'gold.fact_incident'").first()["path"]
        first = path if turn == 0 else first
        rows.append((turn, found["pending"] > 0, bool(found["skipped_downstream"]), path == first,
                     pipe.warehouse.read("gold.fact_incident").count()))
    return small_frame(spark, rows, "turn int, pending boolean, skipped boolean, same_version boolean, facts bigint")


_FILLED = " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS ordinal, '{raw}' AS raw_name, '{name}' AS name, {count} AS filled FROM orders"
    for i, (raw, name, count) in enumerate((
        ("IncidentNumber", "incident_number", "count(o_orderkey)"),
        ("Order Status", "order_status", "count(CASE WHEN o_custkey % 5 <> 0 THEN o_orderstatus END)"),
        ("AlarmDtTm", "alarm_dt_tm", "count(o_orderdate)"), ("Note", "note", "count(o_orderpriority)"),
        ("Loss", "loss", "count(o_totalprice)"))))

QUERIES = {
    "csv_header_counts": Query(csv_header_counts, _FILLED),
    "read_by_suffix": Query(read_by_suffix, """
SELECT 'parquet' AS kind, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys, max(c_name) AS last_name FROM customer
UNION ALL SELECT 'csv', count(*), CAST(sum(c_custkey) AS BIGINT), max(c_name) FROM customer"""),
    "table_columns": Query(table_columns, f"WITH {gold_cte()} " + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name, '{kind}' AS data_type, count({c}) AS filled FROM dim_date"
        for i, (c, kind) in enumerate((
            ("date_id", "bigint"), ("date", "date"), ("year", "int"), ("month", "int"), ("day", "int"), ("weekday", "int"),
            ("week_of_year", "int"), ("is_weekend", "boolean"))))),
    "months_in_order": Query(months_in_order, f"""
WITH {gold_cte()}
SELECT year, month, count(*) AS incident_count, row_number() OVER (ORDER BY year DESC, month) AS place FROM star GROUP BY year, month"""),
    "hours_in_order": Query(hours_in_order, """
SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour, count(*) AS n,
  row_number() OVER (ORDER BY count(*) DESC, CAST(extract(hour FROM ts) AS INTEGER)) AS place FROM events GROUP BY 1"""),
    "first_orders": Query(first_orders, "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 200"),
    "sampled_expectations": Query(sampled_expectations, """
SELECT 'o_orderkey is null' AS rule, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'o_orderkey is below 0', count(*) FILTER (WHERE o_orderkey < 0) FROM orders
UNION ALL SELECT 'o_custkey is not above 100', count(*) FILTER (WHERE o_custkey <= 100) FROM orders
UNION ALL SELECT 'o_totalprice is below 1000', count(*) FILTER (WHERE o_totalprice < 1000) FROM orders"""),
    "empty_run": Query(empty_run, f"""
WITH {gold_cte(GATED_CALLS, GATED_INCIDENTS)}
SELECT CAST(0 AS INTEGER) AS turn, TRUE AS pending, FALSE AS skipped, TRUE AS same_version, count(*) AS facts FROM fact
UNION ALL SELECT CAST(1 AS INTEGER), FALSE, TRUE, TRUE, count(*) FROM fact"""),
}
