"""Silver, star schema and key figures on the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from examples.mapping import GOLD_CTE, LATEST_CALLS_CTE, SILVER_CTE, Query, calls, raw_calls, star_store, table
from stratalake.functions import keys, times
from stratalake.operators import aggregates as agg
from stratalake.operators import dedup, joins, quality, shape
from stratalake.operators.surrogate import ordered_ids, unordered_ids
from stratalake.plans import gates, gold, kpi, silver


def _star(spark, sf):
    store = star_store(spark, sf)
    return kpi.star(*store.read(
        "gold.fact_incident", "gold.dim_date", "gold.dim_incident_type", "gold.dim_location"))


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _shipped(spark, sf):
    """Lines with the date of their order as received and the ship date as on scene."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    joined = joins.spread_left_join(lines, orders, ["l_orderkey"], ["l_linenumber", "l_partkey"])
    return joined.withColumn(
        "response_time_sec", times.seconds_between(F.col("o_orderdate"), F.col("l_shipdate"))
    )


def kpi_response_month(spark, sf):
    orders = table(spark, sf, "orders")
    days = gold.calendar(orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct())
    rows = _shipped(spark, sf).withColumn("date", F.col("o_orderdate").cast("date"))
    monthly = kpi.response_by_month(rows.join(F.broadcast(days), "date"))
    return _rounded(monthly, "avg_response_time_sec")


def kpi_volume_month(spark, sf):
    orders = table(spark, sf, "orders").withColumn("date_id", times.date_key(F.col("o_orderdate")))
    days = gold.calendar(orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct())
    return kpi.volume_by_month(orders.join(F.broadcast(days), "date_id"))


def kpi_top_type(spark, sf):
    store = star_store(spark, sf)
    rows = kpi.with_types(*store.read("gold.fact_incident", "gold.dim_incident_type"))
    return _rounded(kpi.by_type(rows), "avg_response_time_sec")


def kpi_views(spark, sf):
    store = star_store(spark, sf)
    found = kpi.kpi_tables(
        *store.read("gold.fact_incident", "gold.dim_date", "gold.dim_incident_type")
    )
    return shape.labelled_counts(found)


def kpi_star_response_month(spark, sf):
    return _rounded(kpi.response_by_month(_star(spark, sf)), "avg_response_time_sec")


def kpi_by_area(spark, sf):
    measures = ["response_time_sec", "number_of_alarms"]
    found = kpi.average_by_each(_star(spark, sf), measures, ["neighborhood", "battalion", "station_area"])
    return _rounded(found, "avg_response_time_sec", "avg_number_of_alarms")


def kpi_severity_by_type(spark, sf):
    measures = ["number_of_alarms", "suppression_personnel", "ems_personnel"]
    found = kpi.average_by(_star(spark, sf), measures, ["call_type"])
    return _rounded(found, *[f"avg_{m}" for m in measures])


def dashboard_summary(spark, sf):
    chosen = kpi.select_facts(_star(spark, sf), call_type_group="R")
    return _rounded(kpi.summary(chosen), "avg_resp", "avg_dispatch", "avg_travel", "p90_resp")


def dashboard_filtered_volume(spark, sf):
    return kpi.volume_by_month(kpi.select_facts(_star(spark, sf), year=1997, neighborhood="Hood 3"))


def dashboard_top_types(spark, sf):
    return kpi.top_types(_star(spark, sf), 15)


def filter_options(spark, sf):
    return kpi.filter_options(_star(spark, sf), ["year", "call_type_group", "neighborhood"])


def dedup_latest_calls(spark, sf):
    return silver.latest_calls(raw_calls(spark, sf)).select(
        "call_number", "incident_number", "received_ts", "ingested_ts", "rowid"
    )


def dedup_latest_incidents(spark, sf):
    latest = dedup.keep_first(
        table(spark, sf, "events"), ["user_id", "event_type"],
        [dedup.newest_first("ts"), F.col("event_id").desc_nulls_last()],
    )
    return latest.select("user_id", "event_type", "event_id", "ts", "value")


def silver_durations(spark, sf):
    return calls(spark, sf).select(
        "call_number", "response_time_sec", "dispatch_delay_sec", "travel_time_sec"
    )


def dim_date(spark, sf):
    return gold.dim_date(*star_store(spark, sf).read("silver.calls_clean", "silver.incidents_clean"))


def dim_type(spark, sf):
    return star_store(spark, sf).read("gold.dim_incident_type")


def dim_location(spark, sf):
    return star_store(spark, sf).read("gold.dim_location")


def dim_location_keyed(spark, sf):
    """Customer places as a location dimension, numbered by their key."""
    places = table(spark, sf, "customer").join(
        F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")
    )
    columns = ["n_name", "c_mktsegment", "zipcode"]
    keyed = places.withColumn("zipcode", F.when(F.col("c_custkey") % 5 > 0, F.col("c_custkey") % 40))
    keyed = keyed.select(*columns).distinct()
    keyed = keyed.withColumn("location_key", keys.text_key([F.col(c) for c in columns]))
    return ordered_ids(keyed, ["location_key"], "location_id", partitions=8)


def dense_ids(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", F.when(F.col("l_partkey") % 3 > 0, F.col("l_suppkey")).alias("supp"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice",
    )
    order = ["l_returnflag", "supp", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]
    return ordered_ids(rows, order, "id", partitions=16)


def fact_ids(spark, sf):
    found = unordered_ids(table(spark, sf, "lineitem").select("l_orderkey"), "id")
    return found.agg(agg.rows().alias("n"), F.min("id").alias("lowest"), F.max("id").alias("highest"),
                     F.countDistinct("id").alias("distinct_ids"))


def fact_star(spark, sf):
    return star_store(spark, sf).read("gold.fact_incident").drop("incident_id")


def fact_star_build(spark, sf):
    """The facts built anew from the silver tables, without a stored copy."""
    store = star_store(spark, sf)
    matched = gold.matched_calls(*store.read("silver.calls_clean", "silver.incidents_clean"))
    dims = store.read("gold.dim_date", "gold.dim_incident_type", "gold.dim_location")
    return gold.fact_rows(matched, *dims).groupBy("location_id").agg(
        agg.rows().alias("n"), F.sum("incident_type_id").alias("types"), F.min("date_id").alias("first_date")
    )


def gate_violations_fact(spark, sf):
    return quality.violations(star_store(spark, sf).read("gold.fact_incident"), gates.FACT_RULES)


def gate_violations_calls(spark, sf):
    rules = [*gates.CALL_RULES, *[r for e in gates.CALL_EXPECTATIONS for r in e.rules()]]
    unique = list({rule.name: rule for rule in rules}.values())
    return quality.violations(star_store(spark, sf).read("silver.calls_clean"), unique)


def _fact_sql(select: str) -> str:
    return f"WITH {GOLD_CTE}\n{select}"


def _rule_sql(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS violations FROM {source}"
        for name, test in rules.items()
    )


_AREA_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS field, {a} AS name, count(*) AS n_incidents, "
    f"round(avg(response_time_sec), 6) AS avg_response_time_sec, "
    f"round(avg(number_of_alarms), 6) AS avg_number_of_alarms FROM star GROUP BY {a}"
    for a in ("neighborhood", "battalion", "station_area")
)

def lookup_null_safe_large(spark, sf):
    """NULL-safe lookup on a time key with microseconds that goes through the spread join."""
    events = table(spark, sf, "events")
    key = F.when(F.col("event_id") % 7 != 0, F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 3))
    facts = events.select("event_id", key.alias("k"))
    dim = facts.select("k").distinct().withColumn("label", F.coalesce(F.unix_micros("k"), F.lit(-1).cast("long")))
    found = joins.lookup(facts, dim, ["k"], ["event_id"], null_safe=True, broadcast_rows=0)
    return found.select("event_id", "label")


QUERIES = {
    "kpi_response_month": Query(kpi_response_month, """
SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
       CAST(extract(month FROM o_orderdate) AS INTEGER) AS month,
       round(avg(datediff('second', o_orderdate, l_shipdate)), 6) AS avg_response_time_sec,
       count(*) AS n_incidents
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE datediff('second', o_orderdate, l_shipdate) >= 0 GROUP BY 1, 2"""),
    "kpi_volume_month": Query(kpi_volume_month, """
SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
       CAST(extract(month FROM o_orderdate) AS INTEGER) AS month, count(*) AS incident_count
FROM orders GROUP BY 1, 2"""),
    "kpi_top_type": Query(kpi_top_type, _fact_sql("""
SELECT call_type_group, call_type, count(*) AS incident_count,
       round(avg(response_time_sec), 6) AS avg_response_time_sec
FROM fact JOIN dim_incident_type USING (incident_type_id) GROUP BY 1, 2""")),
    "kpi_views": Query(kpi_views, _fact_sql("""
SELECT 'v_kpi_response_time_month' AS tbl, count(DISTINCT (year, month)) AS n FROM star WHERE response_time_sec IS NOT NULL
UNION ALL SELECT 'v_kpi_incident_volume_month', count(DISTINCT (year, month)) FROM star
UNION ALL SELECT 'v_kpi_top_incident_type', count(*) FROM (SELECT DISTINCT call_type_group, call_type FROM star)""")),
    "kpi_star_response_month": Query(kpi_star_response_month, _fact_sql("""
SELECT year, month, round(avg(response_time_sec), 6) AS avg_response_time_sec, count(*) AS n_incidents
FROM star WHERE response_time_sec IS NOT NULL GROUP BY 1, 2""")),
    "kpi_by_area": Query(kpi_by_area, _fact_sql(_AREA_SQL)),
    "kpi_severity_by_type": Query(kpi_severity_by_type, _fact_sql("""
SELECT call_type, count(*) AS n_incidents, round(avg(number_of_alarms), 6) AS avg_number_of_alarms,
       round(avg(suppression_personnel), 6) AS avg_suppression_personnel,
       round(avg(ems_personnel), 6) AS avg_ems_personnel
FROM star GROUP BY 1""")),
    "dashboard_summary": Query(dashboard_summary, _fact_sql("""
SELECT count(*) AS total_incidents,
  round(avg(response_time_sec) FILTER (WHERE response_time_sec IS NOT NULL), 6) AS avg_resp,
  round(avg(dispatch_delay_sec) FILTER (WHERE dispatch_delay_sec IS NOT NULL), 6) AS avg_dispatch,
  round(avg(travel_time_sec) FILTER (WHERE travel_time_sec IS NOT NULL), 6) AS avg_travel,
  round(quantile_cont(response_time_sec, 0.9) FILTER (WHERE response_time_sec IS NOT NULL), 6) AS p90_resp
FROM star WHERE call_type_group = 'R'""")),
    "dashboard_filtered_volume": Query(dashboard_filtered_volume, _fact_sql("""
SELECT year, month, count(*) AS incident_count FROM star
WHERE year = 1997 AND neighborhood = 'Hood 3' GROUP BY 1, 2""")),
    "dashboard_top_types": Query(dashboard_top_types, _fact_sql("""
SELECT call_type_group, call_type, count(*) AS incident_count,
       coalesce(call_type_group, 'N/A') || ' | ' || coalesce(call_type, 'N/A') AS label
FROM star GROUP BY call_type_group, call_type
ORDER BY incident_count DESC, call_type_group NULLS LAST, call_type NULLS LAST LIMIT 15""")),
    "filter_options": Query(filter_options, _fact_sql("""
SELECT DISTINCT 'year' AS field, CAST(year AS VARCHAR) AS value FROM star
UNION ALL SELECT DISTINCT 'call_type_group', call_type_group FROM star WHERE trim(call_type_group) <> ''
UNION ALL SELECT DISTINCT 'neighborhood', neighborhood FROM star WHERE trim(neighborhood) <> ''""")),
    "dedup_latest_calls": Query(dedup_latest_calls, f"""
WITH {LATEST_CALLS_CTE} SELECT call_number, incident_number, received_ts, ingested_ts, rowid FROM latest_calls"""),
    "dedup_latest_incidents": Query(dedup_latest_incidents, """
SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""),
    "silver_durations": Query(silver_durations, f"""
WITH {SILVER_CTE} SELECT call_number, response_time_sec, dispatch_delay_sec, travel_time_sec FROM calls"""),
    "dim_date": Query(dim_date, _fact_sql("SELECT * FROM dim_date")),
    "dim_type": Query(dim_type, _fact_sql("SELECT * FROM dim_incident_type")),
    "dim_location": Query(dim_location, _fact_sql("SELECT * FROM dim_location")),
    "dim_location_keyed": Query(dim_location_keyed, """
WITH k AS (SELECT DISTINCT n_name, c_mktsegment, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 40 END AS zipcode
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
h AS (SELECT *, md5(n_name || '|' || c_mktsegment || '|' || coalesce(CAST(zipcode AS VARCHAR), '')) AS location_key FROM k)
SELECT row_number() OVER (ORDER BY location_key) AS location_id, * FROM h"""),
    "dense_ids": Query(dense_ids, """
WITH t AS (SELECT l_returnflag, CASE WHEN l_partkey % 3 > 0 THEN l_suppkey END AS supp, l_orderkey,
                  l_linenumber, l_partkey, l_shipdate, l_extendedprice FROM lineitem)
SELECT row_number() OVER (ORDER BY l_returnflag NULLS LAST, supp NULLS LAST, l_orderkey, l_linenumber,
                          l_partkey, l_shipdate, l_extendedprice) AS id, * FROM t"""),
    "fact_ids": Query(fact_ids, """
SELECT count(*) AS n, CAST(1 AS BIGINT) AS lowest, count(*) AS highest, count(*) AS distinct_ids FROM lineitem"""),
    "fact_star": Query(fact_star, _fact_sql(f"SELECT {', '.join(gold.FACT_COLUMNS)} FROM fact")),
    "fact_star_build": Query(fact_star_build, _fact_sql("""
SELECT location_id, count(*) AS n, CAST(sum(incident_type_id) AS BIGINT) AS types, min(date_id) AS first_date
FROM fact GROUP BY location_id""")),
    "gate_violations_fact": Query(gate_violations_fact, _fact_sql(
        "SELECT 'table is empty' AS rule, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations "
        "FROM fact UNION ALL " + _rule_sql("fact", {
            **{f"{c} is null": f"{c} IS NULL" for c in
               ("incident_number", "date_id", "location_id", "incident_type_id")},
            **{f"{c} is negative": f"{c} < 0" for c in
               ("response_time_sec", "dispatch_delay_sec", "travel_time_sec", "incident_duration_sec")},
        }))),
    "gate_violations_calls": Query(gate_violations_calls, f"WITH {SILVER_CTE} " + _rule_sql("calls", {
        "received_ts is null": "received_ts IS NULL",
        "dispatch_ts is null": "dispatch_ts IS NULL",
        "response_time_sec is negative": "response_time_sec < 0",
        "call_number is null": "call_number IS NULL",
        "call_number is not above 0": "call_number <= 0",
        "response_time_sec is below 0": "response_time_sec < 0",
        "dispatch_delay_sec is below 0": "dispatch_delay_sec < 0",
        "travel_time_sec is below 0": "travel_time_sec < 0",
    })),
    "lookup_null_safe_large": Query(lookup_null_safe_large, """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN epoch_us(ts) + event_id % 3 ELSE -1 END AS label FROM events"""),
}
