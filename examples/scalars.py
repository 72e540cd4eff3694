"""Scalar functions, filters and profiles on the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from examples.mapping import Query, table
from stratalake.functions import casts, keys, names, times
from stratalake.operators import aggregates as agg
from stratalake.operators import filters, joins, quality, sampling, shape
from stratalake.plans import profile

_TEXT_TS = {
    # How event times are written as text, one form per event.
    "spark": "CASE WHEN event_id % 6 = 0 THEN date_format(ts, 'MM/dd/yyyy hh:mm:ss a') "
             "WHEN event_id % 6 = 1 THEN date_format(ts, 'MM/dd/yyyy HH:mm:ss') "
             "WHEN event_id % 6 = 2 THEN '  ' || date_format(ts, 'yyyy-MM-dd HH:mm:ss') || ' ' "
             "WHEN event_id % 6 = 3 THEN date_format(ts, 'M/d/yyyy') "
             "WHEN event_id % 6 = 4 THEN date_format(ts, 'yyyy-MM-dd') "
             "ELSE 'on ' || event_id END",
    "duckdb": "CASE WHEN event_id % 6 = 0 THEN strftime(ts, '%m/%d/%Y %I:%M:%S %p') "
              "WHEN event_id % 6 = 1 THEN strftime(ts, '%m/%d/%Y %H:%M:%S') "
              "WHEN event_id % 6 = 2 THEN '  ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' "
              "WHEN event_id % 6 = 3 THEN strftime(ts, '%-m/%-d/%Y') "
              "WHEN event_id % 6 = 4 THEN strftime(ts, '%Y-%m-%d') "
              "ELSE 'on ' || event_id END",
}

_TEXT_NUMBER = (
    "CASE WHEN o_orderkey % 6 = 0 THEN o_custkey || '.5' WHEN o_orderkey % 6 = 1 THEN '-' || o_custkey "
    "WHEN o_orderkey % 6 = 2 THEN ' ' || o_custkey || ' ' WHEN o_orderkey % 6 = 3 THEN o_custkey || '-1234' "
    "WHEN o_orderkey % 6 = 4 THEN '99999999' || o_custkey ELSE '' END"
)


def parse_timestamps(spark, sf):
    text = table(spark, sf, "events").selectExpr("event_id", f"{_TEXT_TS['spark']} AS raw")
    return text.select(
        "event_id",
        times.parse_timestamp(F.col("raw")).alias("ts_value"),
        times.parse_date(F.col("raw")).cast("timestamp_ntz").alias("date_value"),
    )


def try_cast_numbers(spark, sf):
    text = table(spark, sf, "orders").selectExpr("o_orderkey", f"{_TEXT_NUMBER} AS raw")
    return text.select(
        "o_orderkey",
        casts.to_integer(F.col("raw")).alias("as_int"),
        casts.to_long(F.col("raw")).alias("as_long"),
        casts.drop_negative(casts.to_integer(F.col("raw"))).alias("not_negative"),
    )


def duration_boundaries(spark, sf):
    later = F.expr("ts + (event_id % 7 - 3) * INTERVAL '0.4' SECOND")
    return table(spark, sf, "events").select(
        "event_id",
        times.signed_seconds(F.col("ts"), later).alias("signed_sec"),
        times.seconds_between(F.col("ts"), later).alias("duration_sec"),
    )


_PADDED = (
    "CASE WHEN doc_id % 5 = 0 THEN '  ' || source || chr(160) WHEN doc_id % 5 = 1 THEN '   ' "
    "WHEN doc_id % 5 = 2 THEN NULL ELSE source END"
)


def trim_blank_null(spark, sf):
    padded = table(spark, sf, "documents").selectExpr("doc_id", "lang", f"{_PADDED} AS raw")
    return padded.select(
        "doc_id",
        casts.blank_to_null(F.col("raw")).alias("cleaned"),
        casts.first_text(F.col("raw"), F.col("lang")).alias("first_side"),
        casts.placeholder(casts.blank_to_null(F.col("raw")), "Unknown").alias("shown"),
        F.lower(casts.trim_spaces(F.col("raw"))).alias("lowered"),
    )


def calendar_parts(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        times.date_key(ts).alias("date_id"),
        F.hour(ts).alias("hour"),
        times.weekday_sunday0(ts).alias("dow_sunday0"),
        times.weekday_monday0(ts).alias("dow_monday0"),
        times.iso_week(ts).alias("week_of_year"),
        times.is_weekend(ts).alias("is_weekend"),
        times.month_start(ts).alias("month_start"),
        times.month_label(F.year(ts), F.month(ts)).alias("month_label"),
        times.add_seconds(ts, (F.col("user_id") * 7).cast("int")).alias("later"),
    )


def format_roundtrip(spark, sf):
    raw = times.raw_timestamp_text(F.col("o_orderdate") + F.expr("(o_orderkey % 86400) * INTERVAL '1' SECOND"))
    return table(spark, sf, "orders").select(
        "o_orderkey", raw.alias("raw_text"), times.parse_timestamp(raw).alias("parsed"),
        times.joined_label(F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderstatus")),
                           F.col("o_orderpriority")).alias("label"),
    )


def hash_keys(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        keys.text_key(
            [F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")), F.col("c_nationkey"), F.col("c_name")]
        ).alias("row_key"),
    )


_PATH = (
    "'/drop/' || CASE WHEN page_id % 5 = 0 THEN 'Fire_Calls_' WHEN page_id % 5 = 1 THEN 'fire_incidents_' "
    "WHEN page_id % 5 = 2 THEN 'incident_call_' ELSE 'data_' END || page_id || '.csv'"
)


def classify_files(spark, sf):
    files = table(spark, sf, "pages").selectExpr("page_id", f"{_PATH} AS path", "html")
    has_call = F.col("html").contains("call") | (F.col("page_id") % 3 == 0)
    has_incident = F.col("page_id") % 2 == 0
    return files.select(
        "page_id", names.classify_dataset(has_call, has_incident, F.col("path")).alias("dataset")
    )


def anti_join_incremental(spark, sf):
    orders = table(spark, sf, "orders")
    stored = orders.filter(F.col("o_orderkey") % 3 != 0)
    new = joins.not_present(orders, stored, ["o_orderkey"])
    return new.groupBy("o_orderstatus").agg(
        agg.rows().alias("inserted"), F.min("o_orderkey").alias("first_key")
    )


def semi_join_keys(spark, sf):
    busy = table(spark, sf, "lineitem").filter(F.col("l_quantity") > 45).select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return joins.present(table(spark, sf, "orders"), busy, ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


def filters_range_in(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    chosen = filters.in_lists({"o_orderstatus": ["F", "O"], "o_orderpriority": []})
    return orders.filter(filters.date_range("day", "1996-01-01", "1997-12-31")).filter(chosen).select(
        "o_orderkey", "o_orderstatus", "o_orderdate"
    )


def filters_equal_any(spark, sf):
    orders = table(spark, sf, "orders").withColumns(
        {"year": F.year("o_orderdate"), "late": F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderpriority")),
         "odd": F.when(F.col("o_custkey") % 3 == 0, F.col("o_orderstatus"))}
    )
    kept = orders.filter(filters.equals({"year": 1997, "o_orderstatus": None})).filter(
        filters.any_not_null(["late", "odd"])
    )
    return kept.select("o_orderkey", "late", "odd")


def trailing_60d_hour(spark, sf):
    recent = filters.trailing_days(table(spark, sf, "events"), "ts", 10)
    return recent.groupBy(F.hour("ts").alias("hour")).agg(agg.rows().alias("n"))


def drop_incomplete(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS status",
        "CASE WHEN o_custkey % 5 > 0 THEN o_totalprice END AS price",
    )
    return shape.drop_incomplete(orders, ["status", "price"])


def numeric_clean(spark, sf):
    text = table(spark, sf, "orders").selectExpr("o_orderkey", f"{_TEXT_NUMBER} AS raw")
    return text.select(
        "o_orderkey",
        casts.bounded_number(F.col("raw"), fill=0).alias("at_least_zero"),
        casts.bounded_number(F.col("raw"), fill=3, low=0, high=10, digits=0).alias("in_range"),
    )


def schema_evolution_union(spark, sf):
    orders = table(spark, sf, "orders").withColumn("kind", F.lit("old"))
    old = orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus")
    new = orders.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return shape.union_evolving(old, new)


def union_relaxed(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_nationkey").alias("nation"))
    return shape.union_as_text(customers, suppliers)


def to_header(spark, sf):
    return shape.to_header(
        table(spark, sf, "part").select("p_partkey", "p_brand"), ["p_brand", "p_missing", "p_partkey"]
    )


def rename_sanitize(spark, sf):
    raw = shape.rename(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice"),
        {"o_orderkey": "IncidentNumber", "o_orderdate": "AlarmDtTm", "o_custkey": "EMSUnits",
         "o_totalprice": "Zipcode of Incident"},
    )
    return names.sanitize_columns(raw)


def null_profile(spark, sf):
    holes = table(spark, sf, "events").selectExpr(
        "CASE WHEN event_id % 7 > 0 THEN value END AS value",
        "CASE WHEN user_id % 5 > 0 THEN event_type END AS event_type", "ts",
    )
    return agg.null_profile(holes, ["value", "event_type", "ts"])


def weekday_median_volume(spark, sf):
    return agg.weekday_median(table(spark, sf, "events"), "ts")


def weekday_median_60d(spark, sf):
    """Median events a day for each weekday over the last 60 days."""
    events = table(spark, sf, "events").withColumn("dow", F.weekday("ts")).withColumn("hour", F.hour("ts"))
    return profile.distribution_profile(events, "ts", ["event_type"], last_days=60)["weekday_medians"]


def hour_share(spark, sf):
    events = table(spark, sf, "events").withColumn("hour", F.hour("ts"))
    return agg.shares(events, ["hour"]).withColumn("share", F.round("share", 9))


def category_share_by_dow(spark, sf):
    events = table(spark, sf, "events").withColumns(
        {"dow": times.weekday_monday0(F.col("ts")),
         "user_kind": F.when(F.col("user_id") % 4 > 0, F.concat(F.lit("k"), F.col("user_id") % 4))}
    )
    found = agg.category_shares(events, "dow", ["event_type", "user_kind"])
    return found.withColumn("share", F.round("share", 9))


def histogram(spark, sf):
    found = agg.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 60)
    return found.withColumns({c: F.round(c, 4) for c in ("bin_start", "bin_end")})


def exact_quantiles(spark, sf):
    found = agg.exact_quantiles(
        table(spark, sf, "lineitem"), "l_extendedprice", {"median_price": 0.5, "p90_price": 0.9},
        ["l_returnflag"],
    )
    return found.withColumns({c: F.round(c, 4) for c in ("median_price", "p90_price")})


def exact_quantiles_by_rank(spark, sf):
    """The same through range partitions, as for more values than one task may hold."""
    found = agg.exact_quantiles(
        table(spark, sf, "lineitem"), "l_extendedprice", {"median_price": 0.5, "p90_price": 0.9},
        ["l_returnflag"], task_rows=0,
    )
    return found.withColumns({c: F.round(c, 4) for c in ("median_price", "p90_price")})


def table_counts(spark, sf):
    return shape.labelled_counts(
        {n: table(spark, sf, n) for n in ("orders", "lineitem", "customer", "events", "documents")}
    )


def profile_min_max(spark, sf):
    return agg.range_profile(table(spark, sf, "orders"), "o_orderdate")


def sample_n_hash(spark, sf):
    keys_ = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"]
    drawn = sampling.sample_rows(table(spark, sf, "lineitem"), 2000, keys_)
    return drawn.agg(agg.rows().alias("n"), F.countDistinct(*keys_).alias("distinct_rows"))


def top_k_ties(spark, sf):
    counts = agg.group_counts(table(spark, sf, "lineitem"), ["l_partkey"], "n_lines")
    return agg.top_k(counts, "n_lines", ["l_partkey"], 15)


def having_top_avg(spark, sf):
    customers = table(spark, sf, "customer").join(
        F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")
    )
    name = casts.placeholder(F.when(F.col("n_nationkey") % 6 > 0, F.col("n_name")), "Unknown")
    averages = (
        customers.groupBy(name.alias("nation"))
        .agg(F.round(F.avg(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))), 4).alias("avg_bal"))
        .filter(F.col("avg_bal").isNotNull())
    )
    return agg.top_k(averages, "avg_bal", ["nation"], 15)


def gate_violations_orders(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "loss", F.when(F.col("o_custkey") % 9 > 0, F.col("o_totalprice") - 50000)
    )
    rules = [quality.not_empty(), quality.not_null("loss"), quality.not_negative("loss"),
             quality.positive("o_custkey")]
    return quality.violations(orders, rules)


def ledger_contents(spark, sf):
    from stratalake.plans.ledger import content_states

    events = table(spark, sf, "events").select(
        F.col("event_type").alias("pipeline_name"), F.col("user_id").cast("string").alias("content_sha256"),
        F.col("ts").alias("success_at"),
    )
    return content_states(events)


def ledger_runs(spark, sf):
    from stratalake.plans.ledger import run_states

    events = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.lit("p").alias("pipeline_name"),
        F.col("ts").alias("event_at"),
        F.when(F.col("event_type").isin("view", "click"), "RUNNING").otherwise(F.col("event_type")).alias("status"),
        F.col("event_type").alias("trigger_type"), F.col("props").alias("notes"),
    )
    return run_states(events)


def ledger_drop_status(spark, sf):
    """Pages as dropped files, some of their contents known before."""
    from stratalake.plans.ledger import classify_drop

    pages = table(spark, sf, "pages")
    files = pages.select(
        "page_id", F.md5("html").alias("file_sha256"),
        F.when(F.col("page_id") % 11 == 0, F.lit("unreadable")).alias("error_message"),
    )
    known = pages.filter("page_id % 4 = 0").select(F.md5("html").alias("content_sha256"))
    return classify_drop(files, known).select("page_id", "status", "error_message")


_PARSE_TS = (
    "coalesce(try_strptime(raw, '%m/%d/%Y %I:%M:%S %p'), try_strptime(raw, '%m/%d/%Y %H:%M:%S'), "
    "try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_cast(raw AS TIMESTAMP))"
)
_PARSE_DATE = (
    "coalesce(try_strptime(raw, '%m/%d/%Y'), try_strptime(raw, '%Y-%m-%d'), try_cast(raw AS DATE))"
)
_QUANTILES = """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median_price,
       round(quantile_cont(l_extendedprice, 0.9), 4) AS p90_price
FROM lineitem GROUP BY l_returnflag"""

QUERIES = {
    "parse_timestamps": Query(parse_timestamps, f"""
WITH t AS (SELECT event_id, {_TEXT_TS['duckdb']} AS raw FROM events)
SELECT event_id, {_PARSE_TS} AS ts_value, CAST({_PARSE_DATE} AS TIMESTAMP) AS date_value FROM t"""),
    "try_cast_numbers": Query(try_cast_numbers, f"""
WITH t AS (SELECT o_orderkey, {_TEXT_NUMBER} AS raw FROM orders)
SELECT o_orderkey, try_cast(raw AS INTEGER) AS as_int, try_cast(raw AS BIGINT) AS as_long,
       CASE WHEN try_cast(raw AS INTEGER) < 0 THEN NULL ELSE try_cast(raw AS INTEGER) END AS not_negative
FROM t"""),
    "duration_boundaries": Query(duration_boundaries, """
WITH t AS (SELECT event_id, ts, ts + (event_id % 7 - 3) * INTERVAL '0.4' SECOND AS later FROM events)
SELECT event_id, datediff('second', ts, later) AS signed_sec,
       CASE WHEN datediff('second', ts, later) >= 0 THEN datediff('second', ts, later) END AS duration_sec
FROM t"""),
    "trim_blank_null": Query(trim_blank_null, f"""
WITH t AS (SELECT doc_id, lang, {_PADDED} AS raw FROM documents)
SELECT doc_id, nullif(trim(raw), '') AS cleaned, nullif(trim(coalesce(raw, lang)), '') AS first_side,
       coalesce(nullif(trim(raw), ''), 'Unknown') AS shown, lower(trim(raw)) AS lowered
FROM t"""),
    "calendar_parts": Query(calendar_parts, """
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_id,
       CAST(extract(hour FROM ts) AS INTEGER) AS hour, CAST(extract(dow FROM ts) AS INTEGER) AS dow_sunday0,
       CAST(extract(isodow FROM ts) - 1 AS INTEGER) AS dow_monday0,
       CAST(extract(week FROM ts) AS INTEGER) AS week_of_year, extract(dow FROM ts) IN (0, 6) AS is_weekend,
       CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start, strftime(ts, '%Y-%m') AS month_label,
       ts + to_seconds(user_id * 7) AS later
FROM events"""),
    "format_roundtrip": Query(format_roundtrip, """
WITH t AS (SELECT *, o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND AS moment FROM orders)
SELECT o_orderkey, strftime(moment, '%m/%d/%Y %I:%M:%S %p') AS raw_text, moment AS parsed,
       coalesce(CASE WHEN o_custkey % 3 > 0 THEN o_orderstatus END, 'N/A') || ' | ' || o_orderpriority AS label
FROM t"""),
    "hash_keys": Query(hash_keys, """
SELECT c_custkey, md5(coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END, '') || '|' ||
       CAST(c_nationkey AS VARCHAR) || '|' || c_name) AS row_key
FROM customer"""),
    "classify_files": Query(classify_files, f"""
WITH t AS (SELECT page_id, lower({_PATH}) AS path, page_id % 2 = 0 AS has_inc,
                  (html LIKE '%call%' OR page_id % 3 = 0) AS has_call FROM pages)
SELECT page_id, CASE WHEN has_inc AND has_call THEN CASE WHEN path LIKE '%call%' THEN 'calls' ELSE 'incidents' END
  WHEN has_inc THEN 'incidents' WHEN has_call THEN 'calls'
  WHEN path LIKE '%incident%' THEN 'incidents' WHEN path LIKE '%call%' THEN 'calls'
  ELSE 'incidents' END AS dataset
FROM t"""),
    "anti_join_incremental": Query(anti_join_incremental, """
SELECT o_orderstatus, count(*) AS inserted, min(o_orderkey) AS first_key FROM orders t
WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_orderkey = t.o_orderkey AND b.o_orderkey % 3 <> 0)
GROUP BY o_orderstatus"""),
    "semi_join_keys": Query(semi_join_keys, """
WITH busy AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45)
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders JOIN busy ON l_orderkey = o_orderkey"""),
    "filters_range_in": Query(filters_range_in, """
SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN '1996-01-01' AND '1997-12-31' AND o_orderstatus IN ('F', 'O')"""),
    "filters_equal_any": Query(filters_equal_any, """
WITH t AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END AS late,
                  CASE WHEN o_custkey % 3 = 0 THEN o_orderstatus END AS odd FROM orders)
SELECT o_orderkey, late, odd FROM t
WHERE extract(year FROM o_orderdate) = 1997 AND (late IS NOT NULL OR odd IS NOT NULL)"""),
    "trailing_60d_hour": Query(trailing_60d_hour, """
SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour, count(*) AS n FROM events
WHERE ts >= (SELECT max(ts) - INTERVAL '10 days' FROM events) GROUP BY 1"""),
    "drop_incomplete": Query(drop_incomplete, """
SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders
WHERE o_orderkey % 4 > 0 AND o_custkey % 5 > 0"""),
    "numeric_clean": Query(numeric_clean, f"""
WITH t AS (SELECT o_orderkey, {_TEXT_NUMBER} AS raw FROM orders)
SELECT o_orderkey, CASE WHEN try_cast(raw AS DOUBLE) > 0 THEN try_cast(raw AS DOUBLE) ELSE 0 END AS at_least_zero,
       CASE WHEN round(coalesce(try_cast(raw AS DOUBLE), 3)) > 0
            THEN least(round(coalesce(try_cast(raw AS DOUBLE), 3)), 10) ELSE 0 END AS in_range
FROM t"""),
    "schema_evolution_union": Query(schema_evolution_union, """
SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 2 = 1"""),
    "union_relaxed": Query(union_relaxed, """
SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS nation FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR) FROM supplier"""),
    "to_header": Query(to_header, """
SELECT p_brand, CAST(NULL AS VARCHAR) AS p_missing, CAST(p_partkey AS VARCHAR) AS p_partkey FROM part"""),
    "rename_sanitize": Query(rename_sanitize, """
SELECT o_orderkey AS incident_number, o_orderdate AS alarm_dt_tm, o_custkey AS ems_units,
       o_totalprice AS zipcode_of_incident FROM orders"""),
    "overview_null_profile": Query(null_profile, """
WITH t AS (SELECT CASE WHEN event_id % 7 > 0 THEN value END AS value,
                  CASE WHEN user_id % 5 > 0 THEN event_type END AS event_type, ts FROM events),
c AS (SELECT count(*) AS total, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS v,
             CAST(sum(CASE WHEN event_type IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS e,
             CAST(sum(CASE WHEN ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS t FROM t)
SELECT 'value' AS column_name, total, v AS nulls, v / total * 100.0 AS null_percent FROM c
UNION ALL SELECT 'event_type', total, e, e / total * 100.0 FROM c
UNION ALL SELECT 'ts', total, t, t / total * 100.0 FROM c"""),
    "weekday_median_volume": Query(weekday_median_volume, """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, CAST(extract(dow FROM ts) AS INTEGER) AS dow, count(*) AS n
               FROM events GROUP BY 1, 2)
SELECT dow, percentile_cont(0.5) WITHIN GROUP (ORDER BY n) AS median_rows FROM daily GROUP BY dow"""),
    "weekday_median_60d": Query(weekday_median_60d, """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, CAST(extract(dow FROM ts) AS INTEGER) AS dow, count(*) AS n
               FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 60 DAY FROM events) GROUP BY 1, 2)
SELECT dow, percentile_cont(0.5) WITHIN GROUP (ORDER BY n) AS median_rows FROM daily GROUP BY dow"""),
    "hour_share": Query(hour_share, """
SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (), 9) AS share FROM events GROUP BY 1"""),
    "category_share_by_dow": Query(category_share_by_dow, """
WITH e AS (SELECT CAST(extract(isodow FROM ts) - 1 AS INTEGER) AS dow, event_type,
                  CASE WHEN user_id % 4 > 0 THEN 'k' || (user_id % 4) END AS user_kind FROM events),
u AS (SELECT dow, 'event_type' AS attribute, event_type AS value FROM e WHERE event_type IS NOT NULL
      UNION ALL SELECT dow, 'user_kind', user_kind FROM e WHERE user_kind IS NOT NULL)
SELECT dow, attribute, value, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY dow, attribute), 9) AS share
FROM u GROUP BY dow, attribute, value"""),
    "histogram": Query(histogram, """
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 60), 59) AS INTEGER) AS bin, count(*) AS n
      FROM lineitem, b GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + (hi - lo) * i / 60, 4) AS bin_start,
       round(lo + (hi - lo) * (i + 1) / 60, 4) AS bin_end, coalesce(n, 0) AS n
FROM range(60) r(i) CROSS JOIN b LEFT JOIN c ON c.bin = i"""),
    "exact_quantiles": Query(exact_quantiles, _QUANTILES),
    "exact_quantiles_by_rank": Query(exact_quantiles_by_rank, _QUANTILES),
    "table_counts": Query(table_counts, " UNION ALL ".join(
        f"SELECT '{n}' AS tbl, count(*) AS n FROM {n}"
        for n in ("orders", "lineitem", "customer", "events", "documents"))),
    "profile_min_max": Query(profile_min_max, """
SELECT min(o_orderdate) AS min_value, max(o_orderdate) AS max_value, count(*) AS n FROM orders"""),
    "sample_n_hash": Query(sample_n_hash, """
SELECT least(count(*), 2000) AS n, least(count(*), 2000) AS distinct_rows FROM lineitem"""),
    "top_k_ties": Query(top_k_ties, """
SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY l_partkey
ORDER BY n_lines DESC, l_partkey LIMIT 15"""),
    "having_top_avg": Query(having_top_avg, """
SELECT coalesce(CASE WHEN n_nationkey % 6 > 0 THEN n_name END, 'Unknown') AS nation,
       round(avg(CASE WHEN c_acctbal > 0 THEN c_acctbal END), 4) AS avg_bal
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
HAVING avg_bal IS NOT NULL ORDER BY avg_bal DESC, nation LIMIT 15"""),
    "gate_violations_orders": Query(gate_violations_orders, """
WITH t AS (SELECT *, CASE WHEN o_custkey % 9 > 0 THEN o_totalprice - 50000 END AS loss FROM orders)
SELECT 'table is empty' AS rule, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM t
UNION ALL SELECT 'loss is null', count(*) FILTER (WHERE loss IS NULL) FROM t
UNION ALL SELECT 'loss is negative', count(*) FILTER (WHERE loss < 0) FROM t
UNION ALL SELECT 'o_custkey is not positive', count(*) FILTER (WHERE o_custkey <= 0) FROM t"""),
    "ledger_contents": Query(ledger_contents, """
SELECT event_type AS pipeline_name, CAST(user_id AS VARCHAR) AS content_sha256,
       min(ts) AS first_success_at, max(ts) AS last_success_at FROM events GROUP BY 1, 2"""),
    "ledger_state": Query(ledger_runs, """
WITH e AS (SELECT *, CASE WHEN event_type IN ('view', 'click') THEN 'RUNNING' ELSE event_type END AS status
           FROM events)
SELECT CAST(user_id AS VARCHAR) AS run_id, 'p' AS pipeline_name,
       min(ts) FILTER (WHERE status = 'RUNNING') AS started_at,
       max(ts) FILTER (WHERE status <> 'RUNNING') AS finished_at,
       arg_max(status, ts) AS status, arg_min(event_type, ts) AS trigger_type, arg_min(props, ts) AS notes
FROM e GROUP BY user_id"""),
    "ledger_drop_status": Query(ledger_drop_status, """
SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'FAILED'
    WHEN md5(html) IN (SELECT md5(html) FROM pages WHERE page_id % 4 = 0) THEN 'SKIPPED' ELSE 'PENDING' END AS status,
  CASE WHEN page_id % 11 = 0 THEN 'unreadable'
    WHEN md5(html) IN (SELECT md5(html) FROM pages WHERE page_id % 4 = 0) THEN 'already_ingested' END AS error_message
FROM pages"""),
}
