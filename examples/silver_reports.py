"""Reports on silver tables of the sample data."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from examples.mapping import SILVER_CTE, Query, star_store, table
from stratalake.functions import times
from stratalake.operators import aggregates as agg
from stratalake.plans import forest, profile, reports
from stratalake.plans.reports import CallFilter, Health
from stratalake.session import materialize, scratch_path

_CHOSEN = CallFilter("1995-01-01", "1999-12-31", groups=["A", "R"], battalions=["B1", "B2", "B3", "B4"])
_WHERE = (
    "call_date BETWEEN DATE '1995-01-01' AND DATE '1999-12-31' AND call_type_group IN ('A', 'R') "
    "AND battalion IN ('B1', 'B2', 'B3', 'B4')"
)
_INCIDENT_RANGE = "incident_date BETWEEN DATE '1995-01-01' AND DATE '1999-12-31'"


def _calls(spark, sf):
    return star_store(spark, sf).read("silver.calls_clean")


def _chosen_calls(spark, sf):
    return _CHOSEN.apply(_calls(spark, sf))


def _chosen_incidents(spark, sf):
    incidents = star_store(spark, sf).read("silver.incidents_clean")
    return reports.incidents_of_calls(incidents, _calls(spark, sf), _CHOSEN)


def silver_overview(spark, sf):
    found = reports.overview(_chosen_calls(spark, sf))
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c.endswith("_sec")})


def missing_durations(spark, sf):
    return reports.missing_durations(_chosen_calls(spark, sf))


def calls_by_month(spark, sf):
    return reports.calls_by_month(_chosen_calls(spark, sf))


def silver_response_by_month(spark, sf):
    return reports.response_by_month(_chosen_calls(spark, sf)).withColumn("avg_resp", F.round("avg_resp", 6))


def response_histogram(spark, sf):
    found = reports.response_histogram(_calls(spark, sf), _CHOSEN, sample=None)
    return found.withColumns({c: F.round(c, 4) for c in ("bin_start", "bin_end")})


def top_call_types(spark, sf):
    return reports.top_call_types(_chosen_calls(spark, sf))


def slowest_neighborhoods(spark, sf):
    return reports.slowest_neighborhoods(_chosen_calls(spark, sf)).withColumn(
        "avg_resp", F.round("avg_resp", 6))


def semi_join_severity(spark, sf):
    return reports.severity_totals(_chosen_incidents(spark, sf))


def top_situations(spark, sf):
    return reports.top_situations(_chosen_incidents(spark, sf))


def month_trunc_loss(spark, sf):
    return reports.loss_by_month(_chosen_incidents(spark, sf))


def call_filter_options(spark, sf):
    from stratalake.plans.kpi import filter_options

    return filter_options(_calls(spark, sf), ["call_type_group", "city", "battalion"])


def health_report(spark, sf):
    store = star_store(spark, sf)
    return reports.health({
        "silver.calls_clean": Health(
            store.read("silver.calls_clean"),
            null_columns=["received_ts", "on_scene_ts", "dispatch_ts", "response_time_sec"],
            not_negative=["response_time_sec"],
        ),
        "gold.dim_date": Health(store.read("gold.dim_date"), range_columns=["date"]),
        "silver.incidents_clean": Health(
            store.read("silver.incidents_clean"), null_columns=["incident_date"],
            range_columns=["estimated_property_loss"],
        ),
    })


def profile_features(spark, sf):
    calls = _calls(spark, sf)
    found = profile.feature_table(calls)
    return found.select(
        "call_number", *profile.FEATURES,
        *[F.col(c).alias(f"y_{c}") for c in profile.TARGETS],
    )


def derive_parent_min(spark, sf):
    raw = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("Incident Number"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("Call Number"),
        times.raw_timestamp_text(F.col("l_shipdate")).alias("Received DtTm"),
    )
    return profile.derive_incidents(raw, ["IncidentNumber", "CallNumber", "IncidentDate", "AlarmDtTm", "Box"])


def rebuild_times(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("received_ts"), (F.col("user_id") * 1.4).alias("dispatch_delay_sec"),
        (F.col("user_id") * 2.3).alias("travel_time_sec"), (F.col("user_id") * 3.7).alias("response_time_sec"),
    )
    return profile.rebuild_times(events).select("event_id", "dispatch_ts", "on_scene_ts", "response_ts")


def hour_volume_by_type(spark, sf):
    return agg.group_counts(
        profile.time_features(table(spark, sf, "events"), "ts"), ["hour", "is_weekend", "event_type"], "n")


def rf_predict(spark, sf):
    """Forest per target on the calls, as the operator trains it; predictions for every call, averaged by cell."""
    features = profile.feature_table(_calls(spark, sf))
    # Calls of a cell have the same inputs and so one prediction.
    cells = features.groupBy(*profile.FEATURES).agg(
        agg.rows().alias("n"), *[F.avg(c).alias(f"actual_{c}") for c in profile.TARGETS])
    found = profile.predict(profile.train_forest(features), cells)
    return found.select(*profile.FEATURES, "n", *[f"pred_{c}" for c in profile.TARGETS], *[f"actual_{c}" for c in profile.TARGETS])


def forest_cells(spark, sf):
    """A forest from cell statistics, stored and loaded: rows, actual averages, and whether predictions lie in their target's range."""
    statistics = materialize(forest.cell_statistics(profile.feature_table(_calls(spark, sf)), "call_number"), "cell-statistics")
    folder = scratch_path(spark, "forest-model")
    forest.store_forest(forest.grow_forest(statistics), folder)
    found = forest.predict_cells(forest.load_forest(spark, folder), forest.cells(statistics))
    ranges = statistics.agg(*[f(f"{n}_{t}").alias(f"{n}_{t}") for t in profile.TARGETS for n, f in (("min", F.min), ("max", F.max))]).first()
    within = [F.col(f"pred_{t}").between(ranges[f"min_{t}"] - 1e-6, ranges[f"max_{t}"] + 1e-6) for t in profile.TARGETS]
    return found.select(*profile.FEATURES, "n", *[F.round(f"actual_{t}", 6).alias(f"actual_{t}") for t in profile.TARGETS],
                        reduce(and_, within).alias("within"))


def _silver_sql(select: str) -> str:
    return f"WITH {SILVER_CTE}, chosen AS (SELECT * FROM calls WHERE {_WHERE}),\n" \
           f"keys AS (SELECT DISTINCT incident_number FROM chosen WHERE incident_number IS NOT NULL),\n" \
           f"picked AS (SELECT i.* FROM incidents i JOIN keys USING (incident_number) WHERE {_INCIDENT_RANGE})\n" \
           f"{select}"


def _null_row(column: str) -> str:
    nulls = f"CAST(sum(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
    return (f"SELECT '{column}' AS column_name, count(*) AS total, {nulls} AS nulls, "
            f"{nulls} / count(*) * 100.0 AS null_percent FROM chosen")


_DURATIONS = ("response_time_sec", "dispatch_delay_sec", "travel_time_sec")

QUERIES = {
    "silver_overview": Query(silver_overview, _silver_sql("""
SELECT count(*) AS total_calls, round(avg(response_time_sec), 6) AS avg_response_sec,
  round(quantile_cont(response_time_sec, 0.5), 6) AS median_response_sec,
  round(quantile_cont(response_time_sec, 0.9), 6) AS p90_response_sec,
  CAST(sum(CASE WHEN response_time_sec IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_response_time
FROM chosen""")),
    "missing_durations": Query(missing_durations, _silver_sql(" UNION ALL ".join(map(_null_row, _DURATIONS)))),
    "calls_by_month": Query(calls_by_month, _silver_sql("""
SELECT CAST(date_trunc('month', call_date) AS TIMESTAMP) AS month, count(*) AS calls FROM chosen GROUP BY 1""")),
    "silver_response_by_month": Query(silver_response_by_month, _silver_sql("""
SELECT CAST(date_trunc('month', call_date) AS TIMESTAMP) AS month, round(avg(response_time_sec), 6) AS avg_resp
FROM chosen WHERE response_time_sec IS NOT NULL GROUP BY 1""")),
    "response_histogram": Query(response_histogram, _silver_sql("""
, v AS (SELECT CAST(response_time_sec AS DOUBLE) AS v FROM chosen WHERE response_time_sec IS NOT NULL),
b AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
c AS (SELECT CAST(least(floor((v - lo) / (hi - lo) * 60), 59) AS INTEGER) AS bin, count(*) AS n FROM v, b GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + (hi - lo) * i / 60, 4) AS bin_start,
       round(lo + (hi - lo) * (i + 1) / 60, 4) AS bin_end, coalesce(n, 0) AS n
FROM range(60) r(i) CROSS JOIN b LEFT JOIN c ON c.bin = i""")),
    "top_call_types": Query(top_call_types, _silver_sql("""
SELECT call_type, count(*) AS n FROM chosen WHERE call_type IS NOT NULL GROUP BY 1
ORDER BY n DESC, call_type LIMIT 15""")),
    "slowest_neighborhoods": Query(slowest_neighborhoods, _silver_sql("""
SELECT coalesce(neighborhoods_analysis_boundaries, 'Unknown') AS neighborhood,
       round(avg(response_time_sec), 6) AS avg_resp
FROM chosen GROUP BY 1 HAVING avg_resp IS NOT NULL ORDER BY avg_resp DESC, neighborhood LIMIT 15""")),
    "semi_join_severity": Query(semi_join_severity, _silver_sql("""
SELECT count(*) AS total_incidents,
  CAST(sum(coalesce(estimated_property_loss, 0)) AS BIGINT) AS prop_loss,
  CAST(sum(coalesce(estimated_contents_loss, 0)) AS BIGINT) AS cont_loss,
  CAST(sum(coalesce(fire_injuries, 0)) AS BIGINT) AS fire_injuries,
  CAST(sum(coalesce(fire_fatalities, 0)) AS BIGINT) AS fire_fatalities,
  CAST(sum(coalesce(civilian_injuries, 0)) AS BIGINT) AS civ_injuries,
  CAST(sum(coalesce(civilian_fatalities, 0)) AS BIGINT) AS civ_fatalities
FROM picked""")),
    "top_situations": Query(top_situations, _silver_sql("""
SELECT coalesce(primary_situation, 'Unknown') AS primary_situation, count(*) AS n FROM picked GROUP BY 1
ORDER BY n DESC, primary_situation LIMIT 15""")),
    "month_trunc_loss": Query(month_trunc_loss, _silver_sql("""
SELECT CAST(date_trunc('month', incident_date) AS TIMESTAMP) AS month,
  CAST(sum(coalesce(estimated_property_loss, 0) + coalesce(estimated_contents_loss, 0)) AS BIGINT) AS total_loss
FROM picked GROUP BY 1""")),
    "call_filter_options": Query(call_filter_options, _silver_sql(" UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS field, {c} AS value FROM calls WHERE trim({c}) <> ''"
        for c in ("call_type_group", "city", "battalion")))),
    "health_report": Query(health_report, _silver_sql("""
, days AS (SELECT call_date AS d FROM calls WHERE call_date IS NOT NULL
           UNION SELECT incident_date FROM incidents WHERE incident_date IS NOT NULL),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE received_ts IS NULL) AS a,
        count(*) FILTER (WHERE on_scene_ts IS NULL) AS b, count(*) FILTER (WHERE dispatch_ts IS NULL) AS c,
        count(*) FILTER (WHERE response_time_sec IS NULL) AS d,
        count(*) FILTER (WHERE response_time_sec < 0) AS e FROM calls)
SELECT 'silver.calls_clean' AS tbl, 'rows' AS metric, CAST(n AS VARCHAR) AS value FROM c
UNION ALL SELECT 'silver.calls_clean', 'null received_ts', CAST(a AS VARCHAR) FROM c
UNION ALL SELECT 'silver.calls_clean', 'null on_scene_ts', CAST(b AS VARCHAR) FROM c
UNION ALL SELECT 'silver.calls_clean', 'null dispatch_ts', CAST(c AS VARCHAR) FROM c
UNION ALL SELECT 'silver.calls_clean', 'null response_time_sec', CAST(d AS VARCHAR) FROM c
UNION ALL SELECT 'silver.calls_clean', 'negative response_time_sec', CAST(e AS VARCHAR) FROM c
UNION ALL SELECT 'gold.dim_date', 'rows', CAST(count(*) AS VARCHAR) FROM days
UNION ALL SELECT 'gold.dim_date', 'min date', CAST(min(d) AS VARCHAR) FROM days
UNION ALL SELECT 'gold.dim_date', 'max date', CAST(max(d) AS VARCHAR) FROM days
UNION ALL SELECT 'silver.incidents_clean', 'rows', CAST(count(*) AS VARCHAR) FROM incidents
UNION ALL SELECT 'silver.incidents_clean', 'null incident_date',
  CAST(count(*) FILTER (WHERE incident_date IS NULL) AS VARCHAR) FROM incidents
UNION ALL SELECT 'silver.incidents_clean', 'min estimated_property_loss',
  CAST(min(estimated_property_loss) AS VARCHAR) FROM incidents
UNION ALL SELECT 'silver.incidents_clean', 'max estimated_property_loss',
  CAST(max(estimated_property_loss) AS VARCHAR) FROM incidents""")),
    "profile_features": Query(profile_features, _silver_sql("""
SELECT call_number, CAST(extract(hour FROM received_ts) AS INTEGER) AS hour,
  CAST(extract(isodow FROM received_ts) - 1 AS INTEGER) AS dow,
  CAST(extract(month FROM received_ts) AS INTEGER) AS month,
  CAST(CASE WHEN extract(isodow FROM received_ts) IN (6, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  CAST(dispatch_delay_sec AS DOUBLE) AS y_dispatch_delay_sec, CAST(travel_time_sec AS DOUBLE) AS y_travel_time_sec,
  CAST(response_time_sec AS DOUBLE) AS y_response_time_sec, CAST(number_of_alarms AS DOUBLE) AS y_number_of_alarms,
  CAST(final_priority AS DOUBLE) AS y_final_priority
FROM calls WHERE received_ts IS NOT NULL AND dispatch_delay_sec IS NOT NULL AND travel_time_sec IS NOT NULL
  AND response_time_sec IS NOT NULL AND number_of_alarms IS NOT NULL AND final_priority IS NOT NULL""")),
    "forest_cells": Query(forest_cells, _silver_sql(f"""
, rows AS (SELECT CAST(extract(hour FROM received_ts) AS INTEGER) AS hour, CAST(extract(isodow FROM received_ts) - 1 AS INTEGER) AS dow,
    CAST(extract(month FROM received_ts) AS INTEGER) AS month,
    CAST(CASE WHEN extract(isodow FROM received_ts) IN (6, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend, {", ".join(profile.TARGETS)}
  FROM calls WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ("received_ts", *profile.TARGETS))})
SELECT {", ".join(profile.FEATURES)}, count(*) AS n,
  {", ".join(f"round(avg({c}), 6) AS actual_{c}" for c in profile.TARGETS)}, TRUE AS within
FROM rows GROUP BY ALL""").replace("GROUP BY ALL", "GROUP BY hour, dow, month, is_weekend")),
    "derive_parent_min": Query(derive_parent_min, """
SELECT CAST(l_orderkey AS VARCHAR) AS "IncidentNumber",
  min(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)) AS "CallNumber",
  strftime(min(l_shipdate), '%m/%d/%Y') AS "IncidentDate",
  strftime(min(l_shipdate), '%m/%d/%Y %I:%M:%S %p') AS "AlarmDtTm", CAST(NULL AS VARCHAR) AS "Box"
FROM lineitem GROUP BY l_orderkey"""),
    "rebuild_times": Query(rebuild_times, """
SELECT event_id, ts + to_seconds(CAST(round_even(user_id * CAST(1.4 AS DOUBLE), 0) AS BIGINT)) AS dispatch_ts,
  ts + to_seconds(CAST(round_even(user_id * CAST(1.4 AS DOUBLE), 0) + round_even(user_id * CAST(2.3 AS DOUBLE), 0) AS BIGINT)) AS on_scene_ts,
  ts + to_seconds(CAST(round_even(user_id * CAST(3.7 AS DOUBLE), 0) AS BIGINT)) AS response_ts
FROM events"""),
    "hour_volume_by_type": Query(hour_volume_by_type, """
SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour,
  CAST(CASE WHEN extract(isodow FROM ts) IN (6, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  event_type, count(*) AS n FROM events GROUP BY 1, 2, 3"""),
    "rf_predict": Query(rf_predict),
}
