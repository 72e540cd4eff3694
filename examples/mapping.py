"""The sample tables in the roles of calls and incidents.

``lineitem`` plays the calls (with repeated call numbers), ``orders`` the incidents. The
expressions below are valid in Spark SQL and in DuckDB, so both sides of a check start from
the same rows. They add missing values, blanks, padding and events out of order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators import dedup
from stratalake.plans import gold, silver
from stratalake.plans.pipeline import stage_star
from stratalake.session import configure, scratch_path, side_by_side
from stratalake.sources.tables import Warehouse

_RECEIVED = "l_shipdate + (l_partkey * 37 % 80000) * INTERVAL '1' SECOND"

CALLS = {
    "call_number": "l_orderkey * 10 + l_linenumber",
    "incident_number": "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_orderkey END",
    "call_type": "CASE WHEN l_partkey % 13 = 0 THEN '   ' WHEN l_partkey % 11 = 0 THEN NULL "
                 "ELSE ' Type ' || (l_partkey % 9) || ' ' END",
    "call_type_group": "CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_returnflag END",
    "final_priority": "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) % 4 END",
    "call_date": "CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END",
    "received_ts": f"CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE {_RECEIVED} END",
    "dispatch_ts": f"CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE {_RECEIVED} "
                   "+ (l_suppkey % 300 - 20) * INTERVAL '1' SECOND END",
    "response_ts": f"{_RECEIVED} + (l_suppkey % 400) * INTERVAL '1' SECOND",
    "on_scene_ts": f"CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE {_RECEIVED} "
                   "+ ((l_partkey * 7 + l_suppkey * 11) % 2000 - 150) * INTERVAL '1' SECOND END",
    "address": "CASE WHEN l_suppkey % 3 = 0 THEN NULL WHEN l_suppkey % 8 = 0 THEN ' ' "
               "ELSE 'Road ' || (l_suppkey % 50) END",
    "city": "CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE ' City ' || (l_partkey % 5) END",
    "zipcode_of_incident": "CASE WHEN l_suppkey % 6 = 0 THEN NULL "
                           "ELSE CAST(94100 + l_suppkey % 30 AS INTEGER) END",
    "battalion": "CASE WHEN l_suppkey % 9 = 0 THEN '' ELSE 'B' || (l_suppkey % 10) END",
    "station_area": "'' || (l_suppkey % 12)",
    "box": "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE '' || (l_suppkey % 20) END",
    "supervisor_district": "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE CAST(l_suppkey % 11 AS INTEGER) END",
    "neighborhoods_analysis_boundaries": "CASE WHEN l_suppkey % 14 = 0 THEN NULL "
                                         "ELSE 'Hood ' || (l_suppkey % 15) END",
    "location": "CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE '(' || (l_suppkey % 6) || ')' END",
    "number_of_alarms": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE CAST(1 + l_partkey % 5 AS INTEGER) END",
    "unit_type": "l_linestatus",
    "fire_prevention_district": "CASE WHEN l_suppkey % 21 = 0 THEN ' ' ELSE '' || (l_suppkey % 7) END",
    "rowid": "l_partkey || '-' || l_suppkey || '-' || CAST(floor(l_extendedprice * 100) AS BIGINT) "
             "|| '-' || CAST(l_shipdate AS DATE)",
    "ingested_ts": "TIMESTAMP '2024-01-01 00:00:00' + (l_suppkey % 3) * INTERVAL '1' DAY",
}

INCIDENTS = {
    "incident_number": "o_orderkey",
    "call_number": "o_orderkey * 10 + 1",
    "incident_date": "CASE WHEN o_custkey % 19 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END",
    "alarm_ts": "o_orderdate",
    "close_ts": "CASE WHEN o_custkey % 16 = 0 THEN NULL "
                "ELSE o_orderdate + (o_custkey * 53 % 100000) * INTERVAL '1' SECOND END",
    "address": "CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN NULL "
               "ELSE 'Street ' || (o_custkey % 40) END",
    "city": "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE 'City ' || (o_custkey % 5) END",
    "zipcode": "CAST(94100 + o_custkey % 30 AS INTEGER)",
    "battalion": "'B' || (o_custkey % 10)",
    "station_area": "'' || (o_custkey % 12)",
    "box": "'' || (o_custkey % 20)",
    "supervisor_district": "CAST(o_custkey % 11 AS INTEGER)",
    "neighborhood_district": "'Hood ' || (o_custkey % 15)",
    "location": "'(' || (o_custkey % 6) || ')'",
    "number_of_alarms": "CAST(1 + o_orderkey % 3 AS INTEGER)",
    "suppression_units": "CAST(o_orderkey % 9 AS INTEGER)",
    "suppression_personnel": "CAST(o_orderkey % 31 AS INTEGER)",
    "ems_units": "CAST(o_custkey % 4 AS INTEGER)",
    "ems_personnel": "CASE WHEN o_custkey % 6 = 0 THEN NULL ELSE CAST(o_custkey % 13 AS INTEGER) END",
    "other_units": "CAST(o_orderkey % 2 AS INTEGER)",
    "other_personnel": "CAST(o_orderkey % 5 AS INTEGER)",
    "estimated_property_loss": "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END",
    "estimated_contents_loss": "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey * 10 END",
    "fire_fatalities": "CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE NULL END",
    "fire_injuries": "o_orderkey % 3",
    "civilian_fatalities": "CASE WHEN o_orderkey % 40 = 0 THEN 2 ELSE 0 END",
    "civilian_injuries": "o_custkey % 5",
    "primary_situation": "CASE WHEN o_orderkey % 12 = 0 THEN ' ' WHEN o_orderkey % 18 = 1 THEN NULL "
                         "ELSE o_orderpriority END",
}

# Rows that pass the silver gate: keys are above 0, received and dispatched are always known,
# and nothing but the received time and the row id ranks the rows of a call.
GATED_INCIDENTS = {**INCIDENTS, "incident_number": "o_orderkey + 1"}
GATED_CALLS = {
    **CALLS,
    "incident_number": "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_orderkey + 1 END",
    "received_ts": _RECEIVED,
    "dispatch_ts": f"{_RECEIVED} + (l_suppkey % 300 - 20) * INTERVAL '1' SECOND",
    "ingested_ts": "TIMESTAMP '2024-01-01 00:00:00'",
}

_LONGS = ("call_number", "incident_number", "fire_fatalities", "fire_injuries",
          "civilian_fatalities", "civilian_injuries")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _expressions(columns: dict[str, str]) -> list[str]:
    return [
        f"CAST({text} AS BIGINT) AS {name}" if name in _LONGS else f"{text} AS {name}"
        for name, text in columns.items()
    ]


def _ntz(columns: list[str]) -> list[str]:
    """Spark reads a TIMESTAMP literal with a zone; the samples have none."""
    return [c.replace("TIMESTAMP '", "TIMESTAMP_NTZ '") for c in columns]


def spark_expressions(columns: dict[str, str]) -> list[str]:
    """The expressions of some columns for Spark."""
    return _ntz(_expressions(columns))


def raw_calls(spark: SparkSession, sf_dir: str, columns: dict[str, str] = CALLS) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_ntz(_expressions(columns)))


#: Columns of ``lineitem`` that the calls are made of, and the call columns that rank the rows of a call.
_LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
                 "l_returnflag", "l_linestatus")
_RANKED_BY = ("received_ts", "ingested_ts", "rowid")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each call; the winners are found on the narrow rows of the table, and only they are spelled out."""
    def made(*names):
        return _ntz(_expressions({name: CALLS[name] for name in names}))

    lines = table(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS).selectExpr("*", *made("call_number"))
    dealt = dedup.by_key(lines, ["call_number"])
    # Rows that rank alike are told apart by a hash of the call, as in ``latest_calls`` of spelled-out calls.
    tie = ", ".join(text.rsplit(" AS ", 1)[0] for text in made(*CALLS))
    ranked = dealt.selectExpr("*", *made(*_RANKED_BY), f"xxhash64({tie}) AS _tie")
    latest = silver.latest_calls(ranked, dealt=True, tie="_tie")
    return silver.with_durations(latest.selectExpr(*made(*CALLS)))


def incidents(spark: SparkSession, sf_dir: str, columns: dict[str, str] = INCIDENTS) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_ntz(_expressions(columns)))


def _duration(start: str, end: str) -> str:
    seconds = f"datediff('second', {start}, {end})"
    return f"CASE WHEN {seconds} >= 0 THEN {seconds} END"


def latest_calls_cte(columns: dict[str, str] = CALLS) -> str:
    return f"""raw_calls AS (SELECT {', '.join(_expressions(columns))} FROM lineitem),
latest_calls AS (
  SELECT * FROM raw_calls
  QUALIFY row_number() OVER (
    PARTITION BY call_number
    ORDER BY coalesce(received_ts, TIMESTAMP '1900-01-01') DESC,
             coalesce(ingested_ts, TIMESTAMP '1900-01-01') DESC, rowid DESC NULLS LAST) = 1)"""


def silver_cte(call_columns: dict[str, str] = CALLS,
               incident_columns: dict[str, str] = INCIDENTS) -> str:
    return f"""{latest_calls_cte(call_columns)},
calls AS (
  SELECT *, {_duration('received_ts', 'on_scene_ts')} AS response_time_sec,
         {_duration('received_ts', 'dispatch_ts')} AS dispatch_delay_sec,
         {_duration('dispatch_ts', 'on_scene_ts')} AS travel_time_sec
  FROM latest_calls),
incidents AS (SELECT {', '.join(_expressions(incident_columns))} FROM orders)"""


LATEST_CALLS_CTE = latest_calls_cte()
SILVER_CTE = silver_cte()

_KEY = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in gold.LOCATION_COLUMNS)
_FACT_SOURCE = ", ".join(
    c for c in gold.FACT_COLUMNS if c not in ("date_id", "location_id", "incident_type_id")
)
_STAR_CTE = f"""
joined AS (
  SELECT c.call_number, c.incident_number, c.received_ts, c.dispatch_ts, c.response_ts,
         c.on_scene_ts, i.close_ts, c.response_time_sec, c.dispatch_delay_sec, c.travel_time_sec,
         {_duration('c.received_ts', 'i.close_ts')} AS incident_duration_sec,
         coalesce(c.number_of_alarms, i.number_of_alarms) AS number_of_alarms,
         i.suppression_units, i.suppression_personnel, i.ems_units, i.ems_personnel,
         i.other_units, i.other_personnel, i.estimated_property_loss, i.estimated_contents_loss,
         nullif(trim(c.call_type), '') AS call_type,
         nullif(trim(c.call_type_group), '') AS call_type_group,
         nullif(trim(i.primary_situation), '') AS primary_situation,
         c.final_priority, coalesce(i.incident_date, c.call_date) AS event_date,
         nullif(trim(coalesce(c.address, i.address)), '') AS address,
         nullif(trim(coalesce(c.city, i.city)), '') AS city,
         coalesce(c.zipcode_of_incident, i.zipcode) AS zipcode,
         nullif(trim(coalesce(c.neighborhoods_analysis_boundaries, i.neighborhood_district)), '')
           AS neighborhood,
         nullif(trim(coalesce(c.battalion, i.battalion)), '') AS battalion,
         nullif(trim(coalesce(c.station_area, i.station_area)), '') AS station_area,
         coalesce(c.supervisor_district, i.supervisor_district) AS supervisor_district,
         nullif(trim(c.fire_prevention_district), '') AS fire_prevention_district,
         nullif(trim(coalesce(c.box, i.box)), '') AS box,
         nullif(trim(coalesce(c.location, i.location)), '') AS location_point
  FROM calls c LEFT JOIN incidents i ON i.incident_number = c.incident_number),
matched AS (SELECT *, md5({_KEY}) AS location_key FROM joined),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, d AS date,
         CAST(extract(year FROM d) AS INTEGER) AS year,
         CAST(extract(month FROM d) AS INTEGER) AS month,
         CAST(extract(day FROM d) AS INTEGER) AS day,
         CAST(extract(dow FROM d) AS INTEGER) AS weekday,
         CAST(extract(week FROM d) AS INTEGER) AS week_of_year,
         extract(dow FROM d) IN (0, 6) AS is_weekend
  FROM (SELECT call_date AS d FROM calls WHERE call_date IS NOT NULL
        UNION SELECT incident_date FROM incidents WHERE incident_date IS NOT NULL)),
dim_incident_type AS (
  SELECT row_number() OVER (ORDER BY call_type NULLS LAST, call_type_group NULLS LAST,
           primary_situation NULLS LAST, final_priority NULLS LAST) AS incident_type_id, *
  FROM (SELECT DISTINCT call_type, call_type_group, primary_situation, final_priority
        FROM matched WHERE incident_number IS NOT NULL)),
dim_location AS (
  SELECT row_number() OVER (ORDER BY location_key) AS location_id, *
  FROM (SELECT DISTINCT location_key, {', '.join(gold.LOCATION_COLUMNS)} FROM matched)),
fact AS (
  SELECT {', '.join('m.' + c for c in _FACT_SOURCE.split(', '))},
         d.date_id, l.location_id, t.incident_type_id
  FROM matched m
  LEFT JOIN dim_date d ON d.date = m.event_date
  LEFT JOIN dim_location l ON l.location_key = m.location_key
  LEFT JOIN dim_incident_type t
    ON t.call_type IS NOT DISTINCT FROM m.call_type
   AND t.call_type_group IS NOT DISTINCT FROM m.call_type_group
   AND t.primary_situation IS NOT DISTINCT FROM m.primary_situation
   AND t.final_priority IS NOT DISTINCT FROM m.final_priority
  WHERE m.incident_number IS NOT NULL AND m.event_date IS NOT NULL),
star AS (
  SELECT f.*, d.year, d.month, d.weekday, t.call_type, t.call_type_group, t.primary_situation,
         l.neighborhood, l.battalion, l.station_area, l.city
  FROM fact f JOIN dim_date d USING (date_id)
  JOIN dim_incident_type t USING (incident_type_id)
  JOIN dim_location l USING (location_id))"""


def gold_cte(call_columns: dict[str, str] = CALLS,
             incident_columns: dict[str, str] = INCIDENTS) -> str:
    return f"{silver_cte(call_columns, incident_columns)},{_STAR_CTE}"


GOLD_CTE = gold_cte()


@dataclass(frozen=True)
class Query:
    """A Spark query and the same query in SQL; without SQL only its rows are checked."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


_stores: dict[tuple[str, str], Warehouse] = {}


def star_store(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star schema of the sample tables, built once per session and folder."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        store = Warehouse(spark, scratch_path(spark, "star"))
        build_star(spark, sf_dir, store)
        _stores[key] = store
    return _stores[key]


def build_star(spark: SparkSession, sf_dir: str, store: Warehouse) -> None:
    silver_tables = side_by_side(
        lambda: store.stage("silver.calls_clean", calls(spark, sf_dir), "call_date"),
        lambda: store.stage("silver.incidents_clean", incidents(spark, sf_dir), "incident_date"),
    )
    star = stage_star(store, *map(store.read_staged, silver_tables))
    store.publish(*silver_tables, *star.values())
