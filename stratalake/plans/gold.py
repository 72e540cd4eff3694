"""Gold: a star schema of date, type and location dimensions and an incident fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import casts, keys, times
from stratalake.operators import joins, shape
from stratalake.operators.filters import any_not_null
from stratalake.operators.surrogate import ordered_ids, unordered_ids

# The location attributes in the order in which they are hashed.
LOCATION_COLUMNS = (
    "address", "city", "zipcode", "neighborhood", "battalion", "station_area",
    "supervisor_district", "fire_prevention_district", "box", "location_point",
)
TYPE_COLUMNS = ("call_type", "call_type_group", "primary_situation", "final_priority")

# Call and incident columns behind each location attribute that both sides can fill.
_SHARED_TEXT = {
    "address": ("address", "address"),
    "city": ("city", "city"),
    "neighborhood": ("neighborhoods_analysis_boundaries", "neighborhood_district"),
    "battalion": ("battalion", "battalion"),
    "station_area": ("station_area", "station_area"),
    "box": ("box", "box"),
    "location_point": ("location", "location"),
}
_SHARED_NUMBERS = {
    "zipcode": ("zipcode_of_incident", "zipcode"),
    "supervisor_district": ("supervisor_district", "supervisor_district"),
}
_RESOURCES = (
    "suppression_units", "suppression_personnel", "ems_units", "ems_personnel",
    "other_units", "other_personnel", "estimated_property_loss", "estimated_contents_loss",
)
FACT_COLUMNS = (
    "incident_number", "call_number", "date_id", "location_id", "incident_type_id",
    "received_ts", "dispatch_ts", "response_ts", "on_scene_ts", "close_ts",
    "response_time_sec", "dispatch_delay_sec", "travel_time_sec", "incident_duration_sec",
    "number_of_alarms", *_RESOURCES, "final_priority",
)


def matched_calls(calls: DataFrame, incidents: DataFrame) -> DataFrame:
    """Each call with its incident, cleaned location and type columns and the location key.

    The two dimensions and the fact all come from this one join. Calls without an incident
    number stay and take part in the location dimension.
    """
    incident_side = incidents.select(
        "incident_number",
        *[F.col(name).alias(f"i_{name}") for name in incidents.columns if name != "incident_number"],
    )
    joined = joins.spread_left_join(calls, incident_side, ["incident_number"], ["call_number"])
    location = {
        name: casts.first_text(F.col(call), F.col(f"i_{incident}"))
        for name, (call, incident) in _SHARED_TEXT.items()
    }
    location |= {
        name: F.coalesce(F.col(call), F.col(f"i_{incident}"))
        for name, (call, incident) in _SHARED_NUMBERS.items()
    }
    location["fire_prevention_district"] = casts.blank_to_null(F.col("fire_prevention_district"))
    cleaned = joined.select(
        "call_number", "incident_number",
        "received_ts", "dispatch_ts", "response_ts", "on_scene_ts",
        F.col("i_close_ts").alias("close_ts"),
        "response_time_sec", "dispatch_delay_sec", "travel_time_sec",
        times.seconds_between(F.col("received_ts"), F.col("i_close_ts")).alias("incident_duration_sec"),
        F.coalesce("number_of_alarms", "i_number_of_alarms").alias("number_of_alarms"),
        *[F.col(f"i_{name}").alias(name) for name in _RESOURCES],
        casts.blank_to_null(F.col("call_type")).alias("call_type"),
        casts.blank_to_null(F.col("call_type_group")).alias("call_type_group"),
        casts.blank_to_null(F.col("i_primary_situation")).alias("primary_situation"),
        "final_priority",
        F.coalesce("i_incident_date", "call_date").alias("event_date"),
        any_not_null(
            ["call_type", "call_type_group", "final_priority", "i_primary_situation"]
        ).alias("has_type"),
        *[location[name].alias(name) for name in LOCATION_COLUMNS],
    )
    return with_location_key(cleaned)


def location_key() -> Column:
    return keys.text_key([F.col(name) for name in LOCATION_COLUMNS])


def with_location_key(rows: DataFrame) -> DataFrame:
    """Adds the location key; a hash hardly compresses, so stored rows do without it."""
    return rows.withColumn("location_key", location_key())


def calendar(days: DataFrame) -> DataFrame:
    """Date dimension columns for a frame with one date column ``d``."""
    d = F.col("d")
    return days.select(
        times.date_key(d).alias("date_id"),
        d.alias("date"),
        times.year(d).alias("year"),
        times.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        times.weekday_sunday0(d).alias("weekday"),
        times.iso_week(d).alias("week_of_year"),
        times.is_weekend(d).alias("is_weekend"),
    )


def dim_date(calls: DataFrame, incidents: DataFrame) -> DataFrame:
    """Every day on which a call or an incident is dated."""
    call_days = calls.select(F.col("call_date").alias("d")).dropna()
    incident_days = incidents.select(F.col("incident_date").alias("d")).dropna()
    return calendar(shape.union_distinct(call_days, incident_days))


def dim_incident_type(matched: DataFrame, unknown_member: bool = True) -> DataFrame:
    """Distinct type combinations, numbered in their order.

    With ``unknown_member`` a call without any type attribute gets a row too; without it such
    calls are left out, and their facts have no type id.
    """
    return ordered_ids(type_members(matched, unknown_member), TYPE_COLUMNS, "incident_type_id")


def type_members(matched: DataFrame, unknown_member: bool = True) -> DataFrame:
    rows = matched.filter(F.col("incident_number").isNotNull())
    if not unknown_member:
        rows = rows.filter("has_type")
    return rows.select(*TYPE_COLUMNS).distinct()


def dim_location(matched: DataFrame) -> DataFrame:
    """Distinct locations, numbered in the order of their key."""
    found = with_location_key(places(matched)).select("location_key", *LOCATION_COLUMNS)
    return ordered_ids(found, ["location_key"], "location_id")


def places(matched: DataFrame) -> DataFrame:
    return matched.select(*LOCATION_COLUMNS).distinct()


def fact_rows(matched: DataFrame, dates: DataFrame, types: DataFrame, locations: DataFrame) -> DataFrame:
    """Facts without a surrogate key: one row per call and matching incident."""
    events = matched.filter(
        F.col("incident_number").isNotNull() & F.col("event_date").isNotNull()
    ).drop(*LOCATION_COLUMNS)
    spread = ["call_number"]
    dated = joins.lookup(
        events, dates.select("date_id", F.col("date").alias("event_date")), ["event_date"], spread
    )
    placed = joins.lookup(
        dated, locations.select("location_id", "location_key"), ["location_key"], spread
    )
    kinds = types.select("incident_type_id", *TYPE_COLUMNS)
    return joins.lookup(placed, kinds, TYPE_COLUMNS, spread, null_safe=True).select(*FACT_COLUMNS)


def fact_incident(matched: DataFrame, dates: DataFrame, types: DataFrame, locations: DataFrame,
                  order_by: Sequence[str] = ()) -> DataFrame:
    """Facts with a dense id: in no particular order, or in the order of some columns."""
    rows = fact_rows(matched, dates, types, locations)
    if order_by:
        return ordered_ids(rows, order_by, "incident_id")
    return unordered_ids(rows, "incident_id")
