"""Silver: typed, deduplicated calls and incidents from all-text bronze tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import casts, times
from stratalake.functions.names import optional_column, required_column
from stratalake.operators.dedup import by_key, keep_first, newest_first

_DTYPES = {
    "text": "string", "int": "int", "long": "bigint", "amount": "bigint",
    "date": "date", "timestamp": "timestamp_ntz",
}


@dataclass(frozen=True)
class Field:
    """A silver column: its kind and the bronze names it may come from, best first."""

    name: str
    kind: str
    candidates: tuple[str, ...] = ()
    required: bool = False

    def column(self, bronze: DataFrame) -> Column:
        names = self.candidates or (self.name,)
        if self.required:
            raw = required_column(bronze, *names).cast("string")
        else:
            raw = optional_column(bronze, *names).cast("string")
        return self._typed(raw).cast(_DTYPES[self.kind]).alias(self.name)

    def _typed(self, raw: Column) -> Column:
        if self.kind == "int":
            return casts.to_integer(raw)
        if self.kind == "long":
            return casts.to_long(raw)
        if self.kind == "amount":
            return casts.drop_negative(casts.to_long(raw))
        if self.kind == "date":
            return times.parse_date(raw)
        if self.kind == "timestamp":
            return times.parse_timestamp(raw)
        return raw


# Output columns of silver calls and the bronze names each may have.
CALL_FIELDS = (
    Field("call_number", "long", ("call_number", "callnumber"), required=True),
    Field("incident_number", "long", ("incident_number", "incidentnumber"), required=True),
    Field("unit_id", "text"),
    Field("call_type", "text"),
    Field("call_type_group", "text"),
    Field("original_priority", "int"),
    Field("priority", "int"),
    Field("final_priority", "int"),
    Field("als_unit", "text"),
    Field("call_date", "date"),
    Field("watch_date", "date"),
    Field("received_ts", "timestamp", ("received_dt_tm", "received_dttm"), required=True),
    Field("entry_ts", "timestamp", ("entry_dt_tm", "entry_dttm")),
    Field("dispatch_ts", "timestamp", ("dispatch_dt_tm", "dispatch_dttm")),
    Field("response_ts", "timestamp", ("response_dt_tm", "response_dttm")),
    Field("on_scene_ts", "timestamp", ("on_scene_dt_tm", "on_scene_dttm")),
    Field("transport_ts", "timestamp", ("transport_dt_tm", "transport_dttm")),
    Field("hospital_ts", "timestamp", ("hospital_dt_tm", "hospital_dttm")),
    Field("available_ts", "timestamp", ("available_dt_tm", "available_dttm")),
    Field("address", "text"),
    Field("city", "text"),
    Field("zipcode_of_incident", "int",
          ("zipcode_of_incident", "zipcodeofincident", "zipcode_ofincident")),
    Field("battalion", "text"),
    Field("station_area", "text"),
    Field("box", "text"),
    Field("supervisor_district", "int", ("supervisor_district", "supervisordistrict")),
    Field("neighborhoods_analysis_boundaries", "text",
          ("neighborhoods_analysis_boundaries", "neighborhooods_analysis_boundaries",
           "neighborhooods___analysis_boundaries")),
    Field("location", "text"),
    Field("call_final_disposition", "text"),
    Field("number_of_alarms", "int", ("number_of_alarms", "numberof_alarms", "numberofalarms")),
    Field("unit_type", "text"),
    Field("unit_sequence_in_call_dispatch", "int",
          ("unit_sequence_in_call_dispatch", "unitsequence_in_call_dispatch",
           "unitsequenceincalldispatch")),
    Field("fire_prevention_district", "text"),
    Field("rowid", "text", ("rowid", "row_id")),
    Field("ingested_ts", "timestamp", ("_ingested_at_utc",)),
)

# Output columns of silver incidents and the bronze names each may have.
INCIDENT_FIELDS = (
    Field("incident_number", "long", ("incident_number", "incidentnumber"), required=True),
    Field("call_number", "long", ("call_number", "callnumber"), required=True),
    Field("exposure_number", "int", ("exposure_number", "exposurenumber")),
    Field("incident_date", "date", ("incident_date", "incidentdate"), required=True),
    Field("alarm_ts", "timestamp", ("alarm_dt_tm", "alarm_dttm", "alarmdttm"), required=True),
    Field("arrival_ts", "timestamp", ("arrival_dt_tm", "arrival_dttm", "arrivaldttm")),
    Field("close_ts", "timestamp", ("close_dt_tm", "close_dttm", "closedttm")),
    Field("address", "text"),
    Field("city", "text"),
    Field("zipcode", "int", ("zipcode", "zip_code", "zip")),
    Field("battalion", "text"),
    Field("station_area", "text", ("station_area", "stationarea")),
    Field("box", "text"),
    Field("supervisor_district", "int", ("supervisor_district", "supervisordistrict")),
    Field("neighborhood_district", "text", ("neighborhood_district", "neighborhooddistrict")),
    Field("location", "text"),
    Field("number_of_alarms", "int", ("number_of_alarms", "numberof_alarms", "numberofalarms")),
    Field("suppression_units", "int", ("suppression_units", "suppressionunits")),
    Field("suppression_personnel", "int", ("suppression_personnel", "suppressionpersonnel")),
    Field("ems_units", "int", ("ems_units", "emsunits")),
    Field("ems_personnel", "int", ("ems_personnel", "emspersonnel")),
    Field("other_units", "int", ("other_units", "otherunits")),
    Field("other_personnel", "int", ("other_personnel", "otherpersonnel")),
    Field("estimated_property_loss", "amount",
          ("estimated_property_loss", "estimatedpropertyloss")),
    Field("estimated_contents_loss", "amount",
          ("estimated_contents_loss", "estimatedcontentsloss")),
    Field("fire_fatalities", "long", ("fire_fatalities", "firefatalities")),
    Field("fire_injuries", "long", ("fire_injuries", "fireinjuries")),
    Field("civilian_fatalities", "long", ("civilian_fatalities", "civilianfatalities")),
    Field("civilian_injuries", "long", ("civilian_injuries", "civilianinjuries")),
    Field("primary_situation", "text", ("primary_situation", "primarysituation")),
    Field("mutual_aid", "text", ("mutual_aid", "mutualaid")),
)

# Further incident columns that only the full refresh keeps.
INCIDENT_DETAIL_FIELDS = (
    Field("action_taken_primary", "text"),
    Field("action_taken_secondary", "text"),
    Field("action_taken_other", "text"),
    Field("detector_alerted_occupants", "text"),
    Field("property_use", "text"),
    Field("area_of_fire_origin", "text",
          ("areaof_fire_origin", "area_of_fire_origin", "areaoffireorigin")),
    Field("ignition_cause", "text"),
    Field("ignition_factor_primary", "text"),
    Field("ignition_factor_secondary", "text"),
    Field("heat_source", "text"),
    Field("item_first_ignited", "text"),
    Field("human_factors_associated_with_ignition", "text",
          ("human_factors_associatedwith_ignition", "human_factors_associated_with_ignition",
           "humanfactorsassociatedwithignition")),
    Field("structure_type", "text"),
    Field("structure_status", "text"),
    Field("floor_of_fire_origin", "text",
          ("floorof_fire_origin", "floor_of_fire_origin", "flooroffireorigin")),
    Field("fire_spread", "text"),
    Field("no_flame_spead", "text"),
    Field("floors_min_damage", "int",
          ("numberoffloorswithminimumdamage", "number_of_floors_with_minimum_damage")),
    Field("floors_significant_damage", "int",
          ("numberoffloorswithsignificantdamage", "number_of_floors_with_significant_damage")),
    Field("floors_heavy_damage", "int",
          ("numberoffloorswithheavydamage", "number_of_floors_with_heavy_damage")),
    Field("floors_extreme_damage", "int",
          ("numberoffloorswithextremedamage", "number_of_floors_with_extreme_damage")),
    Field("detectors_present", "text"),
    Field("detector_type", "text"),
    Field("detector_operation", "text"),
    Field("detector_effectiveness", "text"),
    Field("detector_failure_reason", "text"),
    Field("automatic_extinguishing_system_present", "text",
          ("automatic_extinguishing_system_present", "automaticextinguishingsystempresent")),
    Field("automatic_extinguishing_system_type", "text",
          ("automatic_extinguishing_sytem_type", "automatic_extinguishing_system_type",
           "automaticextinguishingsytemtype")),
    Field("automatic_extinguishing_system_performance", "text",
          ("automatic_extinguishing_sytem_perfomance",
           "automatic_extinguishing_system_performance",
           "automaticextinguishingsytemperfomance")),
    Field("automatic_extinguishing_system_failure_reason", "text",
          ("automatic_extinguishing_sytem_failure_reason",
           "automatic_extinguishing_system_failure_reason",
           "automaticextinguishingsytemfailurereason")),
    Field("sprinkler_heads_operating", "int",
          ("numberof_sprinkler_heads_operating", "number_of_sprinkler_heads_operating",
           "numberofsprinklerheadsoperating")),
    Field("first_unit_on_scene", "text"),
)

BY_INCIDENT = ("incident_number",)
BY_INCIDENT_AND_CALL = ("incident_number", "call_number")


def typed(bronze: DataFrame, fields: Sequence[Field]) -> DataFrame:
    return bronze.select([field.column(bronze) for field in fields])


def with_durations(calls: DataFrame) -> DataFrame:
    """Response, dispatch and travel seconds from the parsed timestamps."""
    received, dispatch, on_scene = (F.col(c) for c in ("received_ts", "dispatch_ts", "on_scene_ts"))
    return calls.withColumns(
        {
            "response_time_sec": times.seconds_between(received, on_scene),
            "dispatch_delay_sec": times.seconds_between(received, dispatch),
            "travel_time_sec": times.seconds_between(dispatch, on_scene),
        }
    )


def latest_calls(calls: DataFrame, dealt: bool = False, tie: str | None = None,
                 dealt_by: Sequence[Column] = ()) -> DataFrame:
    """One row per call: latest received, then latest ingested, then greatest row id.

    ``dealt`` rows lie by their call number already, or by expressions ``dealt_by`` of it; ``tie`` names a column with a hash of the
    whole row.
    """
    calls = calls if dealt else by_key(calls, ["call_number"])
    order = [newest_first("received_ts"), newest_first("ingested_ts"),
             F.col("rowid").desc_nulls_last()]
    return keep_first(calls, [*dealt_by, "call_number"], order, tie)


def latest_incidents(incidents: DataFrame, ingested: str = "ingested_ts",
                     keys: Sequence[str] = BY_INCIDENT, dealt: bool = False, dealt_by: Sequence[Column] = ()) -> DataFrame:
    """One row per key: latest alarm, then latest ingested; dealt rows as in ``latest_calls``."""
    order = [newest_first("alarm_ts"), F.col(ingested).desc_nulls_last()]
    return keep_first(incidents if dealt else by_key(incidents, keys), [*dealt_by, *keys], order)


def clean_calls(bronze: DataFrame) -> DataFrame:
    return latest_typed_calls(typed(bronze, CALL_FIELDS))


def latest_typed_calls(rows: DataFrame) -> DataFrame:
    return with_durations(latest_calls(rows))


def typed_incidents(bronze: DataFrame, details: bool = False) -> DataFrame:
    """Typed incidents with the time of their ingestion, which ranks them."""
    fields = [*INCIDENT_FIELDS, *(INCIDENT_DETAIL_FIELDS if details else ())]
    return typed(bronze, [*fields, Field("_ingested_ts", "timestamp", ("_ingested_at_utc",))])


def latest_typed_incidents(rows: DataFrame, keys: Sequence[str] = BY_INCIDENT) -> DataFrame:
    return latest_incidents(rows, "_ingested_ts", keys).drop("_ingested_ts")


def clean_incidents(bronze: DataFrame, keys: Sequence[str] = BY_INCIDENT,
                    details: bool = False) -> DataFrame:
    """One row per incident by default, so that the gold fact cannot fan out.

    ``keys=BY_INCIDENT_AND_CALL`` keeps one row per pair instead.
    """
    return latest_typed_incidents(typed_incidents(bronze, details), keys)
