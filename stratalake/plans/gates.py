"""The gates of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratalake.operators.quality import Expectation, enforce, not_empty, not_negative, not_null
from stratalake.operators.sampling import sample_rows

_TS = ("timestamp_ntz", "timestamp")

# What the silver and gold tables must look like.
CALL_RULES = (not_null("received_ts"), not_null("dispatch_ts"), not_negative("response_time_sec"))
INCIDENT_RULES = (not_null("incident_number"),)
CALL_EXPECTATIONS = (
    Expectation("call_number", ("bigint",), nullable=False, above=0),
    Expectation("incident_number", ("bigint",)),
    Expectation("received_ts", _TS, nullable=False),
    Expectation("dispatch_ts", _TS, nullable=False),
    Expectation("on_scene_ts", _TS),
    Expectation("response_time_sec", ("bigint",), at_least=0),
    Expectation("dispatch_delay_sec", ("bigint",), at_least=0),
    Expectation("travel_time_sec", ("bigint",), at_least=0),
    Expectation("city", ("string",)),
    Expectation("battalion", ("string",)),
)
INCIDENT_EXPECTATIONS = (
    Expectation("incident_number", ("bigint",), nullable=False, above=0),
    Expectation("incident_date", ("date", *_TS)),
    Expectation("estimated_property_loss", ("bigint",), at_least=0),
    Expectation("estimated_contents_loss", ("bigint",), at_least=0),
    Expectation("fire_injuries", ("bigint",), at_least=0),
    Expectation("fire_fatalities", ("bigint",), at_least=0),
    Expectation("civilian_injuries", ("bigint",), at_least=0),
    Expectation("civilian_fatalities", ("bigint",), at_least=0),
)
FACT_RULES = (
    not_empty(),
    not_null("incident_number"),
    not_null("date_id"),
    not_null("location_id"),
    not_null("incident_type_id"),
    not_negative("response_time_sec"),
    not_negative("dispatch_delay_sec"),
    not_negative("travel_time_sec"),
    not_negative("incident_duration_sec"),
)

def check_silver(calls: DataFrame, incidents: DataFrame, sample: int | None = None) -> None:
    """Rules and expectations over the whole tables.

    With ``sample`` the expectations look at that many calls and incidents, while the rules still see every row. One full pass is cheaper than drawing a sample, so
    the default takes none.
    """
    if sample is None:
        enforce(calls, "calls_clean", CALL_RULES, CALL_EXPECTATIONS)
        enforce(incidents, "incidents_clean", INCIDENT_RULES, INCIDENT_EXPECTATIONS)
        return
    enforce(calls, "calls_clean", CALL_RULES)
    enforce(incidents, "incidents_clean", INCIDENT_RULES)
    enforce(sample_rows(calls, sample, ["call_number"]), "calls_clean sample",
            expectations=CALL_EXPECTATIONS)
    enforce(sample_rows(incidents, sample, ["incident_number"]), "incidents_clean sample",
            expectations=INCIDENT_EXPECTATIONS)


def check_gold(fact: DataFrame) -> None:
    enforce(fact, "fact_incident", FACT_RULES)
