from datetime import date, datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.functions import casts, keys, names, times


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Call Number", "call_number"),
        ("AlarmDtTm", "alarm_dt_tm"),
        ("EMSUnits", "ems_units"),
        ("NumberofAlarms", "numberof_alarms"),
        ("Neighborhooods - Analysis Boundaries", "neighborhooods_analysis_boundaries"),
        ("  Zipcode of Incident ", "zipcode_of_incident"),
        ("_source_sha256", "_source_sha256"),
        ("Fire.Prevention-District", "fire_prevention_district"),
        ("RowID", "row_id"),
    ],
)
def test_sanitize_name(raw, clean):
    assert names.sanitize_name(raw) == clean


@given(st.text(alphabet="abAB19 ._-", max_size=20))
def test_sanitize_name_is_stable(raw):
    once = names.sanitize_name(raw)
    assert names.sanitize_name(once) == once
    assert "__" not in once and once == once.lower()


def test_sanitize_names_reports_clashes():
    with pytest.raises(ValueError, match="share a name"):
        names.sanitize_names(["Call Number", "CallNumber"])


def test_column_resolution(spark):
    df = spark.range(1).select(F.lit("x").alias("callnumber"))
    assert df.select(names.required_column(df, "call_number", "callnumber").alias("c")).first().c == "x"
    assert df.select(names.optional_column(df, "absent", dtype="int").alias("c")).schema[0].dataType.simpleString() == "int"
    with pytest.raises(ValueError, match="absent"):
        names.required_column(df, "absent")


@pytest.mark.parametrize(
    "has_call, has_incident, path, dataset",
    [
        (True, True, "/d/Fire_Calls.csv", "calls"),
        (True, True, "/d/incident_call.csv", "calls"),
        (True, True, "/d/fire_incidents.csv", "incidents"),
        (True, True, "/d/x.csv", "incidents"),
        (True, False, "/d/incidents.csv", "calls"),
        (False, True, "/d/calls.csv", "incidents"),
        (False, False, "/d/incident_calls.csv", "incidents"),
        (False, False, "/d/calls.csv", "calls"),
        (False, False, "/d/x.csv", "incidents"),
    ],
)
def test_classify_dataset(spark, has_call, has_incident, path, dataset):
    row = spark.range(1).select(
        names.classify_dataset(F.lit(has_call), F.lit(has_incident), F.lit(path)).alias("d")
    )
    assert row.first().d == dataset


@pytest.mark.parametrize(
    "text, number",
    [("12.5", 13), ("-12.5", -13), ("1e3", 1000), ("94103.0", 94103), ("94103-1234", None),
     (" 12 ", 12), ("", None), ("99999999999", None), (".5", 1), ("abc", None), (None, None)],
)
def test_to_integer(spark, text, number):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(casts.to_integer(F.col("s")).alias("n")).first().n == number


@pytest.mark.parametrize(
    "text, ts, day",
    [
        ("01/02/2020 01:02:03 PM", datetime(2020, 1, 2, 13, 2, 3), None),
        ("1/2/2020 1:02:03 pm", datetime(2020, 1, 2, 13, 2, 3), None),
        ("01/02/2020 13:02:03", datetime(2020, 1, 2, 13, 2, 3), None),
        ("2020-01-02 03:04:05", datetime(2020, 1, 2, 3, 4, 5), date(2020, 1, 2)),
        (" 2020-01-02 03:04:05 ", datetime(2020, 1, 2, 3, 4, 5), date(2020, 1, 2)),
        ("2020-01-02T03:04:05.25", datetime(2020, 1, 2, 3, 4, 5, 250000), date(2020, 1, 2)),
        ("2020-01-02", datetime(2020, 1, 2), date(2020, 1, 2)),
        ("01/02/2020", None, date(2020, 1, 2)),
        ("02/30/2020", None, None),
        ("2020", None, None),
        ("2020-01", None, None),
        ("junk", None, None),
        (None, None, None),
    ],
)
def test_parse_times(spark, text, ts, day):
    df = spark.createDataFrame([(text,)], "s string")
    row = df.select(
        times.parse_timestamp(F.col("s")).alias("ts"), times.parse_date(F.col("s")).alias("d")
    ).first()
    assert (row.ts, row.d) == (ts, day)


def test_durations_count_second_boundaries(spark):
    df = spark.createDataFrame(
        [
            (datetime(2020, 1, 1, 0, 0, 0, 900000), datetime(2020, 1, 1, 0, 0, 1, 100000)),
            (datetime(2020, 1, 1), datetime(2020, 1, 1)),
            (datetime(2020, 1, 2), datetime(2020, 1, 1)),
            (datetime(2020, 1, 1), None),
            (datetime(1969, 12, 31, 23, 59, 59), datetime(1970, 1, 1, 0, 0, 1)),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    found = df.select(times.seconds_between(F.col("a"), F.col("b")).alias("s"))
    assert [r.s for r in found.collect()] == [1, 0, None, None, 2]


def test_durations_do_not_depend_on_the_time_zone(spark):
    df = spark.createDataFrame(
        [(datetime(2021, 3, 14, 1, 30), datetime(2021, 3, 14, 3, 30))], "a timestamp_ntz, b timestamp_ntz"
    )
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert df.select(times.seconds_between(F.col("a"), F.col("b")).alias("s")).first().s == 7200
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_cleaning(spark):
    df = spark.createDataFrame([("  x ",), ("  ",), ("\tx",), (None,)], "s string")
    assert [r.c for r in df.select(casts.blank_to_null(F.col("s")).alias("c")).collect()] == ["x", None, "\tx", None]
    both = spark.createDataFrame([(" ", "right"), (None, "right"), ("left", None)], "l string, r string")
    found = both.select(casts.first_text(F.col("l"), F.col("r")).alias("c")).collect()
    assert [r.c for r in found] == [None, "right", "left"]


def test_number_bounds(spark):
    df = spark.createDataFrame([("-3",), ("-0",), ("x",), (None,), ("12.6",)], "s string")
    found = df.select(casts.bounded_number(F.col("s"), fill=3, high=10, digits=0).alias("n")).collect()
    assert [str(r.n) for r in found] == ["0.0", "0.0", "3.0", "3.0", "10.0"]


def test_text_key_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    found = [r.k for r in df.select(keys.text_key([F.col("x"), F.col("y")]).alias("k")).collect()]
    assert len(set(found)) == 2 and None not in found
