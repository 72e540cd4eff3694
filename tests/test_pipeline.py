import gzip
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stratalake import session
from stratalake.operators.quality import GateError
from stratalake.plans import bronze, gates, gold, kpi, profile, reports, silver
from stratalake.plans.ledger import Ledger
from stratalake.plans.pipeline import DIMENSIONS, Pipeline
from stratalake.plans.reports import CallFilter
from stratalake.sources import files, serving
from stratalake.streaming.dropzone import ingest_new_files

CALLS = """Call Number,Incident Number,Call Type,Call Type Group,Final Priority,Call Date,Received DtTm,Dispatch DtTm,On Scene DtTm,Address,City,Battalion,Neighborhooods - Analysis Boundaries,Number of Alarms,RowID
1,10,Alarm,Fire,3,01/02/2020,01/02/2020 01:00:00 PM,01/02/2020 01:01:00 PM,01/02/2020 01:05:00 PM,1 Main,SF,B1,Mission,1,1-A
1,10,Alarm,Fire,3,01/02/2020,01/02/2020 01:00:00 PM,01/02/2020 01:01:00 PM,01/02/2020 01:06:00 PM,1 Main,SF,B1,Mission,1,1-B
2,20,Medical,EMS,2,2020-01-03,2020-01-03 10:00:00,2020-01-03 10:00:30,2020-01-03 09:00:00,None,SF,B2,,,2-A
3,30,,,,01/04/2020,01/04/2020 11:00:00,01/04/2020 11:00:10,,9 Side,,B1,Sunset,2,3-A
4,None,Alarm,Fire,3,01/05/2020,01/05/2020 11:00:00,01/05/2020 11:00:10,,,,B9,,1,4-A
"""
INCIDENTS = """IncidentNumber,CallNumber,IncidentDate,AlarmDtTm,CloseDtTm,Address,City,Battalion,NumberofAlarms,EMSUnits,EstimatedPropertyLoss,PrimarySituation
10,1,01/02/2020,01/02/2020 01:00:00 PM,01/02/2020 02:00:00 PM,1 Main St,SF,B1,4,2,-5,100
20,2,01/03/2020,01/03/2020 10:00:00 AM,01/03/2020 09:59:00 AM,5 Oak,SF,B2,1,0,700.6,300
20,7,01/03/2020,01/03/2020 09:00:00 AM,,7 Oak,SF,B2,1,0,900,300
"""


def fill(folder):
    folder.mkdir()
    (folder / "fire_calls.csv").write_text(CALLS)
    (folder / "fire_incidents.csv").write_text(INCIDENTS)
    return folder


@pytest.fixture
def drop(tmp_path):
    return fill(tmp_path / "drop")


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    """A finished first run that tests may read but not change."""
    root = tmp_path_factory.mktemp("done")
    pipe = Pipeline(spark, str(root / "house"))
    pipe.first = pipe.run_incremental(str(fill(root / "drop")), export_to=str(root / "served"))
    pipe.served = str(root / "served")
    return pipe


@pytest.fixture
def pipe(spark, tmp_path):
    return Pipeline(spark, str(tmp_path / "house"))


def statuses(pipe, run_id):
    log = pipe.ledger.log().filter(F.col("run_id") == run_id)
    return {r.file_name: r.status for r in log.collect()}


def test_incremental_run(done, rows):
    pipe, first = done, done.first
    assert (first["pending"], first["written"]) == (2, 2)
    assert (first["inserted_calls"], first["inserted_incidents"]) == (5, 3)
    assert set(statuses(pipe, first["run_id"]).values()) == {"DONE"}

    calls, incidents, fact, dates, types, places = pipe.warehouse.read(
        "silver.calls_clean", "silver.incidents_clean", "gold.fact_incident", *[f"gold.{d}" for d in DIMENSIONS])
    assert rows(calls, "call_number", "rowid", "response_time_sec", "dispatch_delay_sec") == [
        (1, "1-B", 360, 60), (2, "2-A", None, 30), (3, "3-A", None, 10), (4, "4-A", None, 10)]
    assert rows(incidents, "incident_number", "call_number", "estimated_property_loss", "number_of_alarms") == [
        (10, 1, None, 4), (20, 2, 701, 1)]
    # One fact per call with an incident number; the call without a type has a type id too.
    assert rows(fact, "call_number", "date_id", "incident_duration_sec", "number_of_alarms") == [
        (1, 20200102, 3600, 1), (2, 20200103, None, 1), (3, 20200104, None, 2)]
    assert fact.filter("location_id IS NULL OR incident_type_id IS NULL").isEmpty()
    assert sorted(r.incident_id for r in fact.collect()) == [1, 2, 3]
    assert rows(dates, "date") == [(date(2020, 1, d),) for d in (2, 3, 4, 5)]
    assert rows(types, "incident_type_id", "call_type", "primary_situation") == [
        (1, "Alarm", "100"), (2, "Medical", "300"), (3, None, None)]
    assert places.count() == 4
    assert {r.address for r in places.collect()} == {"1 Main", "5 Oak", "9 Side", None}

    served = serving.read_serving(type(pipe.warehouse)(pipe.spark, pipe.served), "v_kpi_response_time_month")
    assert rows(served) == [(2020, 1, 360.0, 1)]
    run = pipe.ledger.runs().filter(F.col("run_id") == first["run_id"]).first()
    assert run.status == "SUCCESS" and run.finished_at >= run.started_at


def test_second_run_is_a_no_op_and_copies_are_skipped(pipe, drop):
    shutil.copy(drop / "fire_calls.csv", drop / "calls copy [1]{a}+%.csv")
    (drop / "fire_calls.csv").unlink()
    shutil.copy(drop / "calls copy [1]{a}+%.csv", drop / "zz_calls.csv")
    found = pipe.run_incremental(str(drop))
    assert (found["pending"], found["written"], found["inserted_calls"]) == (3, 2, 5)
    before = pipe.bronze.read("calls").count()
    shutil.copy(drop / "zz_calls.csv", drop / "renamed.csv")
    again = pipe.run_incremental(str(drop))
    assert (again["pending"], again["skipped"], again["skipped_downstream"]) == (0, 4, True)
    assert pipe.bronze.read("calls").count() == before
    log = pipe.ledger.log().filter(F.col("run_id") == again["run_id"]).collect()
    assert {r.error_message for r in log} == {"already_ingested"}


def test_schema_evolution(pipe, drop, rows):
    (drop / "more_calls.csv").write_text(
        "Call Number,Incident Number,Received DtTm,Dispatch DtTm,Call Date,Brand New\n"
        "9,90,01/09/2020 10:00:00,01/09/2020 10:00:05,01/09/2020,x\n")
    pipe.run_incremental(str(drop))
    calls = pipe.bronze.read("calls")
    assert "brand_new" in calls.columns
    assert rows(calls.filter("brand_new IS NOT NULL"), "call_number", "call_type", "brand_new") == [("9", None, "x")]
    assert calls.count() == 6
    assert 9 in {r.call_number for r in pipe.warehouse.read("gold.fact_incident").collect()}


def test_row_numbers_follow_the_file(spark, pipe, tmp_path):
    folder = tmp_path / "big"
    folder.mkdir()
    lines = [f"{i},{i}" for i in range(5000)]
    (folder / "calls.csv").write_text("Call Number,Incident Number\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        run = pipe.ledger.start_run(pipe.name)
        pipe.ledger.detect(run, pipe.name, str(folder))
        bronze.land_pending(spark, pipe.ledger, pipe.lake_root, run, pipe.name)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    bronze.ingest_pending(spark, pipe.ledger, pipe.bronze, pipe.lake_root, run, pipe.name)
    calls = pipe.bronze.read("calls")
    assert calls.count() == 5000
    assert calls.filter("_source_row_number <> call_number").isEmpty()
    blocks = spark.read.parquet(f"{pipe.lake_root}/calls").select("_block_start").distinct().count()
    assert blocks > 1, "the file must be read in several blocks"


def test_half_written_content_is_completed(spark, done, tmp_path):
    calls = done.bronze.read("calls")
    sha = calls.first()._source_sha256
    other = bronze.Bronze(spark, str(tmp_path / "other"))
    other.append_new("calls", calls.filter("_source_row_number < 2"), [sha])
    assert other.append_new("calls", calls, [sha]) == {sha: (3, 5)}
    assert other.append_new("calls", calls, [sha]) == {sha: (0, 5)}
    assert other.read("calls").count() == 5


def test_gate_failure_is_repeated_until_it_passes(pipe, drop):
    (drop / "bad_calls.csv").write_text(
        "Call Number,Incident Number,Received DtTm,Dispatch DtTm\n50,60,junk,01/09/2020 10:00:05\n")
    with pytest.raises(GateError, match="received_ts is null"):
        pipe.run_incremental(str(drop))
    assert not pipe.warehouse.exists("gold.fact_incident")
    states = {r.status for r in pipe.ledger.log().collect()}
    assert states == {"FAILED"} and pipe.ledger.contents().isEmpty()
    (drop / "fix_calls.csv").write_text(
        "Call Number,Incident Number,Received DtTm,Dispatch DtTm,Call Date\n"
        "50,60,01/09/2020 10:00:00,01/09/2020 10:00:05,01/09/2020\n")
    found = pipe.run_incremental(str(drop))
    assert found["pending"] == 4 and found["inserted_calls"] == 1
    assert pipe.warehouse.read("gold.fact_incident").count() == 4


def test_waits_for_both_datasets(pipe, drop):
    (drop / "fire_incidents.csv").unlink()
    first = pipe.run_incremental(str(drop))
    assert first["inserted_calls"] == 5 and first["skipped_downstream"]
    (drop / "fire_incidents.csv").write_text(INCIDENTS)
    second = pipe.run_incremental(str(drop))
    assert second["pending"] == 2 and not second["skipped_downstream"]
    assert pipe.warehouse.read("gold.fact_incident").count() == 3


def test_full_refresh(pipe, drop, rows):
    counts = pipe.run_full(str(drop / "fire_calls.csv"), str(drop / "fire_incidents.csv"))
    assert counts == {"calls": 5, "incidents": 3}
    assert "property_use" in pipe.warehouse.read("silver.incidents_clean").columns
    assert rows(pipe.warehouse.read("gold.v_kpi_incident_volume_month")) == [(2020, 1, 3)]


def test_full_refresh_in_slices(pipe, drop, rows, monkeypatch):
    """Slices of two rows give the tables of one."""
    names = ["silver.calls_clean", "silver.incidents_clean", "gold.dim_location", "gold.v_kpi_incident_volume_month"]
    pipe.run_full(str(drop / "fire_calls.csv"), str(drop / "fire_incidents.csv"))
    whole = [rows(f.drop("location_id")) for f in pipe.warehouse.read(*names)]
    facts = rows(pipe.warehouse.read("gold.fact_incident").drop("incident_id", "location_id"))
    monkeypatch.setattr(session, "SLICE_ROWS", 2)
    assert session.slice_count(5) == 3
    pipe.run_full(str(drop / "fire_calls.csv"), str(drop / "fire_incidents.csv"))
    assert [rows(f.drop("location_id")) for f in pipe.warehouse.read(*names)] == whole
    fact = pipe.warehouse.read("gold.fact_incident")
    assert rows(fact.drop("incident_id", "location_id")) == facts
    assert rows(fact, "incident_id") == [(1,), (2,), (3,)]


def test_compressed_files_are_taken_in(pipe, drop, tmp_path):
    """A compressed file counts as its text: the same rows, and the same content as the plain file."""
    for name in ("fire_calls", "fire_incidents"):
        plain = drop / f"{name}.csv"
        (drop / f"{name}.csv.gz").write_bytes(gzip.compress(plain.read_bytes()))
        plain.unlink()
    found = pipe.run_incremental(str(drop))
    assert (found["pending"], found["inserted_calls"], found["inserted_incidents"]) == (2, 5, 3)
    assert pipe.warehouse.read("gold.fact_incident").count() == 3
    fill(tmp_path / "plain")
    again = pipe.run_incremental(str(tmp_path / "plain"))
    assert (again["pending"], again["skipped"]) == (0, 2)
    ingest_new_files(pipe, str(drop), str(tmp_path / "state"))
    assert pipe.bronze.read("calls").count() == 5


def test_streaming_ingestion(pipe, drop, tmp_path):
    state = str(tmp_path / "state")
    ingest_new_files(pipe, str(drop), state)
    ingest_new_files(pipe, str(drop), state)
    assert pipe.bronze.read("calls").count() == 5
    assert pipe.warehouse.read("gold.fact_incident").count() > 0
    assert pipe.run_incremental(str(drop))["pending"] == 0
    shutil.copy(drop / "fire_calls.csv", drop / "calls_again.csv")
    ingest_new_files(pipe, str(drop), state)
    assert pipe.bronze.read("calls").count() == 5
    assert {r.trigger_type for r in pipe.ledger.runs().collect()} == {"STREAM", "SCHEDULE"}
    # A batch that a gate stops ends its run as FAILED.
    (drop / "calls_new.csv").write_text("Call Number,Incident Number\n99,1\n")
    with pytest.raises(Exception, match="received_ts"):
        ingest_new_files(pipe, str(drop), state)
    assert "FAILED" in {r.status for r in pipe.ledger.runs().collect()}


def test_ledger_keeps_first_success_and_first_landing(spark, tmp_path, drop):
    ledger = Ledger(spark, str(tmp_path / "meta"))
    runs = []
    for _ in range(2):
        run = ledger.start_run("p", "MANUAL", "note")
        ledger.detect(run, "other" if runs else "p", str(drop))
        ledger.mark_done(run, "other" if runs else "p")
        runs.append(run)
    contents = ledger.contents().groupBy("pipeline_name").count().collect()
    assert {r.pipeline_name: r["count"] for r in contents} == {"p": 2, "other": 2}
    third = ledger.start_run("p", "MANUAL")
    assert ledger.detect(third, "p", str(drop)) == {
        "run_id": third, "pending": 0, "skipped": 2, "failed": 0, "files": 2}
    hashes = files.fingerprint(files.list_drop(spark, str(drop)))
    assert ledger.known("p", hashes).count() == 2 and ledger.known("none", hashes).isEmpty()
    started = ledger.runs().filter(F.col("run_id") == runs[0]).first()
    assert (started.status, started.notes, started.finished_at) == ("RUNNING", "note", None)


def test_fan_out_is_an_option(done):
    pipe = done
    raw = pipe.bronze.read("incidents")
    pairs = silver.clean_incidents(raw, keys=silver.BY_INCIDENT_AND_CALL)
    assert pairs.count() == 3
    matched = gold.matched_calls(pipe.warehouse.read("silver.calls_clean"), pairs)
    assert matched.filter("incident_number = 20").count() == 2


def test_types_without_unknown_member(done):
    pipe = done
    calls, incidents = pipe.warehouse.read("silver.calls_clean", "silver.incidents_clean")
    matched = gold.matched_calls(calls, incidents)
    assert gold.dim_incident_type(matched).count() == 3
    assert gold.dim_incident_type(matched, unknown_member=False).count() == 2


def test_missing_required_and_optional_columns(spark):
    raw = spark.createDataFrame([("1", "2", "01/02/2020 01:00:00 PM")], "call_number string, incidentnumber string, received_dttm string")
    row = silver.clean_calls(raw).first()
    assert (row.incident_number, row.received_ts) == (2, datetime(2020, 1, 2, 13))
    assert row.entry_ts is None and row.number_of_alarms is None
    with pytest.raises(ValueError, match="received_dt_tm"):
        silver.clean_calls(raw.drop("received_dttm"))


def test_gates_on_samples(done):
    pipe = done
    calls, incidents = pipe.warehouse.read("silver.calls_clean", "silver.incidents_clean")
    gates.check_silver(calls, incidents, sample=2)
    with pytest.raises(GateError):
        gates.check_silver(calls.withColumn("call_number", F.lit(0).cast("long")), incidents, sample=2)


def test_reports_under_filters(done, rows):
    pipe = done
    calls, incidents = pipe.warehouse.read("silver.calls_clean", "silver.incidents_clean")
    chosen = CallFilter(date(2020, 1, 2), date(2020, 1, 3), groups=["Fire", "EMS"])
    assert chosen.apply(calls).count() == 2
    assert tuple(reports.overview(chosen.apply(calls)).first()) == (2, 360.0, 1, 360.0, 360.0)
    picked = reports.incidents_of_calls(incidents, calls, chosen)
    totals = reports.severity_totals(picked).first()
    assert (totals.total_incidents, totals.prop_loss) == (2, 701)
    assert rows(reports.response_histogram(calls, chosen, sample=None).filter("n > 0"), "bin", "n") == [(30, 1)]
    fact, dates, types, places = pipe.warehouse.read("gold.fact_incident", *[f"gold.{d}" for d in DIMENSIONS])
    star = kpi.star(fact, dates, types, places)
    assert kpi.select_facts(star, year=2020, neighborhood="Mission").count() == 1
    assert kpi.summary(star).first().total_incidents == 3


def test_regression_on_time_features(spark):
    from examples.mapping import star_store

    calls = star_store(spark, "/root/testdata/sf0.01").read("silver.calls_clean")
    features = profile.feature_table(calls, sample=4000)
    models = profile.train_forest(features, targets=["response_time_sec"], trees=5, depth=4)
    found = profile.predict(models, features).agg(F.min("pred_response_time_sec").alias("low"), F.count("*").alias("n")).first()
    assert found.low >= 0 and found.n == features.count()
    parts = profile.distribution_profile(features.withColumn("unit_type", F.lit("E")), categories=["unit_type", "call_type"])
    assert parts["hour_shares"].agg(F.sum("share")).first()[0] == pytest.approx(1.0)
