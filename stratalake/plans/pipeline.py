"""The two pipelines: scheduled incremental and one-shot full refresh."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.plans import bronze, changes, gates, gold, kpi, silver
from stratalake.plans.ledger import DEFAULT_PIPELINE, FAILED, SUCCESS, Ledger
from stratalake.session import (configure, in_slice, materialize, release_shuffles, remove_path, scratch_path, side_by_side,
                                slice_count)
from stratalake.sources import csv, serving
from stratalake.sources.tables import Staged, Warehouse

DIMENSIONS = ("dim_date", "dim_incident_type", "dim_location")


class Pipeline:
    """Folders of one installation: lake, bronze, warehouse and ledger under one root."""

    def __init__(self, spark: SparkSession, root: str, pipeline: str = DEFAULT_PIPELINE,
                 part_keys: int = changes.PART_KEYS):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.name = pipeline
        self.part_keys = part_keys
        self.lake_root = f"{self.root}/lake"
        self.bronze = bronze.Bronze(spark, f"{self.root}/bronze")
        self.warehouse = Warehouse(spark, f"{self.root}/warehouse")
        self.ledger = Ledger(spark, f"{self.root}/ledger")

    def run_incremental(self, drop_dir: str, trigger: str = "SCHEDULE", notes: str | None = None,
                        export_to: str | None = None, files: DataFrame | None = None,
                        multi_line: bool = False) -> dict:
        """Take in what is new in the drop and refresh everything behind it.

        Nothing pending stops the run at once. Contents count as ingested only after gold is
        published, so a run that a gate stopped is repeated by the next one. Until both
        datasets have arrived, files only reach bronze.
        """
        run_id = self.ledger.start_run(self.name, trigger, notes)
        try:
            found = self.ledger.detect(run_id, self.name, drop_dir, files)
            if found["pending"] == 0:
                self.ledger.finish_run(run_id, self.name, SUCCESS)
                return {**found, "skipped_downstream": True}
            landed = bronze.land_pending(
                self.spark, self.ledger, self.lake_root, run_id, self.name, multi_line=multi_line
            )
            loaded = bronze.ingest_pending(
                self.spark, self.ledger, self.bronze, self.lake_root, run_id, self.name
            )
            contents = loaded.pop("contents")
            absent = [name for name in ("calls", "incidents") if not self.bronze.exists(name)]
            refresh = not absent and loaded["rows_held"] > 0
            release_shuffles(self.spark)
            if refresh:
                self.refresh_changes(contents, export_to)
                release_shuffles(self.spark)
            if not absent:
                self.ledger.mark_done(run_id, self.name)
            self.ledger.finish_run(run_id, self.name, SUCCESS)
            return {**found, **landed, **loaded, "skipped_downstream": not refresh}
        except Exception as error:
            self.ledger.mark_failed(run_id, self.name, str(error))
            self.ledger.finish_run(run_id, self.name, FAILED)
            raise

    def run_full(self, calls_csv: str, incidents_csv: str,
                 text_columns: Sequence[str] = bronze.CALLS_TEXT_COLUMNS,
                 export_to: str | None = None) -> dict[str, int]:
        """Rebuild every layer from two CSV files; returns the bronze row counts."""
        present = set(csv.header(self.spark, calls_csv))
        overrides = {name: "string" for name in text_columns if name in present}
        counts = {
            "calls": bronze.load_full(self.warehouse, calls_csv, "calls", overrides),
            "incidents": bronze.load_full(self.warehouse, incidents_csv, "incidents"),
        }
        release_shuffles(self.spark)
        self.refresh(
            self.warehouse.read("bronze.calls"), self.warehouse.read("bronze.incidents"),
            export_to, details=True,
        )
        return counts

    def refresh_changes(self, contents: Mapping[str, Sequence[str]], export_to: str | None = None) -> dict[str, int]:
        """Bring silver, gold and the figures up to date with some contents of bronze.

        Without tables in parts to start from, all of bronze is taken in.
        """
        start = not changes.Refresh.possible(self.warehouse)
        rows = [self.bronze.read(name) if start else self.bronze.contents(name, contents[name]) for name in ("calls", "incidents")]
        touched = changes.Refresh(self.warehouse, self.part_keys).run(*rows)
        if export_to is not None:
            serving.export(self.warehouse, export_to, [*kpi.KPI_TABLES, *DIMENSIONS])
        return touched

    def refresh(self, raw_calls: DataFrame, raw_incidents: DataFrame, export_to: str | None = None,
                details: bool = False) -> None:
        """Silver, gate, gold, gate; all tables are published together at the end."""
        calls, incidents = self._stage_silver(raw_calls, raw_incidents, details)
        clean_calls = self.warehouse.read_staged(calls)
        clean_incidents = self.warehouse.read_staged(incidents)
        gates.check_silver(clean_calls, clean_incidents)
        release_shuffles(self.spark)
        built = self._stage_gold(clean_calls, clean_incidents)
        gates.check_gold(self.warehouse.read_staged(built["fact_incident"]))
        self.warehouse.publish(calls, incidents, *built.values())
        if export_to is not None:
            serving.export(self.warehouse, export_to, [*kpi.KPI_TABLES, *DIMENSIONS])

    def _stage_silver(self, raw_calls: DataFrame, raw_incidents: DataFrame,
                      details: bool) -> list[Staged]:
        stage = self.warehouse.stage
        return side_by_side(
            lambda: stage("silver.calls_clean", _in_slices(
                raw_calls, silver.typed(raw_calls, silver.CALL_FIELDS), "call_number", silver.latest_typed_calls), "call_date"),
            lambda: stage("silver.incidents_clean", _in_slices(
                raw_incidents, silver.typed_incidents(raw_incidents, details), "incident_number", silver.latest_typed_incidents),
                "incident_date"),
        )

    def _stage_gold(self, calls: DataFrame, incidents: DataFrame) -> dict[str, Staged]:
        built = stage_star(self.warehouse, calls, incidents)
        fact, dates, types = (
            self.warehouse.read_staged(built[n])
            for n in ("fact_incident", "dim_date", "dim_incident_type")
        )
        figures = kpi.kpi_tables(fact, dates, types)
        staged = side_by_side(
            *[partial(self.warehouse.stage, f"gold.{name}", f) for name, f in figures.items()]
        )
        return {**built, **dict(zip(figures, staged))}


def _in_slices(stored: DataFrame, rows: DataFrame, key: str, winners: Callable[[DataFrame], DataFrame]) -> Iterator[DataFrame]:
    """The winners of stored rows, by slices of their keys."""
    slices = slice_count(stored.count())
    for number in range(slices):
        yield winners(rows if slices == 1 else rows.where(in_slice(F.col(key), number, slices)))


def _matched_slices(calls: DataFrame, incidents: DataFrame) -> Iterator[DataFrame]:
    """Calls with their incidents, by slices of the incident number; calls without one go by their own number."""
    slices = slice_count(calls.count())
    for number in range(slices):
        sides = calls, incidents
        if slices > 1:
            sides = (calls.where(in_slice(F.coalesce("incident_number", "call_number"), number, slices)),
                     incidents.where(in_slice(F.col("incident_number"), number, slices)))
        yield gold.matched_calls(*sides).drop("location_key")


def stage_star(store: Warehouse, calls: DataFrame, incidents: DataFrame) -> dict[str, Staged]:
    """Stage the three dimensions and the fact from stored silver tables.

    The join of calls and incidents is the costly step; it is stored and used three times.
    """
    path = scratch_path(store.spark, "matched-calls")
    matched = materialize(_matched_slices(calls, incidents), "matched-calls", path)
    dims = side_by_side(
        lambda: store.stage("gold.dim_date", gold.dim_date(calls, incidents)),
        lambda: store.stage_numbered("gold.dim_incident_type", gold.type_members(matched), "incident_type_id", gold.TYPE_COLUMNS),
        lambda: store.stage_numbered("gold.dim_location", gold.places(matched), "location_id", [gold.location_key()], add={"location_key": gold.location_key()}),
    )
    fact = gold.fact_rows(gold.with_location_key(matched), *map(store.read_staged, dims))
    staged_fact = store.stage_numbered("gold.fact_incident", fact, "incident_id", cluster_by="date_id")
    del matched, fact
    remove_path(store.spark, path)
    release_shuffles(store.spark)
    return {**dict(zip(DIMENSIONS, dims)), "fact_incident": staged_fact}
