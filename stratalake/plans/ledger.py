"""The ingestion ledger: append-only events, with the current state as a query.

Parquet has no UPDATE, so nothing is ever changed in place. A run, a file and a content each
have a history of events; their state is the latest or the first value of each field.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.times import now_utc
from stratalake.operators.dedup import keep_first
from stratalake.operators.joins import not_present
from stratalake.sources import files as drop
from stratalake.sources.tables import append_rows, ensure_table

# States of runs and files, and the reason a known content is skipped.
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
PENDING, SKIPPED, DONE = "PENDING", "SKIPPED", "DONE"
ALREADY_INGESTED = "already_ingested"
DEFAULT_PIPELINE = "phase2_incremental"

RUN_EVENTS = (
    "run_id string, pipeline_name string, event_at timestamp_ntz, status string, "
    "trigger_type string, notes string"
)
LOG_EVENTS = (
    "log_id string, run_id string, pipeline_name string, drop_dir string, file_name string, "
    "file_path string, file_size_bytes bigint, file_mtime_utc timestamp_ntz, "
    "file_sha256 string, header array<string>, quoted_breaks boolean, event_at timestamp_ntz, lake_path string, "
    "lake_written_at timestamp_ntz, status string, error_message string"
)
SUCCESS_EVENTS = "pipeline_name string, content_sha256 string, success_at timestamp_ntz"
_TABLES = {"run_events": RUN_EVENTS, "log_events": LOG_EVENTS, "success_events": SUCCESS_EVENTS}


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_states(events: DataFrame) -> DataFrame:
    """One row per run: start, end when finished, latest status."""
    started = F.min(F.when(F.col("status") == RUNNING, F.col("event_at")))
    finished = F.max(F.when(F.col("status") != RUNNING, F.col("event_at")))
    return events.groupBy("run_id", "pipeline_name").agg(
        started.alias("started_at"),
        finished.alias("finished_at"),
        F.max_by("status", "event_at").alias("status"),
        F.min_by("trigger_type", "event_at").alias("trigger_type"),
        F.min_by("notes", "event_at").alias("notes"),
    )


def log_states(events: DataFrame) -> DataFrame:
    """One row per logged file: latest status, first time it was written to the lake."""
    latest = keep_first(events, ["log_id"], [F.col("event_at").desc()])
    firsts = events.groupBy("log_id").agg(
        F.min("event_at").alias("detected_at"),
        F.min("lake_written_at").alias("first_written_at"),
        F.max_by("lake_path", F.when(F.col("lake_path").isNotNull(), F.col("event_at"))).alias("known_path"),
    )
    return latest.join(firsts, "log_id").select(
        "log_id", "run_id", "pipeline_name", "drop_dir", "file_name", "file_path",
        "file_size_bytes", "file_mtime_utc", "file_sha256", "header", "quoted_breaks", "detected_at",
        F.col("known_path").alias("lake_path"), F.col("first_written_at").alias("lake_written_at"),
        "status", "error_message",
    )


def content_states(events: DataFrame) -> DataFrame:
    """One row per pipeline and content: first and last success."""
    return events.groupBy("pipeline_name", "content_sha256").agg(
        F.min("success_at").alias("first_success_at"),
        F.max("success_at").alias("last_success_at"),
    )


def classify_drop(fingerprints: DataFrame, contents: DataFrame) -> DataFrame:
    """Adds (status, error_message): FAILED, SKIPPED for a known content, else PENDING."""
    known = contents.select(F.col("content_sha256").alias("file_sha256")).distinct().withColumn(
        "_known", F.lit(True)
    )
    failed = F.col("error_message").isNotNull()
    is_known = F.col("_known").isNotNull()
    return (
        fingerprints.join(known, "file_sha256", "left")
        .withColumn("status", F.when(failed, FAILED).when(is_known, SKIPPED).otherwise(PENDING))
        .withColumn(
            "error_message",
            F.when(failed, F.col("error_message")).when(is_known, F.lit(ALREADY_INGESTED)),
        )
        .drop("_known")
    )


class Ledger:
    """Event tables of the ingestion under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        for table, schema in _TABLES.items():
            ensure_table(spark, self._path(table), schema)

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _events(self, table: str) -> DataFrame:
        return self.spark.read.schema(_TABLES[table]).parquet(self._path(table))

    def runs(self) -> DataFrame:
        return run_states(self._events("run_events"))

    def log(self) -> DataFrame:
        return log_states(self._events("log_events"))

    def contents(self) -> DataFrame:
        return content_states(self._events("success_events"))

    def start_run(self, pipeline: str = DEFAULT_PIPELINE, trigger: str = "SCHEDULE",
                  notes: str | None = None) -> str:
        run_id = str(uuid.uuid4())
        self._append_run((run_id, pipeline, utc_now(), RUNNING, trigger, notes))
        return run_id

    def finish_run(self, run_id: str, pipeline: str, status: str) -> None:
        self._append_run((run_id, pipeline, utc_now(), status, None, None))

    def _append_run(self, row: tuple) -> None:
        append_rows(self.spark, self._path("run_events"), [row], RUN_EVENTS)

    def append_log(self, rows: DataFrame) -> None:
        columns = [field.strip().split(" ")[0] for field in LOG_EVENTS.split(",")]
        rows.select(*columns).write.mode("append").parquet(self._path("log_events"))

    def known(self, pipeline: str, hashes: DataFrame) -> DataFrame:
        """Those contents that were ingested with success before."""
        done = self.contents().filter(F.col("pipeline_name") == pipeline)
        return hashes.join(done, hashes["file_sha256"] == done["content_sha256"], "left_semi")

    def detect(self, run_id: str, pipeline: str, drop_dir: str,
               files: DataFrame | None = None) -> dict:
        """Fingerprint the drop, log every file with its status, return the counts."""
        listed = drop.list_drop(self.spark, drop_dir) if files is None else files
        contents = self.contents().filter(F.col("pipeline_name") == pipeline)
        logged = classify_drop(drop.fingerprint(listed), contents).select(
            F.expr("uuid()").alias("log_id"),
            F.lit(run_id).alias("run_id"),
            F.lit(pipeline).alias("pipeline_name"),
            F.lit(drop_dir).alias("drop_dir"),
            "file_name", "file_path", "file_size_bytes", "file_mtime_utc", "file_sha256", "header",
            "quoted_breaks",
            now_utc().alias("event_at"),
            F.lit(None).cast("string").alias("lake_path"),
            F.lit(None).cast("timestamp_ntz").alias("lake_written_at"),
            "status", "error_message",
        )
        self.append_log(logged)
        return {"run_id": run_id, **self.summary(run_id)}

    def summary(self, run_id: str) -> dict:
        """Counts of the logged files of a run by status."""
        found = {
            row["status"]: row["n"]
            for row in self._events("log_events")
            .filter((F.col("run_id") == run_id) & F.col("lake_written_at").isNull())
            .filter(F.col("status") != DONE)
            .groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()
        }
        counts = {s.lower(): found.get(s, 0) for s in (PENDING, SKIPPED, FAILED)}
        return {**counts, "files": sum(counts.values())}

    def with_status(self, run_id: str, pipeline: str, status: str = PENDING) -> DataFrame:
        # An entry belongs to one run, so the states of other runs need not be computed.
        own = (F.col("run_id") == run_id) & (F.col("pipeline_name") == pipeline)
        return log_states(self._events("log_events").filter(own)).filter(F.col("status") == status)

    def waiting(self, run_id: str, pipeline: str) -> DataFrame:
        """Pending files of this run, and of runs that ended well before gold could be built."""
        ended = self.runs().filter((F.col("status") == SUCCESS) & (F.col("pipeline_name") == pipeline))
        own = self._events("run_events").filter(F.col("run_id") == run_id)
        runs = ended.select("run_id").union(own.select("run_id")).distinct()
        mine = self._events("log_events").filter(F.col("pipeline_name") == pipeline)
        return log_states(mine).filter(F.col("status") == PENDING).join(runs, "run_id", "left_semi")

    def landed(self) -> DataFrame:
        """(file_sha256, lake_path) of every content that is in the lake, on any date."""
        events = self._events("log_events").filter(F.col("lake_path").isNotNull())
        return events.groupBy("file_sha256").agg(F.min("lake_path").alias("lake_path"))

    def lake_folders(self, hashes: Sequence[str]) -> list[str]:
        """The lake folders of some contents, of one job's number."""
        wanted = self.landed().filter(F.col("file_sha256").isin(list(hashes)))
        return [row["lake_path"] for row in wanted.collect()]

    def to_land(self, files: DataFrame) -> DataFrame:
        """Files whose content is not in the lake yet, one path per content."""
        new = not_present(files, self.landed(), ["file_sha256"])
        return keep_first(new, ["file_sha256"], [F.col("file_path").asc()])

    def record_landed(self, files: DataFrame, lake_path) -> None:
        """Log the lake folder of each file; the first time of writing stays."""
        self.append_log(
            files.withColumn("lake_path", lake_path).withColumns(
                {
                    "lake_written_at": F.coalesce("lake_written_at", now_utc()),
                    "event_at": now_utc(),
                }
            )
        )

    def mark_done(self, run_id: str, pipeline: str) -> None:
        """Files of the run, and those that waited for it, become DONE; their contents count as ingested."""
        pending = self.waiting(run_id, pipeline)
        done = pending.withColumns(
            {"status": F.lit(DONE), "error_message": F.lit(None).cast("string"), "event_at": now_utc()}
        )
        success = pending.select(
            F.lit(pipeline).alias("pipeline_name"),
            F.col("file_sha256").alias("content_sha256"),
            now_utc().alias("success_at"),
        ).distinct()
        success.write.mode("append").parquet(self._path("success_events"))
        self.append_log(done)

    def mark_failed(self, run_id: str, pipeline: str, message: str) -> None:
        failed = self.with_status(run_id, pipeline).withColumns(
            {"status": F.lit(FAILED), "error_message": F.lit(message), "event_at": now_utc()}
        )
        self.append_log(failed)


