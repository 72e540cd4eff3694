"""Bronze: full load, and idempotent incremental append with schema evolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.names import CALL_KEYS, INCIDENT_KEYS, classify_dataset, sanitize_columns, sanitize_names
from stratalake.operators import shape
from stratalake.operators.joins import not_present
from stratalake.plans.ledger import PENDING, Ledger, utc_now
from stratalake.session import COMPRESSION, remove_path, scratch_path
from stratalake.sources import csv, lake
from stratalake.sources.files import existing
from stratalake.sources.tables import Warehouse, append_rows, ensure_table

# Contents ingested by one job; it bounds the hash list in the scan filter.
CONTENTS_PER_JOB = 10_000

_COLUMNS = "dataset string, ordinal int, column_name string"

# Raw columns of calls that mix digits and letters and so stay text.
CALLS_TEXT_COLUMNS = (
    "Box", "Battalion", "Station Area", "Supervisor District", "Fire Prevention District",
)


def load_full(warehouse: Warehouse, source_path: str, table: str,
              overrides: Mapping[str, str] | None = None) -> int:
    """Replace ``bronze.<table>`` with a CSV file, types inferred; returns the row count."""
    path = scratch_path(warehouse.spark, "csv-text")
    rows = warehouse.write(f"bronze.{table}", sanitize_columns(
        csv.read_inferred(warehouse.spark, source_path, overrides, stored_at=path)))
    remove_path(warehouse.spark, path)
    return rows


class Bronze:
    """Incremental bronze tables, all text, one folder per content hash.

    The known columns of a dataset are kept in a small table of their own. Reads use them as
    the schema, so old files without a newer column yield NULL and no footers are merged.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        ensure_table(spark, self._columns_path(), _COLUMNS)

    def _columns_path(self) -> str:
        return f"{self.root}/columns"

    def _path(self, dataset: str) -> str:
        return f"{self.root}/bronze_{dataset}"

    def columns(self, dataset: str) -> list[str]:
        known = self.spark.read.schema(_COLUMNS).parquet(self._columns_path())
        found = known.filter(F.col("dataset") == dataset).orderBy("ordinal").collect()
        return [row["column_name"] for row in found]

    def _evolve(self, dataset: str, incoming: Sequence[str]) -> list[str]:
        known = self.columns(dataset)
        wanted = shape.evolve(csv.text_schema(known), incoming).names
        added = [(dataset, i, name) for i, name in enumerate(wanted) if i >= len(known)]
        if added:
            append_rows(self.spark, self._columns_path(), added, _COLUMNS)
        return wanted

    def read(self, dataset: str) -> DataFrame:
        columns = self.columns(dataset)
        if not columns:
            raise LookupError(f"bronze has no {dataset} yet")
        schema = csv.text_schema([c for c in columns if c != "_source_sha256"] + ["_source_sha256"])
        return self.spark.read.schema(schema).parquet(self._path(dataset)).select(*columns)

    def exists(self, dataset: str) -> bool:
        return bool(self.columns(dataset))

    def append_new(self, dataset: str, rows: DataFrame, hashes: Sequence[str]) -> dict[str, tuple[int, int]]:
        """Append the rows that bronze lacks; (new rows, all rows) per content.

        A row is known by content hash and row number, so a second run or one that broke off
        adds exactly what is missing. Contents that bronze has nothing of are written as they
        are read; only the others are compared, within their own folders.
        """
        held = self._held(dataset, hashes) if self.exists(dataset) else None
        columns = self._evolve(dataset, rows.columns)
        before = {} if held is None else self._counts(held)
        started = F.col("_source_sha256").isin(list(before))
        if before:
            missing = not_present(
                rows.filter(started), held, ["_source_sha256", "_source_row_number"]
            )
            # One shuffle has spread each content over all tasks; gather it into full files.
            self._append(dataset, missing.hint("rebalance", "_source_sha256"), columns)
        if set(hashes) - set(before):
            self._append(dataset, rows.filter(~started) if before else rows, columns)
        after = self._counts(self._held(dataset, hashes))
        return {sha: (n - before.get(sha, 0), n) for sha, n in after.items()}

    def _append(self, dataset: str, rows: DataFrame, columns: Sequence[str]) -> None:
        aligned = shape.align(rows, csv.text_schema(columns))
        aligned.write.mode("append").option("compression", COMPRESSION).partitionBy("_source_sha256").parquet(self._path(dataset))

    def _held(self, dataset: str, hashes: Sequence[str]) -> DataFrame:
        return self.contents(dataset, hashes)

    def contents(self, dataset: str, hashes: Sequence[str]) -> DataFrame:
        """The stored rows of some contents; only their own folders are listed and read."""
        columns = self.columns(dataset)
        schema = csv.text_schema([c for c in columns if c != "_source_sha256"] + ["_source_sha256"])
        folders = existing(self.spark, [f"{self._path(dataset)}/_source_sha256={sha}" for sha in sorted(set(hashes))])
        if not folders:
            return self.spark.createDataFrame([], schema).select(*columns)
        return self.spark.read.schema(schema).option("basePath", self._path(dataset)).parquet(*folders).select(*columns)

    @staticmethod
    def _counts(stored: DataFrame) -> dict[str, int]:
        counted = stored.groupBy("_source_sha256").agg(F.count(F.lit(1)).alias("n")).collect()
        return {row["_source_sha256"]: row["n"] for row in counted}


def classify_files(files: DataFrame) -> DataFrame:
    """Adds the dataset of each logged file from its header and path."""
    names = F.transform("header", _sanitized_key)
    has_call = F.exists(names, lambda n: n.isin(*CALL_KEYS))
    has_incident = F.exists(names, lambda n: n.isin(*INCIDENT_KEYS))
    return files.withColumn("dataset", classify_dataset(has_call, has_incident, F.col("file_path")))


def _classified(ledger: Ledger, run_id: str, pipeline: str) -> DataFrame:
    """Pending files with one dataset a content: that of the lake if it is there, else the first by name."""
    files = classify_files(ledger.with_status(run_id, pipeline, PENDING))
    in_lake = ledger.landed().select(
        "file_sha256", F.regexp_extract("lake_path", r"/([^/]+)/ingest_date=[^/]*/sha256=", 1).alias("_lake"))
    chosen = files.groupBy("file_sha256").agg(F.min("dataset").alias("_first")).join(in_lake, "file_sha256", "left")
    return files.drop("dataset").join(chosen, "file_sha256").withColumn(
        "dataset", F.coalesce("_lake", "_first")).drop("_lake", "_first")


def _sanitized_key(name):
    """A header field without separators and case, enough to recognise a key column."""
    return F.lower(F.regexp_replace(F.trim(name), "[ ._-]", ""))


def land_pending(spark: SparkSession, ledger: Ledger, lake_root: str, run_id: str, pipeline: str,
                 ingest_date: str | None = None, multi_line: bool = False) -> dict[str, int]:
    """Write the pending contents of a run to the lake, each content once on any date.

    Files are grouped by dataset, header and whether quotes hold line breaks; each group is one
    Spark job over all its files. Equal bytes under several names are one content of one dataset.
    """
    date = ingest_date or utc_now().strftime("%Y-%m-%d")
    pending = _classified(ledger, run_id, pipeline)
    written = {"written": 0, "calls": 0, "incidents": 0}
    new = ledger.to_land(pending).select("dataset", "header", "quoted_breaks", "file_path", "file_sha256").collect()
    groups: dict[tuple, list[tuple[str, str]]] = {}
    for row in new:
        key = row["dataset"], tuple(row["header"]), bool(multi_line or row["quoted_breaks"])
        groups.setdefault(key, []).append((row["file_path"], row["file_sha256"]))
    for (dataset, raw_header, breaks), files in groups.items():
        lake.land_csv(spark, lake_root, dataset, date, raw_header, files, breaks)
        written["written"] += len(files)
        written[dataset] += len(files)
    target = F.concat(
        F.lit(f"{lake_root.rstrip('/')}/"), F.col("dataset"),
        F.lit(f"/ingest_date={date}/sha256="), F.col("file_sha256"),
    )
    earlier = ledger.landed().withColumnRenamed("lake_path", "_earlier_path")
    ledger.record_landed(
        pending.join(earlier, "file_sha256", "left"), F.coalesce("_earlier_path", target)
    )
    return written


def ingest_pending(spark: SparkSession, ledger: Ledger, bronze: Bronze, lake_root: str,
                   run_id: str, pipeline: str) -> dict[str, int]:
    """Append the pending contents of a run from the lake to bronze.

    ``rows_held`` counts all rows of these contents, with those of an earlier broken run; ``contents`` lists their
    hashes by dataset.
    """
    pending = _classified(ledger, run_id, pipeline)
    listed = pending.select("dataset", "header", "file_sha256").distinct().collect()
    result = {"inserted_calls": 0, "inserted_incidents": 0, "files": pending.count(), "rows_held": 0,
              "contents": {"calls": [], "incidents": []}}
    groups: dict[tuple, list[str]] = {}
    for row in listed:
        groups.setdefault((row["dataset"], tuple(row["header"])), []).append(row["file_sha256"])
        result["contents"][row["dataset"]].append(row["file_sha256"])
    for (dataset, raw_header), hashes in groups.items():
        names = sanitize_names(raw_header)
        for start in range(0, len(hashes), CONTENTS_PER_JOB):
            batch = sorted(hashes[start:start + CONTENTS_PER_JOB])
            rows = lake.read_landed(spark, lake_root, dataset, names, batch, ledger.lake_folders(batch))
            lined = shape.with_lineage(
                rows, F.col("row_number"), F.col("sha256"), F.col("file_path")
            ).select(*names, *shape.LINEAGE_COLUMNS)
            for inserted, held in bronze.append_new(dataset, lined, batch).values():
                result[f"inserted_{dataset}"] += inserted
                result["rows_held"] += held
    return result


