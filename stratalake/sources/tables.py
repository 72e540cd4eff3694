"""Stored tables with versions that are published together."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.functions.times import now_utc
from stratalake.operators.surrogate import numbered, placed
from stratalake.session import COMPRESSION, one_by_one, small_frame
from stratalake.sources import parts

#: Folder of a version whose ids are the places of its rows: the prefix and the name of the id column.
_NUMBERED = "numbered="

VERSIONS = "table_name string, path string, row_count bigint, published_at timestamp_ntz"


@dataclass(frozen=True)
class Staged:
    """A table version that is written but not visible yet."""

    table: str
    path: str
    rows: int


def ensure_table(spark: SparkSession, path: str, schema: str) -> None:
    """Create an empty Parquet table unless there is one."""
    small_frame(spark, [], schema).coalesce(1).write.mode("ignore").parquet(path)


def append_rows(spark: SparkSession, path: str, rows: Iterable[tuple], schema: str) -> None:
    """Append a few driver-made rows as one file, so that they appear all at once."""
    small_frame(spark, rows, schema).coalesce(1).write.mode("append").parquet(path)


class Warehouse:
    """Layered tables under one root folder.

    A refresh writes a new version next to the current one, so a job may read the table it
    replaces. ``publish`` makes any number of versions visible with one appended file. Table
    names are ``layer.table``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        ensure_table(spark, self._history(), VERSIONS)

    def _history(self) -> str:
        return self.path("meta", "table_versions")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def versions(self) -> DataFrame:
        """(table_name, path, row_count): the current version of each table."""
        history = self.spark.read.schema(VERSIONS).parquet(self._history())
        latest = F.max_by(F.struct("path", "row_count"), F.struct("published_at", "path"))
        return history.groupBy("table_name").agg(latest.alias("v")).select("table_name", "v.*")

    def _paths(self) -> dict[str, str]:
        return {row["table_name"]: row["path"] for row in self.versions().collect()}

    def exists(self, table: str) -> bool:
        return table in self._paths()

    def read_all(self, tables: Iterable[str]) -> list[DataFrame]:
        """Several tables as of the same moment."""
        paths = self._paths()
        missing = [table for table in tables if table not in paths]
        if missing:
            raise LookupError(f"tables {missing} do not exist in {self.root}")
        return [self._open(paths[table]) for table in tables]

    def _open(self, path: str) -> DataFrame:
        if parts.is_list(path):
            return parts.read_parts(self.spark, path)
        rows, folder = self.spark.read.parquet(path), path.rstrip("/").rsplit("/", 1)[-1]
        if folder.startswith(_NUMBERED):
            return numbered(rows, folder.removeprefix(_NUMBERED).rsplit("-", 1)[0])
        return rows

    def read(self, *tables: str) -> DataFrame | list[DataFrame]:
        """One table, or several as of the same moment."""
        frames = self.read_all(tables)
        return frames[0] if len(frames) == 1 else frames

    def read_optional(self, table: str) -> DataFrame | None:
        path = self._paths().get(table)
        return None if path is None else self._open(path)

    def stage(self, table: str, df: DataFrame | Iterable[DataFrame], cluster_by: str | None = None) -> Staged:
        """Write a new version and count its rows on the way.

        ``cluster_by`` sorts each file by a column that readers filter on, so that they can
        skip row groups; no rows move between tasks. Several frames are written one after the other, and the shuffle files
        of each are released before the next.
        """
        folder, staged = f"version={uuid.uuid4().hex}", None
        for frame in one_by_one(df):
            frame = frame if cluster_by is None else frame.sortWithinPartitions(cluster_by)
            part = self._write(table, frame, folder)
            del frame
            staged = part if staged is None else Staged(table, part.path, staged.rows + part.rows)
        return staged

    def stage_numbered(self, table: str, df: DataFrame, name: str, order_by: Iterable[str | Column] = (),
                       cluster_by: str | None = None, add: Mapping[str, Column] | None = None) -> Staged:
        """Write a new version with a dense id, in the order of some columns or in none; the rows are written once.

        Stored is the place of each row; reads add the sizes of the earlier tasks, one row per task. Columns to ``add``
        are made as the rows are written.
        """
        if cluster_by is not None:
            df = df.sortWithinPartitions(cluster_by)
        rows = placed(df, list(order_by))
        added = [column.alias(c) for c, column in (add or {}).items()]
        rows = rows.select(*rows.columns[:2], *added, *rows.columns[2:])
        return self._write(table, rows, f"{_NUMBERED}{name}-{uuid.uuid4().hex}")

    def _write(self, table: str, df: DataFrame, folder: str) -> Staged:
        path = self.path(table.replace(".", "/"), folder)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").option("compression", COMPRESSION).parquet(path)
        return Staged(table, path, int(seen.get["n"]))

    def read_staged(self, staged: Staged) -> DataFrame:
        return self._open(staged.path)

    def listed(self, table: str) -> str | None:
        """The list of parts that is a table's current version, if it is kept in parts."""
        path = self._paths().get(table)
        return path if path is not None and parts.is_list(path) else None

    def stage_parts(self, table: str, df: DataFrame | Iterable[DataFrame], touched: Iterable[int], id_column: str | None = None,
                    earlier: str | None = None, dealt: bool = False, order_by: Iterable[str] = ()) -> Staged:
        """Write the touched parts of a table (``_part`` numbers them), from one frame or several, as a new version over an earlier list."""
        path, rows = parts.write_parts(df, self.path(table.replace(".", "/")), earlier, touched, id_column, dealt, order_by)
        return Staged(table, path, rows)

    def publish(self, *staged: Staged) -> None:
        rows = small_frame(
            self.spark, [(s.table, s.path, s.rows) for s in staged],
            "table_name string, path string, row_count bigint",
        ).withColumn("published_at", now_utc())
        rows.coalesce(1).write.mode("append").parquet(self._history())

    def write(self, table: str, df: DataFrame) -> int:
        """Full refresh of one table; returns its row count."""
        staged = self.stage(table, df)
        self.publish(staged)
        return staged.rows

    def vacuum(self, keep: int = 2) -> int:
        """Delete the files of all but the newest ``keep`` published versions of each table; returns how many.

        Of tables in parts the folders go that no kept version lists.
        Jobs that still read an older version must have ended. The history itself stays.
        """
        if keep < 1:
            raise ValueError("the current version must be kept")
        history = self.spark.read.schema(VERSIONS).parquet(self._history())
        newest = Window.partitionBy("table_name").orderBy(F.col("published_at").desc(), F.col("path").desc())
        ages = [(r["path"], r["age"] > keep) for r in history.withColumn("age", F.row_number().over(newest)).collect()]
        lists = [(path, gone) for path, gone in ages if parts.is_list(path) and self._is_there(path)]
        kept = parts.data_folders(self.spark, [path for path, gone in lists if not gone])
        unused = parts.data_folders(self.spark, [path for path, gone in lists if gone]) - kept
        removed = sum(self._delete(path) for path, gone in ages if gone)
        for path in unused:
            self._delete(path)
        return removed

    def _hadoop(self, path: str) -> tuple:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _is_there(self, path: str) -> bool:
        store, place = self._hadoop(path)
        return bool(store.exists(place))

    def _delete(self, path: str) -> bool:
        store, place = self._hadoop(path)
        return bool(store.delete(place, True))

    def tables(self, layer: str | None = None) -> DataFrame:
        """(layer, table_name, row_count) of the current tables."""
        parts = F.split("table_name", r"\.")
        listed = self.versions().select(
            parts[0].alias("layer"), parts[1].alias("table_name"), "row_count"
        )
        return listed if layer is None else listed.filter(F.col("layer") == layer)

    def columns(self, table: str) -> DataFrame:
        return schema_table(self.read(table))

    def find(self, name: str, prefer: str = "gold") -> str | None:
        """Full name of a table from its last part; the preferred layer wins."""
        layers = sorted(
            row["layer"] for row in self.tables().filter(F.col("table_name") == name).collect()
        )
        if not layers:
            return None
        return f"{prefer if prefer in layers else layers[0]}.{name}"

    def register_views(self, layer: str = "gold") -> list[str]:
        """Make the tables of a layer known to Spark SQL by their short names."""
        names = [row["table_name"] for row in self.tables(layer).collect()]
        for name in names:
            self.read(f"{layer}.{name}").createOrReplaceTempView(name)
        return sorted(names)


def schema_table(df: DataFrame) -> DataFrame:
    """(ordinal, column_name, data_type) of any frame; no data is read."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return small_frame(df.sparkSession, rows, "ordinal int, column_name string, data_type string")


def catalog_tables(spark: SparkSession) -> DataFrame:
    """(database, table_name, table_type) of the session catalog."""
    rows = []
    for database in spark.catalog.listDatabases():
        for table in spark.catalog.listTables(database.name):
            rows.append((database.name, table.name, table.tableType))
    return small_frame(
        spark, sorted(set(rows)), "database string, table_name string, table_type string"
    )


def catalog_columns(spark: SparkSession, table: str) -> DataFrame:
    rows = [(i, c.name, c.dataType) for i, c in enumerate(spark.catalog.listColumns(table))]
    return small_frame(spark, rows, "ordinal int, column_name string, data_type string")


def require_tables(warehouse: Warehouse, names: Iterable[str]) -> None:
    """Raise with the list of all tables that are missing."""
    known = warehouse.versions().select("table_name").collect()
    missing = sorted(set(names) - {row["table_name"] for row in known})
    if missing:
        raise LookupError(f"required tables are missing: {missing}; run the gold build first")


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet by its suffix, anything else as all-string CSV."""
    if path.lower().endswith(".parquet"):
        return spark.read.parquet(path)
    from stratalake.sources.csv import read_text

    return read_text(spark, path)

