"""The landing lake: raw text as Parquet, one folder per date and content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.names import sanitize_names
from stratalake.functions.times import now_utc
from stratalake.operators.joins import lookup
from stratalake.session import COMPRESSION, materialize, small_frame
from stratalake.sources.csv import read_text, text_schema
from stratalake.sources.files import existing, literal_path, source_path

# Where a row stood in its CSV file: start of the read block and position within the task.
_BLOCK = "_block_start"
_POSITION = "_block_position"

# Files landed by one job. It bounds the path-to-hash table that each task holds.
FILES_PER_JOB = 10_000


def dataset_path(lake_root: str, dataset: str) -> str:
    return f"{lake_root.rstrip('/')}/{dataset}"


def target_path(lake_root: str, dataset: str, ingest_date: str, sha256: str) -> str:
    return f"{dataset_path(lake_root, dataset)}/ingest_date={ingest_date}/sha256={sha256}"


def land_csv(spark: SparkSession, lake_root: str, dataset: str, ingest_date: str,
             raw_header: Sequence[str], files: Sequence[tuple[str, str]],
             multi_line: bool = False) -> None:
    """Write CSV files that share one header as all-string Parquet.

    ``files`` lists (path, hash), each content once. The blocks of a file are written by the
    tasks that read them, so nothing is shuffled and a huge file is split. A repeated run
    replaces the folder of a content and leaves the others alone.
    """
    for start in range(0, len(files), FILES_PER_JOB):
        _land(spark, lake_root, dataset, ingest_date, raw_header,
              files[start:start + FILES_PER_JOB], multi_line)


def _land(spark, lake_root, dataset, ingest_date, raw_header, files, multi_line) -> None:
    names = sanitize_names(raw_header)
    text = read_text(spark, [literal_path(path) for path, _ in files], names, multi_line)
    hashes = F.broadcast(
        small_frame(spark, files, "_source_file_path string, sha256 string")
    )
    placed = text.select(
        *[F.col(f"`{name}`") for name in names],
        source_path().alias("_source_file_path"),
        now_utc().cast("string").alias("_lake_written_at_utc"),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_POSITION),
    )
    (
        placed.join(hashes, "_source_file_path", "left")
        .withColumn("sha256", F.coalesce("sha256", F.raise_error(
            F.concat(F.lit("no content hash for "), F.col("_source_file_path")))))
        .select(*names, "_source_file_path", "_lake_written_at_utc", _BLOCK, _POSITION,
                F.lit(ingest_date).alias("ingest_date"), "sha256")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy("ingest_date", "sha256")
        .parquet(dataset_path(lake_root, dataset))
    )


def read_landed(spark: SparkSession, lake_root: str, dataset: str, columns: Sequence[str],
                hashes: Sequence[str], folders: Sequence[str] | None = None) -> DataFrame:
    """Landed rows of some contents with their row number in the CSV file, from 0.

    Only the folders of these contents are read; where ``folders`` names them, no other is even listed. The number of a row is the size of the
    earlier blocks of its file plus its place in the block, both stored at landing, so every
    read gives the same numbers.
    """
    full = T.StructType([
        *text_schema([*columns, "_source_file_path", "_lake_written_at_utc"]),
        T.StructField(_BLOCK, T.LongType()),
        T.StructField(_POSITION, T.LongType()),
        *text_schema(["ingest_date", "sha256"]),
    ])
    root = dataset_path(lake_root, dataset)
    if folders is None:
        rows = spark.read.schema(full).parquet(root).filter(F.col("sha256").isin(list(hashes)))
    elif there := existing(spark, folders):
        rows = spark.read.schema(full).option("basePath", root).parquet(*there)
    else:
        rows = spark.createDataFrame([], full)
    earlier = Window.partitionBy("sha256").orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rows.groupBy("sha256", _BLOCK)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(_POSITION).alias("_first"))
        .select("sha256", _BLOCK, "_first",
                F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    # One row per block, so the data itself is shuffled only for a huge number of blocks.
    placed = lookup(rows, materialize(blocks, "blocks"), ["sha256", _BLOCK], [_POSITION], "inner")
    return placed.select(
        *[F.col(f"`{name}`") for name in columns],
        (F.col("_before") + F.col(_POSITION) - F.col("_first")).alias("row_number"),
        F.col("sha256"),
        F.col("_source_file_path").alias("file_path"),
    )
