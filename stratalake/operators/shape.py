"""Projection and schema shaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import casts, times

LINEAGE_COLUMNS = (
    "_source_row_number",
    "_source_sha256",
    "_source_file_path",
    "_ingested_at_utc",
)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def all_text(df: DataFrame) -> DataFrame:
    """Every column as a string."""
    return df.select([F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])


def clear_null_tokens(df: DataFrame) -> DataFrame:
    """NULL for the missing-value tokens in every string column."""
    return df.select(
        [
            casts.null_tokens_to_null(F.col(f"`{field.name}`")).alias(field.name)
            if isinstance(field.dataType, T.StringType)
            else F.col(f"`{field.name}`")
            for field in df.schema
        ]
    )


def with_lineage(df: DataFrame, row_number: Column, sha256: Column, file_path: Column) -> DataFrame:
    """Bronze lineage columns, as text like all of bronze."""
    return df.withColumns(
        {
            "_source_row_number": row_number.cast("string"),
            "_source_sha256": sha256.cast("string"),
            "_source_file_path": file_path.cast("string"),
            "_ingested_at_utc": times.now_utc().cast("string"),
        }
    )


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns in the order of a target schema; absent ones become typed NULLs."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(f"`{field.name}`") if field.name in present else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in target
        ]
    )


def to_header(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """Exactly the columns of a header, as text; absent ones are NULL."""
    return align(df, T.StructType([T.StructField(name, T.StringType()) for name in header]))


def evolve(target: T.StructType, incoming: Sequence[str]) -> T.StructType:
    """Target schema plus the incoming columns it lacks, as strings at the end."""
    known = set(target.names)
    added = [T.StructField(name, T.StringType()) for name in incoming if name not in known]
    return T.StructType([*target.fields, *added])


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_as_text(*frames: DataFrame) -> DataFrame:
    """Rows of frames that share names but differ in types, on the common type string."""
    return reduce(DataFrame.unionByName, [all_text(frame) for frame in frames])


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).distinct()


def labelled_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row (tbl, n) per table."""
    parts = [
        frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a NULL in the named columns."""
    return df.dropna(subset=list(columns))


def serving_text(df: DataFrame) -> DataFrame:
    """String columns as plain strings, whatever their length or collation type."""
    string_types = (T.StringType, T.CharType, T.VarcharType)
    return df.select(
        [
            F.col(f"`{field.name}`").cast("string").alias(field.name)
            if isinstance(field.dataType, string_types)
            else F.col(f"`{field.name}`")
            for field in df.schema
        ]
    )
