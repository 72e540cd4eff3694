"""Tolerant CSV reading and CSV writing."""

from __future__ import annotations

import csv as python_csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.names import sanitize_name
from stratalake.operators.aggregates import count_where
from stratalake.operators.shape import clear_null_tokens
from stratalake.session import materialize, small_frame
from stratalake.sources.files import literal_path
from stratalake.sources.records import opens, read_records, text_lines

# Texts that a type writes back as they are: no leading zero, no sign or suffix that would get lost, no trailing zero of a fraction.
_LONG = r"^(0|-?[1-9][0-9]{0,18})$"
_DOUBLE = r"^(0(\.0)?|-?(0\.[0-9]*[1-9]|[1-9][0-9]*(\.([0-9]*[1-9]|0))?))$"
#: Rows of one compressed file.
COMPRESSED_ROWS = 500_000
# Digits that a double always keeps.
_DIGITS = 15


def _options(multi_line: bool) -> dict[str, str]:
    """Quotes are escaped by doubling; a broken value becomes NULL and the row stays.

    Multi-line mode reads quoted line breaks, but makes each file one task, so it is off
    unless the data needs it.
    """
    return {
        "header": "true",
        "mode": "PERMISSIVE",
        "escape": '"',
        "multiLine": str(multi_line).lower(),
    }


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def header(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """Raw column names; only the first line is read."""
    return spark.read.options(**_options(multi_line)).option("inferSchema", "false").csv(path).columns


def header_table(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, raw_name, name) of a CSV file."""
    rows = [(i, raw, sanitize_name(raw)) for i, raw in enumerate(header(spark, path))]
    return small_frame(spark, rows, "ordinal int, raw_name string, name string")


def read_text(spark: SparkSession, paths: str | Sequence[str],
              columns: Sequence[str] | None = None, multi_line: bool | None = None) -> DataFrame:
    """All columns as strings with missing-value tokens as NULL.

    Fields beyond the header are dropped and absent ones are NULL. With ``columns`` no file
    is opened before the job starts. Without, files are grouped by their own header and by whether quotes hold
    line breaks, and the groups are put together by column name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if columns is None:
        groups = _file_groups(spark, paths)
        parts = [_read_split(spark, files, names) if (breaks if multi_line is None else multi_line)
                 else _read_group(spark, [literal_path(f) for f in files], names, False)
                 for (names, breaks), files in sorted(groups.items())]
        if not parts:
            return _read_group(spark, paths, header(spark, paths[0]), bool(multi_line))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _read_group(spark, paths, columns, bool(multi_line))


def _file_groups(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[tuple[str, ...], bool], list[str]]:
    """Files by header and by whether quotes hold line breaks, from one native scan; a row a file reaches the driver."""
    lines = text_lines(spark, paths).withColumn("at", F.struct("block", F.monotonically_increasing_id()))
    filled = F.when(F.trim(F.regexp_replace("line", "\r", "")) != "", F.col("at"))
    found = lines.groupBy("file").agg(F.min_by("line", filled).alias("first"), F.max(opens(F.col("line"))).alias("breaks"),
                                      F.max(filled).isNotNull().alias("has_lines"), F.min_by(opens(F.col("line")), filled).alias("cut"))
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for row in found.where("has_lines").collect():
        path = literal_path(row["file"])
        if row["cut"]:  # the header itself holds a line break
            names = header(spark, path, multi_line=True)
        else:
            names = next(python_csv.reader([row["first"].removeprefix("\ufeff").removesuffix("\r")]))
        groups.setdefault((tuple(names), row["breaks"]), []).append(row["file"])
    return groups


def _read_group(spark: SparkSession, paths: Sequence[str], names: Sequence[str], multi_line: bool) -> DataFrame:
    reader = spark.read.options(**_options(multi_line)).schema(text_schema(names))
    return clear_null_tokens(reader.csv(list(paths)))


def _read_split(spark: SparkSession, files: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Files whose quotes hold line breaks, each read by many tasks."""
    fields = ", ".join("`{}` string".format(name.replace("`", "``")) for name in names)
    options = {k: v for k, v in _options(True).items() if k != "header"}
    parsed = read_records(spark, files).select(F.from_csv("record", fields, options).alias("row"))
    return clear_null_tokens(parsed.select([F.col("row").getField(name).alias(name) for name in names]))


def infer_types(text: DataFrame) -> T.StructType:
    """Narrowest of long, double, boolean and string that keeps every value of each column.

    A type fits a value only if it writes it back as it was, but for whole numbers between fractions. Codes such as ``0123``, ``12D``,
    ``+5`` or ``1.10``, numbers with more digits than a type holds, ``NaN`` and ``Infinity`` stay text.
    """
    candidates = ("bigint", "double", "boolean")
    checks = []
    for i, name in enumerate(text.columns):
        value = F.col(f"`{name}`")
        checks.append(count_where(value.isNotNull()).alias(f"c{i}_known"))
        keeps = {
            "bigint": value.rlike(_LONG) & value.try_cast("bigint").isNotNull(),
            "double": value.rlike(_DOUBLE) & (F.length(F.regexp_replace(value, "[-.]", "")) <= _DIGITS),
            "boolean": value.isin("true", "false"),
        }
        checks += [count_where(value.isNotNull() & ~keeps[dtype]).alias(f"c{i}_{dtype}") for dtype in candidates]
    found = text.agg(*checks).first()
    types = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    fields = []
    for i, name in enumerate(text.columns):
        fits = [t for t in candidates if found[f"c{i}_known"] and found[f"c{i}_{t}"] == 0]
        fields.append(T.StructField(name, types[fits[0]] if fits else T.StringType()))
    return T.StructType(fields)


def read_inferred(spark: SparkSession, path: str, overrides: Mapping[str, str] | None = None,
                  multi_line: bool | None = None, stored_at: str | None = None) -> DataFrame:
    """Types inferred from all rows, with fixed types for the named columns.

    A value that does not fit a fixed type becomes NULL; inferred types fit every value. The text is stored once; who
    names the path may remove it as soon as nothing reads the frame.
    """
    text = materialize(read_text(spark, path, multi_line=multi_line), "csv-text", stored_at)
    chosen = {field.name: field.dataType.simpleString() for field in infer_types(text)}
    chosen.update(overrides or {})
    return text.select([F.col(f"`{name}`").try_cast(chosen[name]).alias(name) for name in text.columns])


def write(df: DataFrame, path: str, compressed: bool = False) -> None:
    """Write a folder of CSV files; spaces around values are kept.

    A compressed file is read by one task, so there is a new one after every ``COMPRESSED_ROWS`` rows.
    """
    options = {
        "header": "true", "escape": '"',
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    if compressed:
        options |= {"compression": "gzip", "maxRecordsPerFile": str(COMPRESSED_ROWS)}
    df.write.options(**options).mode("overwrite").csv(path)
