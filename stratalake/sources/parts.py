"""Tables in parts: a version lists part folders, so a refresh writes only the parts that it touches.

A part is a range of keys. The rows of a version lie in the folders its list names, most of them written by earlier
refreshes; a new version takes over the untouched ones as they are. Lists hold one row a part.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import COMPRESSION, one_by_one, small_frame

PART = "_part"
#: Place of a row in its part, from 1, where a table's ids are its places in the whole table.
PLACE = "_place"
LISTED = "part bigint, path string, row_count bigint, table_schema string, id_column string"

_PREFIX = "parts="


def is_list(path: str) -> bool:
    return path.rstrip("/").rsplit("/", 1)[-1].startswith(_PREFIX)


def part_of(key: str, width: int):
    """Number of the part of a key; missing keys lie in a part of their own."""
    return F.expr(f"coalesce(`{key}` div {int(width)}, -1)").cast("bigint")


def part_numbers(df: DataFrame) -> set[int]:
    """The parts that a frame has rows of: one row a part."""
    return set(part_sizes(df))


def part_sizes(df: DataFrame) -> dict[int, int]:
    """The rows of each part of a frame: one row a part."""
    return {row[PART]: row["count"] for row in df.select(PART).groupBy(PART).count().collect()}


def listed_sizes(spark: SparkSession, path: str | None, parts: Iterable[int]) -> dict[int, int]:
    """The rows of some parts of a listed version; parts without rows are not among them."""
    wanted = set(parts)
    return {e["part"]: e["row_count"] for e in _entries(spark, path) if e["part"] in wanted}


#: Rows from which parts are worked on in several runs, and about how many runs there are at most.
RUN_ROWS = 1_000_000
RUNS = 16


def runs(sizes: Mapping[int, int], most_runs: int = RUNS, least_rows: int | None = None) -> list[list[int]]:
    """Neighbouring parts put together to runs of about as many rows.

    Steps that shuffle take one run after the other, so that the shuffle files of one run at most lie on the disk.
    """
    most = max(RUN_ROWS if least_rows is None else least_rows, -(-sum(sizes.values()) // most_runs))
    found: list[list[int]] = []
    rows = 0
    for part in sorted(sizes):
        if not found or rows + sizes[part] > most:
            found.append([])
            rows = 0
        found[-1].append(part)
        rows += sizes[part]
    return found or [[]]


#: Lists read lately by their path; a list never changes. The oldest goes first.
_KNOWN_LISTS = 64
_known: dict[str, list[Row]] = {}


def _remember(path: str, entries: list[Row]) -> list[Row]:
    _known[path] = entries
    while len(_known) > _KNOWN_LISTS:
        _known.pop(next(iter(_known)))
    return entries


def _entries(spark: SparkSession, path: str | None) -> list[Row]:
    if path is None:
        return []
    return _known[path] if path in _known else _remember(path, spark.read.schema(LISTED).parquet(path).collect())


def write_parts(df: DataFrame | Iterable[DataFrame], folder: str, earlier: str | None, touched: Iterable[int],
                id_column: str | None = None, dealt: bool = False, order_by: Iterable[str] = ()) -> tuple[str, int]:
    """Write the rows of the touched parts and a list of them and the other parts of an earlier list; its path and rows.

    Several frames, each with parts of its own, are written one after the other, and the shuffle files of each are released
    before the next. A touched part without rows is left out of the new version. With ``id_column`` reads number all rows by
    part and ``_place``. The rows of ``dealt`` frames lie by their parts already; ``order_by`` sorts each file.
    """
    touched, written = set(touched), []
    for frame in one_by_one(df):
        spark, data = frame.sparkSession, f"{folder}/data={uuid.uuid4().hex}"
        columns = T.StructType([field for field in frame.schema if field.name != PART] + [T.StructField(PART, T.LongType())])
        frame = frame if dealt else frame.hint("rebalance", PART)
        frame = frame.sortWithinPartitions(PART, *order_by) if order_by else frame
        frame.write.option("compression", COMPRESSION).partitionBy(PART).parquet(data)
        del frame
        # Only the folder names and the footers are read.
        sizes = part_sizes(spark.read.schema(columns).parquet(data)) if touched else {}
        written += [(part, f"{data}/{PART}={part}", size) for part, size in sizes.items()]
    known = (columns.json(), id_column)
    rows = [(e["part"], e["path"], e["row_count"], *known)
            for e in _entries(spark, earlier) if e["part"] is not None and e["part"] not in touched]
    rows += [(*entry, *known) for entry in written]
    path = f"{folder}/{_PREFIX}{uuid.uuid4().hex}"
    rows = sorted(rows) or [(None, None, 0, *known)]
    small_frame(spark, rows, LISTED).coalesce(1).write.parquet(path)
    _remember(path, [Row(part=r[0], path=r[1], row_count=r[2], table_schema=r[3], id_column=r[4]) for r in rows])
    return path, sum(r[2] for r in rows)


def read_parts(spark: SparkSession, path: str, parts: Iterable[int] | None = None, hidden: bool = False) -> DataFrame:
    """Rows of a listed version, of all parts or of some; columns that begin with ``_`` only if ``hidden``."""
    entries = _entries(spark, path)
    schema = T.StructType.fromJson(json.loads(entries[0]["table_schema"]))
    id_column = entries[0]["id_column"]
    listed = [e for e in entries if e["part"] is not None]
    wanted = None if parts is None else set(parts)
    chosen = [e for e in listed if wanted is None or e["part"] in wanted]
    if chosen:
        folder = path.rstrip("/").rsplit("/", 1)[0]
        rows = spark.read.schema(schema).option("basePath", folder).parquet(*[e["path"] for e in chosen]).select(*schema.names)
    else:
        rows = spark.createDataFrame([], schema)
    if hidden:
        return rows
    names = [name for name in schema.names if not name.startswith("_")]
    if id_column is None:
        return rows.select(*names)
    before, offsets = 0, []
    for e in sorted(listed, key=lambda e: e["part"]):
        offsets.append((e["part"], before))
        before += e["row_count"]
    # One row a part.
    starts = F.broadcast(small_frame(spark, offsets, f"{PART} bigint, _before bigint"))
    return rows.join(starts, PART).select((F.col("_before") + F.col(PLACE)).alias(id_column), *names)


def data_folders(spark: SparkSession, paths: Iterable[str]) -> set[str]:
    """The data folders that some lists name."""
    return {e["path"].rsplit("/", 1)[0] for path in paths for e in _entries(spark, path) if e["path"]}
