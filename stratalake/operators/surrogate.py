"""Dense surrogate keys without a global one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import materialize

_PART = "_part"
_POSITION = "_position"
_BEFORE = "_before"


def _rows_before(parts: DataFrame) -> DataFrame:
    """Rows in all earlier partitions. One row per partition, so one task is enough."""
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy(_PART).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.select(_PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE))


def ordered_ids(df: DataFrame, order_by: Sequence[str], name: str,
                partitions: int | None = None) -> DataFrame:
    """``row_number`` over a global order, NULLs last, counted per range partition.

    Rows are range-partitioned by the order columns and stored once, so the range bounds,
    which come from a sample, cannot change between the count and the numbering. The order
    ends in a hash of the row, so that equal order keys still split over partitions.
    """
    return numbered(materialize(placed(df, order_by, partitions), "ordered-ids"), name)


def unordered_ids(df: DataFrame, name: str) -> DataFrame:
    """Dense ids 1..n in no particular order, without any shuffle of the rows.

    Each task numbers its rows while they are stored; the ids add the sizes of the earlier
    tasks, one row per task.
    """
    return numbered(materialize(placed(df), "unordered-ids"), name)


def placed(df: DataFrame, order_by: Sequence[str | Column] = (), partitions: int | None = None) -> DataFrame:
    """The frame with the place of each row, to be stored once and read by ``numbered``.

    A place is the number of the task and the position there; with ``order_by`` tasks hold ranges of the order.
    Hashes that rows are ordered by are made on both sides of the shuffle and not sent.
    """
    rows = df
    if order_by:
        tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        order = [*[(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order_by], tie.asc()]
        ranged = df.repartitionByRange(*order) if partitions is None else df.repartitionByRange(partitions, *order)
        rows = ranged.sortWithinPartitions(*order)
    low_bits = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select(F.spark_partition_id().alias(_PART), low_bits.alias(_POSITION), *[F.col(f"`{c}`") for c in df.columns])


def numbered(stored: DataFrame, name: str) -> DataFrame:
    """Stored rows of ``placed`` with their ids."""
    columns = [F.col(f"`{c}`") for c in stored.columns if c not in (_PART, _POSITION)]
    # Each part is there, so a left join keeps the same rows; it is left out where nothing asks for the ids.
    return stored.join(F.broadcast(_rows_before(stored)), _PART, "left").select(
        (F.col(_BEFORE) + F.col(_POSITION) + 1).alias(name), *columns)
