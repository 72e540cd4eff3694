"""Keep-latest deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.joins import find_hot_keys

# Fixed value: what a missing timestamp counts as when rows of a key are ranked.
MISSING_TIME = "1900-01-01 00:00:00"


def newest_first(ts: str) -> Column:
    """Descending order in which a missing time counts as 1900-01-01."""
    return F.coalesce(F.col(ts), F.lit(MISSING_TIME).cast("timestamp_ntz")).desc()


def by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by their key, unless a key is hot; for wide rows before ``keep_first``.

    Ranking in the map tasks sorts whole input splits, which costs memory and saves nothing where few rows of a
    split share a key. Rows that are dealt are sorted once, in tasks of bounded size. With a hot key the frame
    stays as it is, and ``keep_first`` ranks before the shuffle.
    """
    return df if find_hot_keys(df, keys, nulls=True) else df.repartition(*[F.col(f"`{k}`") for k in keys])


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], tie: str | None = None) -> DataFrame:
    """One row per key, the first in the given order; NULL keys form one group.

    Spark ranks within the map tasks before the shuffle (WindowGroupLimit), so a hot key
    sends one row per map task. The order ends in a hash of the whole row, which makes it
    total up to identical rows; ``tie`` names a column that holds such a hash already.
    """
    last = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]) if tie is None else F.col(f"`{tie}`")
    total_order = [*order, last.desc()]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*total_order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
