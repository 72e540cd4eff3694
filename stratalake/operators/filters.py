"""Row filters, built as column expressions and never as SQL text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_not_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(name).isNotNull() for name in columns])


def equals(choices: Mapping[str, object]) -> Column:
    """Equality on every column whose choice is not None; None means all values."""
    return all_of([F.col(name) == F.lit(v) for name, v in choices.items() if v is not None])


def in_lists(choices: Mapping[str, Sequence]) -> Column:
    """Membership on every column whose list is not empty; an empty list means all values."""
    return all_of([F.col(name).isin(list(values)) for name, values in choices.items() if values])


def date_range(column: str, first, last) -> Column:
    """Inclusive range on a date column."""
    return F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def trailing_days(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows of the last days up to the latest timestamp in the data."""
    latest = df.agg(F.max(ts).alias("latest")).scalar()
    return df.filter(F.col(ts) >= latest - F.expr(f"INTERVAL {int(days)} DAYS"))
