"""Tolerant casts and text cleaning. Built-in expressions only, so all of it is code-generated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators (category Zs). Tabs and line breaks are not
# among them, so they stay.
SPACES = "".join(
    map(chr, (0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000))
)

# The tokens that stand for a missing value in raw files.
NULL_TOKENS = ("None", "NULL", "")


def to_integer(value: Column, dtype: str = "int") -> Column:
    """Number text to an integer; NULL when it is no number or does not fit.

    Text with decimals or an exponent is rounded half away from zero.
    """
    exact = value.cast("string").try_cast("decimal(38,10)")
    return F.round(exact, 0).try_cast(dtype)


def to_long(value: Column) -> Column:
    return to_integer(value, "bigint")


def to_double(value: Column) -> Column:
    return value.cast("string").try_cast("double")


def drop_negative(value: Column) -> Column:
    """NULL for a negative number."""
    return F.when(value >= 0, value)


def trim_spaces(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def blank_to_null(text: Column) -> Column:
    """Trimmed text; NULL when nothing is left."""
    return F.nullif(trim_spaces(text), F.lit(""))


def first_text(*values: Column) -> Column:
    """Trimmed text of the first value that is not NULL.

    A blank first value wins over a filled second one and then becomes NULL.
    """
    return blank_to_null(F.coalesce(*[value.cast("string") for value in values]))


def placeholder(value: Column, default) -> Column:
    """A label or number in place of NULL."""
    return F.coalesce(value, F.lit(default))


def null_tokens_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NULL_TOKENS), text)


def bounded_number(value: Column, fill: float, low: float = 0.0, high: float | None = None,
                   digits: int | None = None) -> Column:
    """Number text to a double: bad or missing becomes ``fill``, then rounded and clipped."""
    number = F.coalesce(to_double(value), F.lit(float(fill)))
    if digits is not None:
        number = F.round(number, digits)
    # A comparison, so that a negative zero also becomes the lower bound.
    number = F.when(number > low, number).otherwise(F.lit(float(low)))
    return number if high is None else F.least(number, F.lit(float(high)))
