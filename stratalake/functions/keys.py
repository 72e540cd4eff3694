"""Hash keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_key(columns: Sequence[Column], separator: str = "|") -> Column:
    """MD5 over the columns as text; NULL counts as empty, so the key is never NULL."""
    parts = [F.coalesce(column.cast("string"), F.lit("")) for column in columns]
    return F.md5(F.concat_ws(separator, *parts))
