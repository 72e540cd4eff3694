"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = ("urlfilter", "langid", "secrets", "rules", "neardup", "packing", "tokenfile", "decontam", "htmltext", "cotrain",
            "substrings", "whitening", "spelling")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name in _MODULES:
        found.update(import_module(f"stratalake.llm.{name}").QUERIES)
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in _MODULES:
        found.update(getattr(import_module(f"stratalake.llm.{name}"), "ORACLES", {}))
    return found
