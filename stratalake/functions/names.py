"""Column names: sanitising, resolution among candidates, dataset classification."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word ends at a separator, before a capitalised word, and between a lower-case letter or
# digit and an upper-case letter.
_WORD_BREAK = re.compile(r"[ ._-]+|(?<=.)(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])")


def sanitize_name(name: str) -> str:
    """Lower snake case; one leading underscore is kept."""
    text = name.strip()
    words = [word for word in _WORD_BREAK.split(text) if word]
    return ("_" if text.startswith("_") else "") + "_".join(words).lower()


def sanitize_names(names: Sequence[str]) -> list[str]:
    """Sanitise a header; two columns that end up with one name are an error."""
    clean = [sanitize_name(name) for name in names]
    origins: dict[str, list[str]] = {}
    for raw, new in zip(names, clean):
        origins.setdefault(new, []).append(raw)
    clashes = {new: raws for new, raws in origins.items() if len(raws) > 1}
    if clashes:
        raise ValueError(f"columns share a name after sanitising: {clashes}")
    return clean


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitize_names(df.columns))


def pick(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    """First candidate that exists, or None."""
    present = set(columns)
    return next((name for name in candidates if name in present), None)


def required_column(df: DataFrame, *candidates: str) -> Column:
    name = pick(df.columns, candidates)
    if name is None:
        raise ValueError(f"none of the columns {list(candidates)} exists")
    return F.col(name)


def optional_column(df: DataFrame, *candidates: str, dtype: str = "string") -> Column:
    """First candidate that exists, else a NULL of the given type."""
    name = pick(df.columns, candidates)
    return F.lit(None).cast(dtype) if name is None else F.col(name)


CALLS = "calls"
INCIDENTS = "incidents"

# The key columns whose presence tells the two datasets apart.
CALL_KEYS = ("call_number", "callnumber")
INCIDENT_KEYS = ("incident_number", "incidentnumber")


def classify_dataset(has_call_key: Column, has_incident_key: Column, path: Column) -> Column:
    """Dataset of a file from its key columns, with the path as the tie-break.

    With both keys the word "call" in the path decides for calls. With no key the word
    "incident" is looked for first. Everything undecided is incidents.
    """
    lower_path = F.lower(path)
    names_call = lower_path.contains("call")
    names_incident = lower_path.contains("incident")
    both_keys = has_call_key & has_incident_key
    no_key = ~has_call_key & ~has_incident_key
    is_calls = (
        (both_keys & names_call)
        | (has_call_key & ~has_incident_key)
        | (no_key & names_call & ~names_incident)
    )
    return F.when(is_calls, F.lit(CALLS)).otherwise(F.lit(INCIDENTS))
