"""All queries by name."""

from __future__ import annotations

from examples import ingest, scalars, shown, silver_reports, star
from examples.mapping import Query

_MODULES = (star, scalars, silver_reports, ingest, shown)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in _MODULES:
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"two queries are named {name}")
            found[name] = query
    return found
