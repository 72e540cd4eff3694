"""The serving copy: key figures and dimensions in a store of their own, without the fact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame

from stratalake.functions.times import now_utc
from stratalake.operators.aggregates import top_k
from stratalake.operators.shape import serving_text
from stratalake.session import side_by_side, small_frame
from stratalake.sources.tables import Warehouse, require_tables

METADATA = "dashboard_metadata"
NOTE = "serving copy: key figures and dimensions, no fact table"


def export(source: Warehouse, target_root: str, tables: Sequence[str], layer: str = "gold") -> Warehouse:
    """Copy the named tables and a metadata row; all become visible together.

    A missing table is an error before anything is written. Each export is a new version, so
    readers of the old one are not disturbed.
    """
    spark = source.spark
    names = [f"{layer}.{table}" for table in tables]
    require_tables(source, names)
    target = Warehouse(spark, target_root)
    frames = dict(zip(names, source.read_all(names)))
    staged = side_by_side(*[partial(target.stage, name, frame) for name, frame in frames.items()])
    metadata = small_frame(spark, [(source.root, NOTE)], "source_db string, note string").select(now_utc().alias("exported_at"), "source_db", "note")
    staged.append(target.stage(f"meta.{METADATA}", metadata.coalesce(1)))
    target.publish(*staged)
    return target


def read_serving(store: Warehouse, name: str, required: bool = True) -> DataFrame | None:
    """A table of the serving copy by its short name, text columns as plain strings."""
    found = store.find(name)
    if found is None:
        if required:
            raise LookupError(f"{name} is not in the serving copy {store.root}; export again")
        return None
    return serving_text(store.read(found))


def served_top_types(store: Warehouse, k: int = 20) -> DataFrame:
    rows = read_serving(store, "v_kpi_top_incident_type")
    return top_k(rows, "incident_count", ["call_type_group", "call_type"], k)
