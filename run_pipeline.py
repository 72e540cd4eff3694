"""Entry point for spark-submit and schedulers.

    spark-submit run_pipeline.py incremental WAREHOUSE DROP [--export SERVING]
    spark-submit run_pipeline.py full WAREHOUSE CALLS_CSV INCIDENTS_CSV [--export SERVING]
    spark-submit run_pipeline.py stream WAREHOUSE DROP CHECKPOINT [--export SERVING]
    spark-submit run_pipeline.py export WAREHOUSE SERVING
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from stratalake.plans.kpi import KPI_TABLES  # noqa: E402
from stratalake.plans.pipeline import DIMENSIONS, Pipeline  # noqa: E402
from stratalake.session import configure, remove_scratch  # noqa: E402
from stratalake.sources import serving  # noqa: E402
from stratalake.streaming.dropzone import ingest_new_files  # noqa: E402


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(description="Bronze, silver and gold from dropped CSV files.")
    modes = main.add_subparsers(dest="mode", required=True)
    arguments = {"incremental": ("drop",), "full": ("calls", "incidents"), "stream": ("drop", "checkpoint"), "export": ("serving",)}
    for mode, names in arguments.items():
        one = modes.add_parser(mode)
        for name in ("warehouse", *names):
            one.add_argument(name)
        if mode != "export":
            one.add_argument("--export")
    return main


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Run one mode; returns (and prints) its counts."""
    given = parser().parse_args(arguments)
    own = spark is None
    spark = configure(spark or SparkSession.builder.appName(f"stratalake-{given.mode}").getOrCreate())
    pipeline, counts = Pipeline(spark, given.warehouse), {}
    if given.mode == "incremental":
        counts = pipeline.run_incremental(given.drop, export_to=given.export)
    elif given.mode == "full":
        counts = pipeline.run_full(given.calls, given.incidents, export_to=given.export)
    elif given.mode == "stream":
        ingest_new_files(pipeline, given.drop, given.checkpoint, export_to=given.export)
    else:
        serving.export(pipeline.warehouse, given.serving, [*KPI_TABLES, *DIMENSIONS])
    if own:
        remove_scratch(spark)
    print(json.dumps(counts, default=str))
    return counts


if __name__ == "__main__":
    main()
