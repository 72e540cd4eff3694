"""Drop-zone ingestion as a stream of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratalake.plans.pipeline import Pipeline
from stratalake.sources.files import stream_drop


def ingest_new_files(pipeline: Pipeline, drop_dir: str, checkpoint: str,
                     max_files: int | None = None, export_to: str | None = None) -> None:
    """Take in every file that arrived since the last call up to gold, then stop.

    The stream carries only the file listing and remembers the paths it has seen; the ledger
    knows contents by hash, so a renamed copy is skipped. Each batch is an incremental run: a
    content counts as done once gold is published, and a batch that fails ends its run as
    FAILED and is repeated, adding only rows that bronze lacks.
    """

    def take_in(listing: DataFrame, batch_id: int) -> None:
        pipeline.run_incremental(
            drop_dir, trigger="STREAM", notes=f"batch {batch_id}", export_to=export_to, files=listing)

    query = (
        stream_drop(pipeline.spark, drop_dir, max_files=max_files)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
