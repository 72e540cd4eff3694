"""Repeatable random samples of a fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows are counted in 2**20 hash buckets, so the cut is found from at most that many rows.
_BUCKET_BITS = 20


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 33) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the ones with the smallest hash of their key.

    A first pass counts rows per hash bucket and finds the bucket in which the n-th row
    falls. The second pass drops every later bucket in the scan, so only about n rows are
    sorted. Apply other filters to the result to sample before filtering.
    """
    hashed = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    bucket = F.shiftrightunsigned(hashed, 64 - _BUCKET_BITS)
    sizes = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("rows"))
    upto = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        sizes.withColumn("upto", F.sum("rows").over(upto))
        .filter(F.col("upto") >= n)
        .agg(F.min("b").alias("cut"))
        .scalar()
    )
    kept = df.filter(bucket <= F.coalesce(cut, F.lit(1 << _BUCKET_BITS)))
    # The top bit is cleared by the shift, so order by the unsigned bucket first.
    return kept.orderBy(bucket, hashed, *[F.col(k) for k in keys]).limit(n)
