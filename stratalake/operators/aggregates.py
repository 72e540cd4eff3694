"""Aggregates beyond a plain groupBy: profiles, shares, histograms, exact quantiles, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions import times
from stratalake.session import materialize

# Distinct values that one task may hold when it picks an exact quantile.
QUANTILE_TASK_ROWS = 1_000_000


def rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    """Rows that meet a condition, 0 when none does."""
    return F.count(F.when(condition, F.lit(1)))


def null_count(column: str) -> Column:
    return count_where(F.col(column).isNull())


def average_where(value: Column, condition: Column) -> Column:
    """Average over the rows that meet a condition."""
    return F.avg(F.when(condition, value))


def sum_or_zero(value: Column) -> Column:
    return F.sum(F.coalesce(value, F.lit(0)))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, 0 for an empty whole."""
    return F.when(whole > 0, part / whole * 100.0).otherwise(F.lit(0.0))


def is_empty_flag() -> Column:
    return F.when(rows() == 0, F.lit(1)).otherwise(F.lit(0))


def group_counts(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(rows().alias(name))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, total, nulls, null_percent) of all columns in one pass."""
    counts = df.agg(rows().alias("total"), *[null_count(c).alias(c) for c in columns])
    return counts.unpivot(["total"], list(columns), "column_name", "nulls").select(
        "column_name", "total", "nulls",
        percent(F.col("nulls"), F.col("total")).alias("null_percent"),
    )


def range_profile(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.min(column).alias("min_value"), F.max(column).alias("max_value"), rows().alias("n")
    )


def top_k(df: DataFrame, measure: str, ties: Sequence[str], k: int) -> DataFrame:
    """The k rows with the largest measure; ties in the order of the given columns."""
    order = [F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
    return df.orderBy(*order).limit(k)


def _same(names: Sequence[str], left: str, right: str) -> Column:
    pairs = [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names]
    return reduce(and_, pairs, F.lit(True))


def shares(df: DataFrame, by: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Group counts and their share of the total, or of the total of the ``within`` group.

    The totals are a second aggregate joined back, so a large ``within`` group is never
    sorted in one task.
    """
    counts = group_counts(df, [*within, *by])
    if not within:
        total = counts.agg(F.sum("n").alias("total")).scalar()
        return counts.withColumn("share", F.col("n") / total)
    totals = counts.groupBy(*within).agg(F.sum("n").alias("_total"))
    joined = counts.alias("c").join(totals.alias("t"), _same(within, "c", "t"))
    return joined.select("c.*", (F.col("c.n") / F.col("t._total")).alias("share"))


def category_shares(df: DataFrame, within: str, categories: Sequence[str]) -> DataFrame:
    """Share of each value of several columns within a group, NULL values left out.

    All columns share one pass: (within, attribute, value, n, share).
    """
    long = df.unpivot([within], list(categories), "attribute", "value").filter(
        F.col("value").isNotNull()
    )
    return shares(long, ["value"], [within, "attribute"])


def weekday_median(df: DataFrame, ts: str) -> DataFrame:
    """Median number of rows per day for each weekday (0 is Sunday).

    The second step sees one row per calendar day.
    """
    daily = df.groupBy(
        F.col(ts).cast("date").alias("day"), times.weekday_sunday0(F.col(ts)).alias("dow")
    ).agg(rows().alias("n"))
    return daily.groupBy("dow").agg(F.percentile("n", 0.5).alias("median_rows"))


def histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """Equal bins from the smallest to the largest value, the last one closed.

    Returns (bin, bin_start, bin_end, n) with a row for empty bins too. One value alone gets
    a range of width one around it.
    """
    known = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    lowest = known.agg(F.min("v").alias("m")).scalar()
    highest = known.agg(F.max("v").alias("m")).scalar()
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), lowest.alias("lo"), highest.alias("hi")
    ).withColumns(
        {
            "start": F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5),
            "width": F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(F.lit(1.0)),
        }
    )
    lo = F.when(highest > lowest, lowest).otherwise(lowest - 0.5)
    span = F.when(highest > lowest, highest - lowest).otherwise(F.lit(1.0))
    slot = F.least(F.floor((F.col("v") - lo) / span * bins), F.lit(bins - 1)).cast("int")
    counts = known.groupBy(slot.alias("bin")).agg(rows().alias("n"))
    return edges.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("start") + F.col("width") * F.col("bin") / bins).alias("bin_start"),
        (F.col("start") + F.col("width") * (F.col("bin") + 1) / bins).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def exact_quantiles(df: DataFrame, value: str, quantiles: Mapping[str, float],
                    by: Sequence[str] = (), task_rows: int = QUANTILE_TASK_ROWS) -> DataFrame:
    """Exact interpolated quantiles, overall or per group, NULLs left out.

    Equal values are first counted together in the map tasks. When the distinct values fit
    one task, that task picks the quantiles; otherwise they are found by rank over range
    partitions.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_value")).agg(
        rows().alias("_n")
    )
    stored = materialize(counted, "quantile-counts")
    if stored.count() <= task_rows:
        return stored.groupBy(*by).agg(
            *[F.percentile("_value", q, F.col("_n")).alias(name) for name, q in quantiles.items()]
        )
    return _ranked_quantiles(stored, quantiles, by)


def _ranked_quantiles(counted: DataFrame, quantiles: Mapping[str, float],
                      by: Sequence[str]) -> DataFrame:
    """Quantiles from value counts spread over range partitions of (group, value)."""
    ranged = materialize(
        counted.repartitionByRange(*by, "_value").withColumn("_part", F.spark_partition_id()),
        "quantile-ranges",
    )
    groups = Window.partitionBy(*by)
    earlier = groups.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(*by, "_part").agg(F.sum("_n").alias("_rows")).select(
        *by, "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(groups).alias("_total"),
    )
    inside = Window.partitionBy(*by, "_part").orderBy("_value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = (
        ranged.withColumn("_through", F.sum("_n").over(inside)).alias("r")
        .join(parts.alias("p"), _same([*by, "_part"], "r", "p"))
        .select(
            *[f"r.{name}" for name in by], "r._value", "p._total",
            (F.col("p._before") + F.col("r._through")).alias("_end"),
            (F.col("p._before") + F.col("r._through") - F.col("r._n")).alias("_start"),
        )
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_value")))

    picks = []
    for i, q in enumerate(quantiles.values()):
        rank = (F.col("_total") - 1) * F.lit(float(q))
        picks += [at(F.floor(rank)).alias(f"_lo{i}"), at(F.ceil(rank)).alias(f"_hi{i}")]
    picked = ranked.groupBy(*by).agg(F.max("_total").alias("_total"), *picks)
    results = []
    for i, (name, q) in enumerate(quantiles.items()):
        rank = (F.col("_total") - 1) * F.lit(float(q))
        low, high = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        results.append((low + (high - low) * (rank - F.floor(rank))).alias(name))
    return picked.select(*by, *results)


def approximate_quantiles(df: DataFrame, value: str, quantiles: Mapping[str, float],
                          by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Quantiles from a mergeable sketch: one pass, no extra storage, rank error 1/accuracy."""
    return df.groupBy(*by).agg(
        *[F.percentile_approx(value, q, accuracy).alias(n) for n, q in quantiles.items()]
    )
