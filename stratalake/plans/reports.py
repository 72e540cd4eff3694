"""Reports on silver calls and incidents under user filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import casts, times
from stratalake.operators import aggregates as agg
from stratalake.operators import joins, sampling, shape
from stratalake.operators.filters import date_range, in_lists

# Sizes of the top lists, of the sample and of the histogram.
TOP = 15
BINS = 60

_LOSSES = {
    "prop_loss": "estimated_property_loss",
    "cont_loss": "estimated_contents_loss",
    "fire_injuries": "fire_injuries",
    "fire_fatalities": "fire_fatalities",
    "civ_injuries": "civilian_injuries",
    "civ_fatalities": "civilian_fatalities",
}


@dataclass(frozen=True)
class CallFilter:
    """Inclusive date range and value lists; an empty list means all."""

    first: object
    last: object
    groups: Sequence[str] = ()
    cities: Sequence[str] = ()
    battalions: Sequence[str] = ()

    def apply(self, calls: DataFrame) -> DataFrame:
        lists = {"call_type_group": self.groups, "city": self.cities, "battalion": self.battalions}
        return calls.filter(date_range("call_date", self.first, self.last)).filter(in_lists(lists))


def overview(calls: DataFrame) -> DataFrame:
    """One row: total, average, exact median and 90th percentile, missing response times."""
    quantiles = agg.exact_quantiles(
        calls, "response_time_sec", {"median_response_sec": 0.5, "p90_response_sec": 0.9}
    )
    totals = calls.agg(
        agg.rows().alias("total_calls"),
        F.avg("response_time_sec").alias("avg_response_sec"),
        agg.null_count("response_time_sec").alias("null_response_time"),
    )
    return totals.withColumns(
        {name: quantiles.select(name).scalar() for name in quantiles.columns}
    )


def missing_durations(calls: DataFrame) -> DataFrame:
    return agg.null_profile(calls, ["response_time_sec", "dispatch_delay_sec", "travel_time_sec"])


def calls_by_month(calls: DataFrame) -> DataFrame:
    return calls.groupBy(times.month_start(F.col("call_date")).alias("month")).agg(
        agg.rows().alias("calls")
    )


def response_by_month(calls: DataFrame) -> DataFrame:
    return (
        calls.filter(F.col("response_time_sec").isNotNull())
        .groupBy(times.month_start(F.col("call_date")).alias("month"))
        .agg(F.avg("response_time_sec").alias("avg_resp"))
    )


def response_histogram(calls: DataFrame, chosen: CallFilter, sample: int | None = None,
                       bins: int = BINS) -> DataFrame:
    """Histogram of response times; a sample, if asked for, is drawn before the filter."""
    drawn = calls if sample is None else sampling.sample_rows(calls, sample, ["call_number"])
    return agg.histogram(chosen.apply(drawn), "response_time_sec", bins)


def top_call_types(calls: DataFrame, k: int = TOP) -> DataFrame:
    counts = agg.group_counts(calls.filter(F.col("call_type").isNotNull()), ["call_type"])
    return agg.top_k(counts, "n", ["call_type"], k)


def slowest_neighborhoods(calls: DataFrame, k: int = TOP) -> DataFrame:
    """Neighborhoods with the highest average response, those without any left out."""
    name = casts.placeholder(F.col("neighborhoods_analysis_boundaries"), "Unknown")
    averages = (
        calls.groupBy(name.alias("neighborhood"))
        .agg(F.avg("response_time_sec").alias("avg_resp"))
        .filter(F.col("avg_resp").isNotNull())
    )
    return agg.top_k(averages, "avg_resp", ["neighborhood"], k)


def incidents_of_calls(incidents: DataFrame, calls: DataFrame, chosen: CallFilter) -> DataFrame:
    """Incidents in the date range that belong to a chosen call."""
    numbers = chosen.apply(calls).select("incident_number").dropna().distinct()
    in_range = incidents.filter(date_range("incident_date", chosen.first, chosen.last))
    return joins.present(in_range, numbers, ["incident_number"])


def severity_totals(incidents: DataFrame) -> DataFrame:
    return incidents.agg(
        agg.rows().alias("total_incidents"),
        *[agg.sum_or_zero(F.col(source)).alias(name) for name, source in _LOSSES.items()],
    )


def top_situations(incidents: DataFrame, k: int = TOP) -> DataFrame:
    name = casts.placeholder(F.col("primary_situation"), "Unknown").alias("primary_situation")
    counts = incidents.groupBy(name).agg(agg.rows().alias("n"))
    return agg.top_k(counts, "n", ["primary_situation"], k)


def loss_by_month(incidents: DataFrame) -> DataFrame:
    loss = casts.placeholder(F.col("estimated_property_loss"), 0) + casts.placeholder(
        F.col("estimated_contents_loss"), 0
    )
    return incidents.groupBy(times.month_start(F.col("incident_date")).alias("month")).agg(
        F.sum(loss).alias("total_loss")
    )


@dataclass(frozen=True)
class Health:
    """What a health report looks at in one table."""

    frame: DataFrame
    null_columns: Sequence[str] = ()
    range_columns: Sequence[str] = ()
    not_negative: Sequence[str] = ()


def health(tables: Mapping[str, Health]) -> DataFrame:
    """(tbl, metric, value): row counts, NULL keys, negative measures and ranges as text.

    Each table is read once, for all of its metrics together.
    """
    parts = []
    for name, table in tables.items():
        metrics = {"rows": agg.rows()}
        metrics |= {f"null {c}": agg.null_count(c) for c in table.null_columns}
        metrics |= {f"negative {c}": agg.count_where(F.col(c) < 0) for c in table.not_negative}
        for c in table.range_columns:
            metrics |= {f"min {c}": F.min(c), f"max {c}": F.max(c)}
        one_row = table.frame.agg(*[m.cast("string").alias(label) for label, m in metrics.items()])
        parts.append(
            one_row.unpivot([], list(metrics), "metric", "value").select(
                F.lit(name).alias("tbl"), "metric", "value"
            )
        )
    return shape.union_evolving(*parts)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)
