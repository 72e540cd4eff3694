"""Key figures on the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators import aggregates as agg
from stratalake.operators import joins
from stratalake.operators.filters import equals

KPI_TABLES = (
    "v_kpi_incident_volume_month", "v_kpi_response_time_month", "v_kpi_top_incident_type",
)


def with_dates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return joins.lookup(fact, dates, ["date_id"], ["incident_id"], how="inner")


def with_types(fact: DataFrame, types: DataFrame) -> DataFrame:
    # The fact has a priority of its own, so the dimension's is left out.
    return joins.lookup(
        fact, types.drop("final_priority"), ["incident_type_id"], ["incident_id"], how="inner"
    )


def with_locations(fact: DataFrame, locations: DataFrame) -> DataFrame:
    return joins.lookup(fact, locations, ["location_id"], ["incident_id"], how="inner")


def star(fact: DataFrame, dates: DataFrame, types: DataFrame, locations: DataFrame) -> DataFrame:
    """Facts with the columns of all three dimensions."""
    return with_locations(with_types(with_dates(fact, dates), types), locations)


def volume_by_month(rows: DataFrame) -> DataFrame:
    return agg.group_counts(rows, ["year", "month"], "incident_count")


def response_by_month(rows: DataFrame) -> DataFrame:
    """Average response and the number of rows that have one."""
    return (
        rows.filter(F.col("response_time_sec").isNotNull())
        .groupBy("year", "month")
        .agg(F.avg("response_time_sec").alias("avg_response_time_sec"), agg.rows().alias("n_incidents"))
    )


def by_type(rows: DataFrame) -> DataFrame:
    return rows.groupBy("call_type_group", "call_type").agg(
        agg.rows().alias("incident_count"),
        F.avg("response_time_sec").alias("avg_response_time_sec"),
    )


def average_by(rows: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count and average of some measures, overall or per group.

    Covers alarms by type, personnel by type, and response by neighborhood, battalion or
    station area.
    """
    return rows.groupBy(*by).agg(
        agg.rows().alias("n_incidents"), *[F.avg(m).alias(f"avg_{m}") for m in measures]
    )


def average_by_each(rows: DataFrame, measures: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(field, name, row count, averages) for every value of several columns, in one scan."""
    long = rows.select(*columns, *measures).unpivot(list(measures), list(columns), "field", "name")
    return average_by(long, measures, ["field", "name"])


def kpi_tables(fact: DataFrame, dates: DataFrame, types: DataFrame) -> dict[str, DataFrame]:
    """The three monthly and type figures by table name."""
    return {
        "v_kpi_response_time_month": response_by_month(with_dates(fact, dates)),
        "v_kpi_incident_volume_month": volume_by_month(with_dates(fact, dates)),
        "v_kpi_top_incident_type": by_type(with_types(fact, types)),
    }


def date_id_range(year: int, month: int | None = None) -> tuple[int, int]:
    """First and last possible YYYYMMDD key of a year or a month."""
    first, last = (month, month) if month else (1, 12)
    return year * 10000 + first * 100 + 1, year * 10000 + last * 100 + 31


def select_facts(rows: DataFrame, year: int | None = None, month: int | None = None,
                 call_type_group: str | None = None, neighborhood: str | None = None) -> DataFrame:
    """Facts of the chosen year, month, group and neighborhood; None means all.

    A chosen year also bounds the date key, which the fact scan can use to skip row groups.
    """
    if year is not None:
        rows = rows.filter(F.col("date_id").between(*date_id_range(year, month)))
    return rows.filter(
        equals(
            {
                "year": year, "month": month,
                "call_type_group": call_type_group, "neighborhood": neighborhood,
            }
        )
    )


def summary(rows: DataFrame) -> DataFrame:
    """One row: total, three averages, exact 90th percentile of the response time."""
    averages = rows.agg(
        agg.rows().alias("total_incidents"),
        *[
            agg.average_where(F.col(c), F.col(c).isNotNull()).alias(name)
            for c, name in (
                ("response_time_sec", "avg_resp"),
                ("dispatch_delay_sec", "avg_dispatch"),
                ("travel_time_sec", "avg_travel"),
            )
        ],
    )
    return averages.withColumn(
        "p90_resp", agg.exact_quantiles(rows, "response_time_sec", {"p90_resp": 0.9}).scalar()
    )


def top_types(rows: DataFrame, k: int = 15) -> DataFrame:
    """Most frequent types with a display label."""
    from stratalake.functions.times import joined_label

    counts = agg.group_counts(rows, ["call_type_group", "call_type"], "incident_count")
    top = agg.top_k(counts, "incident_count", ["call_type_group", "call_type"], k)
    return top.withColumn("label", joined_label(F.col("call_type_group"), F.col("call_type")))


def filter_options(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, value): the distinct filled values of some columns as text."""
    values = rows.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        values.unpivot([], list(columns), "field", "value")
        .filter(F.col("value").isNotNull() & (F.trim("value") != ""))
        .distinct()
    )
