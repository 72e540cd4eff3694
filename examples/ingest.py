"""File round trips and whole pipelines on the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examples.mapping import (GATED_CALLS, GATED_INCIDENTS, Query, spark_expressions, gold_cte, incidents, raw_calls,
                              star_store, table)
from stratalake.functions import casts, times
from stratalake.operators import aggregates as agg
from stratalake.plans import bronze, kpi
from stratalake.plans.adhoc import safe_sql
from stratalake.plans.pipeline import DIMENSIONS, Pipeline
from stratalake.session import scratch_path, small_frame
from stratalake.sources import csv, lake, serving
from stratalake.streaming.dropzone import ingest_new_files

# Raw header names of the two datasets, by silver column.
CALL_HEADER = {
    "call_number": "Call Number", "incident_number": "Incident Number", "call_type": "Call Type",
    "call_type_group": "Call Type Group", "final_priority": "Final Priority", "call_date": "Call Date",
    "received_ts": "Received DtTm", "dispatch_ts": "Dispatch DtTm", "response_ts": "Response DtTm",
    "on_scene_ts": "On Scene DtTm", "address": "Address", "city": "City",
    "zipcode_of_incident": "Zipcode of Incident", "battalion": "Battalion",
    "station_area": "Station Area", "box": "Box", "supervisor_district": "Supervisor District",
    "neighborhoods_analysis_boundaries": "Neighborhooods - Analysis Boundaries",
    "location": "Location", "number_of_alarms": "Number of Alarms", "unit_type": "Unit Type",
    "fire_prevention_district": "Fire Prevention District", "rowid": "RowID",
}
INCIDENT_HEADER = {
    "incident_number": "IncidentNumber", "call_number": "CallNumber", "incident_date": "IncidentDate",
    "alarm_ts": "AlarmDtTm", "close_ts": "CloseDtTm", "address": "Address", "city": "City",
    "zipcode": "Zipcode", "battalion": "Battalion", "station_area": "StationArea", "box": "Box",
    "supervisor_district": "SupervisorDistrict", "neighborhood_district": "NeighborhoodDistrict",
    "location": "Location", "number_of_alarms": "NumberofAlarms",
    "suppression_units": "SuppressionUnits", "suppression_personnel": "SuppressionPersonnel",
    "ems_units": "EMSUnits", "ems_personnel": "EMSPersonnel", "other_units": "OtherUnits",
    "other_personnel": "OtherPersonnel", "estimated_property_loss": "EstimatedPropertyLoss",
    "estimated_contents_loss": "EstimatedContentsLoss", "fire_fatalities": "FireFatalities",
    "fire_injuries": "FireInjuries", "civilian_fatalities": "CivilianFatalities",
    "civilian_injuries": "CivilianInjuries", "primary_situation": "PrimarySituation",
}


def as_raw_text(df: DataFrame, header: dict[str, str]) -> DataFrame:
    """Columns under their raw names, times and dates in the raw text format."""
    kinds = {field.name: field.dataType.simpleString() for field in df.schema}
    writers = {"timestamp_ntz": times.raw_timestamp_text, "date": times.raw_date_text}
    plain = lambda column: column.cast("string")
    return df.select(
        [writers.get(kinds[c], plain)(F.col(c)).alias(raw) for c, raw in header.items()]
    )


def raw_call_text(spark: SparkSession, sf: str) -> DataFrame:
    return as_raw_text(raw_calls(spark, sf, GATED_CALLS), CALL_HEADER)


def raw_incident_text(spark: SparkSession, sf: str) -> DataFrame:
    return as_raw_text(incidents(spark, sf, GATED_INCIDENTS), INCIDENT_HEADER)


def _orders_text(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderkey").alias("IncidentNumber"),
        F.when(F.col("o_custkey") % 5 == 0, F.lit("None")).otherwise(F.col("o_orderstatus")).alias("Order Status"),
        times.raw_timestamp_text(F.col("o_orderdate")).alias("AlarmDtTm"),
        F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", then go')).alias("Note"),
        F.col("o_totalprice").alias("Loss"),
    )


def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    csv.write(_orders_text(spark, sf), path)
    text = csv.read_text(spark, path)
    return text.select(
        casts.to_long(F.col("IncidentNumber")).alias("incident_number"),
        F.col("`Order Status`").alias("status"),
        times.parse_timestamp(F.col("AlarmDtTm")).alias("alarm_ts"),
        F.col("Note").alias("note"),
    )


def csv_inferred(spark, sf):
    path = scratch_path(spark, "csv")
    csv.write(_orders_text(spark, sf), path)
    found = csv.read_inferred(spark, path, {"Order Status": "string"})
    return found.groupBy("`Order Status`").agg(
        agg.rows().alias("n"), F.min("IncidentNumber").alias("first_key"),
        F.round(F.sum("Loss"), 1).alias("loss"),
    ).withColumnRenamed("Order Status", "status")


def csv_multiline(spark, sf):
    """Whole documents with line breaks through CSV files, with default options."""
    path = scratch_path(spark, "csv")
    csv.write(table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    text = csv.read_text(spark, path)
    return text.select(casts.to_long(F.col("doc_id")).alias("doc_id"), F.length("text").cast("long").alias("n_text"), "source")


def csv_mixed_headers(spark, sf):
    """Files with other column orders in one folder, one without a column."""
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    folder = scratch_path(spark, "csv")
    for part, columns in enumerate((("nation", "name", "region"), ("region", "name", "nation"))):
        csv.write(nation.where(F.col("nation") % 2 == part).select(*columns), f"{folder}-{part}")
        copy_files(spark, f"{folder}-{part}", f"{part}-", folder)
    return csv.read_text(spark, folder).select(
        F.col("nation").cast("int").alias("nation"), "name", F.col("region").cast("int").alias("region"))


def csv_late_misfit(spark, sf):
    """Codes with a leading zero and one late misfit keep their text."""
    orders = table(spark, sf, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    box = F.when(F.col("o_orderkey") == last, F.lit("AI02")).otherwise(F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0"))
    path = scratch_path(spark, "csv")
    csv.write(orders.orderBy("o_orderkey").select(box.alias("box"), F.col("o_orderkey").alias("key")), path)
    return csv.read_inferred(spark, path).groupBy("box").agg(agg.rows().alias("n"), F.sum("key").alias("keys"))


def _drop_orders(spark, sf, label="drop"):
    path = scratch_path(spark, label)
    csv.write(_orders_text(spark, sf).repartition(4, "IncidentNumber"), path)
    return path


def _order_rows(frame: DataFrame) -> DataFrame:
    return frame.select(
        casts.to_long(F.col("incident_number")).alias("incident_number"),
        F.col("order_status").alias("status"),
        times.parse_timestamp(F.col("alarm_dt_tm")).alias("alarm_ts"),
    )


def lake_roundtrip(spark, sf):
    """Land the orders as files and read them back; each file is numbered from 0."""
    pipe = Pipeline(spark, scratch_path(spark, "lake"))
    run = pipe.ledger.start_run(pipe.name)
    pipe.ledger.detect(run, pipe.name, _drop_orders(spark, sf))
    bronze.land_pending(spark, pipe.ledger, pipe.lake_root, run, pipe.name)
    landed = [row["file_sha256"] for row in pipe.ledger.landed().collect()]
    rows = lake.read_landed(
        spark, pipe.lake_root, "incidents",
        ["incident_number", "order_status", "alarm_dt_tm", "note", "loss"], landed,
    )
    per_file = rows.groupBy("sha256").agg(
        agg.rows().alias("n"), F.min("row_number").alias("lowest"), F.max("row_number").alias("highest"),
        F.countDistinct("row_number").alias("numbers"),
        F.sum(casts.to_long(F.col("incident_number"))).alias("key_sum"),
    )
    return per_file.agg(
        F.sum("n").alias("rows"), F.sum("key_sum").alias("key_sum"), F.max("lowest").alias("lowest"),
        agg.count_where((F.col("numbers") != F.col("n")) | (F.col("highest") != F.col("n") - 1)).alias("gaps"),
    )


def bronze_twice(spark, sf):
    """Ingest the same drop twice before success is recorded; the second run adds nothing."""
    pipe = Pipeline(spark, scratch_path(spark, "bronze"))
    drop = _drop_orders(spark, sf)
    for _ in range(2):
        run = pipe.ledger.start_run(pipe.name)
        pipe.ledger.detect(run, pipe.name, drop)
        bronze.land_pending(spark, pipe.ledger, pipe.lake_root, run, pipe.name)
        bronze.ingest_pending(spark, pipe.ledger, pipe.bronze, pipe.lake_root, run, pipe.name)
    return _order_rows(pipe.bronze.read("incidents"))


def bronze_insert_counts(spark, sf):
    """What each of two ingests of one drop adds to bronze, and what bronze then holds of it."""
    pipe = Pipeline(spark, scratch_path(spark, "bronze"))
    drop, found = _drop_orders(spark, sf), []
    for turn in range(2):
        run = pipe.ledger.start_run(pipe.name)
        pipe.ledger.detect(run, pipe.name, drop)
        bronze.land_pending(spark, pipe.ledger, pipe.lake_root, run, pipe.name)
        counts = bronze.ingest_pending(spark, pipe.ledger, pipe.bronze, pipe.lake_root, run, pipe.name)
        found.append((turn, counts["inserted_incidents"], counts["rows_held"]))
    return small_frame(spark, found, "turn int, inserted bigint, held bigint")


def ledger_lake_paths(spark, sf):
    """Files of one drop, half of them equal bytes under a second name: each has the one stored folder of its content."""
    pipe = Pipeline(spark, scratch_path(spark, "lake"))
    drop = _drop_orders(spark, sf)
    copy_files(spark, drop, "a-call-of-")
    run = pipe.ledger.start_run(pipe.name)
    pipe.ledger.detect(run, pipe.name, drop)
    bronze.land_pending(spark, pipe.ledger, pipe.lake_root, run, pipe.name)
    paths = [r["lake_path"] for r in pipe.ledger.log().select("lake_path").distinct().collect()]
    rows = spark.read.option("basePath", pipe.lake_root).parquet(*paths).count()
    return pipe.ledger.log().groupBy("file_sha256").agg(
        agg.rows().alias("files"), F.countDistinct("lake_path").alias("paths")).agg(
            (F.max("files") - F.min("files")).alias("uneven"), F.max("paths").alias("paths")).withColumn("rows", F.lit(rows).cast("long"))


def copy_files(spark, folder: str, prefix: str, to: str | None = None, move: bool = False) -> None:
    """Copy, or move, the CSV files of a folder under other names."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    target = hadoop.Path(to or folder)
    store = target.getFileSystem(conf)
    store.mkdirs(target)
    for status in store.listStatus(hadoop.Path(folder)):
        name = status.getPath().getName()
        if name.endswith((".csv", ".csv.gz")):
            hadoop.FileUtil.copy(store, status.getPath(), store, hadoop.Path(target, prefix + name), move, conf)


def stream_drop(spark, sf):
    """Stream the drop in twice, with a renamed copy of it before the second time."""
    pipe = Pipeline(spark, scratch_path(spark, "stream"))
    drop, state = _drop_orders(spark, sf), scratch_path(spark, "stream-state")
    ingest_new_files(pipe, drop, state)
    copy_files(spark, drop, "again-")
    ingest_new_files(pipe, drop, state)
    return _order_rows(pipe.bronze.read("incidents"))


def stream_to_gold(spark, sf):
    """Calls and incidents stream in one after the other; then a run over the same drop finds nothing new."""
    pipe = Pipeline(spark, scratch_path(spark, "stream"))
    drop, state = scratch_path(spark, "drop"), scratch_path(spark, "stream-state")
    for part, text in (("calls", raw_call_text(spark, sf)), ("incidents", raw_incident_text(spark, sf))):
        csv.write(text, f"{drop}-{part}", compressed=True)
        copy_files(spark, f"{drop}-{part}", f"{part}-", drop, move=True)
        ingest_new_files(pipe, drop, state)
    if pipe.run_incremental(drop)["pending"]:
        raise RuntimeError("the stream left contents pending")
    return _monthly(*pipe.warehouse.read("gold.fact_incident", "gold.dim_date"))


def _drop_calls_and_incidents(spark, sf):
    path = scratch_path(spark, "drop")
    csv.write(raw_call_text(spark, sf), f"{path}/calls", compressed=True)
    csv.write(raw_incident_text(spark, sf), f"{path}/incidents", compressed=True)
    return path


def _monthly(fact: DataFrame, dates: DataFrame) -> DataFrame:
    rows = kpi.with_dates(fact, dates)
    return rows.groupBy("year", "month").agg(
        agg.rows().alias("n"), F.round(F.avg("response_time_sec"), 6).alias("avg_resp"),
        F.sum("incident_duration_sec").alias("duration"), F.sum("estimated_property_loss").alias("loss"),
    )


def pipeline_incremental(spark, sf):
    """Raw files to gold in two runs: calls and incidents arrive, then the same again."""
    pipe = Pipeline(spark, scratch_path(spark, "pipeline"))
    drop = f"{_drop_calls_and_incidents(spark, sf)}/*"
    pipe.run_incremental(drop)
    pipe.run_incremental(drop)
    return _monthly(*pipe.warehouse.read("gold.fact_incident", "gold.dim_date"))


def pipeline_full(spark, sf):
    pipe = Pipeline(spark, scratch_path(spark, "pipeline"))
    drop = _drop_calls_and_incidents(spark, sf)
    pipe.run_full(f"{drop}/calls", f"{drop}/incidents")
    return _monthly(*pipe.warehouse.read("gold.fact_incident", "gold.dim_date"))


#: Second drop of ``pipeline_two_drops``: later versions of some rows of the first, moved by a day.
_LATE_CALLS, _LATE_ORDERS = "l_orderkey % 40 = 0", "o_orderkey % 30 = 0"


def _two_drops(spark, sf) -> str:
    """Two folders of files: the rows up to a key, then the others and later versions of some calls and incidents."""
    def text(rows, expressions, header):
        return as_raw_text(rows.selectExpr(*expressions), header)

    def moved(rows, column):
        return rows.withColumn(column, F.col(column) + F.expr("INTERVAL 1 DAY"))

    path = scratch_path(spark, "drop")
    for name, key, late, day, expressions, header in (
        ("calls", "l_orderkey", _LATE_CALLS, "l_shipdate", spark_expressions(GATED_CALLS), CALL_HEADER),
        ("incidents", "o_orderkey", _LATE_ORDERS, "o_orderdate", spark_expressions(GATED_INCIDENTS), INCIDENT_HEADER),
    ):
        rows = table(spark, sf, "lineitem" if name == "calls" else "orders")
        cut = rows.agg((F.max(key) * F.lit(0.7)).cast("long")).first()[0] or 0
        early, rest = rows.where(F.col(key) <= cut), rows.where(F.col(key) > cut)
        csv.write(text(early, expressions, header), f"{path}/1/{name}", compressed=True)
        csv.write(text(rest.union(moved(early.where(late), day)), expressions, header), f"{path}/2/{name}", compressed=True)
    return path


def pipeline_two_drops(spark, sf):
    """A second drop with new rows and late versions of old ones changes the parts it touches; ids follow the call number."""
    pipe = Pipeline(spark, scratch_path(spark, "pipeline"), part_keys=50_000)
    drop = _two_drops(spark, sf)
    pipe.run_incremental(f"{drop}/1/*")
    pipe.run_incremental(f"{drop}/2/*")
    fact, dates = pipe.warehouse.read("gold.fact_incident", "gold.dim_date")
    volume, response = pipe.warehouse.read("gold.v_kpi_incident_volume_month", "gold.v_kpi_response_time_month")
    numbered = kpi.with_dates(fact, dates).groupBy("year", "month").agg(
        F.sum(F.col("incident_id") * F.pmod(F.col("call_number"), F.lit(97))).alias("id_sum"),
        F.sum("incident_duration_sec").alias("duration"), F.sum("estimated_property_loss").alias("loss"))
    rounded = response.select("year", "month", F.round("avg_response_time_sec", 6).alias("avg_resp"), "n_incidents")
    return numbered.join(volume, ["year", "month"]).join(rounded, ["year", "month"], "left")


def export_read(spark, sf):
    """Serve the key figures from the exported copy."""
    store = star_store(spark, sf)
    if store.find("v_kpi_incident_volume_month") is None:
        figures = kpi.kpi_tables(
            *store.read("gold.fact_incident", "gold.dim_date", "gold.dim_incident_type"))
        store.publish(*[store.stage(f"gold.{name}", frame) for name, frame in figures.items()])
    served = serving.export(store, scratch_path(spark, "served"), [*kpi.KPI_TABLES, *DIMENSIONS])
    return serving.read_serving(served, "v_kpi_incident_volume_month")


def adhoc_select(spark, sf):
    star_store(spark, sf).register_views("gold")
    return safe_sql(spark, """```sql
        SELECT d.year, count(*) AS n, sum(f.estimated_property_loss) AS loss
        FROM gold.fact_incident f JOIN gold.dim_date d ON d.date_id = f.date_id
        GROUP BY d.year;
        ```""")


def warehouse_tables(spark, sf):
    return star_store(spark, sf).tables().filter(~F.col("table_name").startswith("v_kpi"))


_ORDERS_SQL = """
SELECT o_orderkey AS incident_number, CASE WHEN o_custkey % 5 <> 0 THEN o_orderstatus END AS status,
       o_orderdate AS alarm_ts FROM orders"""
_MONTHLY_SQL = f"""
WITH {gold_cte(GATED_CALLS, GATED_INCIDENTS)}
SELECT year, month, count(*) AS n, round(avg(response_time_sec), 6) AS avg_resp,
       CAST(sum(incident_duration_sec) AS BIGINT) AS duration,
       CAST(sum(estimated_property_loss) AS BIGINT) AS loss
FROM star GROUP BY year, month"""

_TWO_DROPS_SQL = f"""
WITH {gold_cte(GATED_CALLS, GATED_INCIDENTS)},
numbered AS (SELECT *, row_number() OVER (ORDER BY call_number) AS incident_id FROM star)
SELECT year, month, CAST(sum(incident_id * (call_number % 97)) AS BIGINT) AS id_sum,
       CAST(sum(incident_duration_sec) AS BIGINT) AS duration, CAST(sum(estimated_property_loss) AS BIGINT) AS loss,
       count(*) AS incident_count, round(avg(response_time_sec), 6) AS avg_resp,
       CASE WHEN count(response_time_sec) > 0 THEN count(response_time_sec) END AS n_incidents
FROM numbered GROUP BY year, month""".replace("FROM lineitem)", f"""FROM (
  SELECT * FROM lineitem UNION ALL SELECT * REPLACE (l_shipdate + INTERVAL 1 DAY AS l_shipdate) FROM lineitem
  WHERE {_LATE_CALLS} AND l_orderkey <= (SELECT CAST(floor(max(l_orderkey) * 0.7) AS BIGINT) FROM lineitem)) AS lineitem)""").replace(
    "FROM orders)", f"""FROM (
  SELECT * FROM orders UNION ALL SELECT * REPLACE (o_orderdate + INTERVAL 1 DAY AS o_orderdate) FROM orders
  WHERE {_LATE_ORDERS} AND o_orderkey <= (SELECT CAST(floor(max(o_orderkey) * 0.7) AS BIGINT) FROM orders)) AS orders
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) = 1)""")

QUERIES = {
    "csv_roundtrip": Query(csv_roundtrip, """
SELECT o_orderkey AS incident_number, CASE WHEN o_custkey % 5 <> 0 THEN o_orderstatus END AS status,
       o_orderdate AS alarm_ts, 'say "' || o_orderpriority || '", then go' AS note FROM orders"""),
    "csv_inferred": Query(csv_inferred, """
SELECT CASE WHEN o_custkey % 5 <> 0 THEN o_orderstatus END AS status, count(*) AS n,
       min(o_orderkey) AS first_key, round(sum(o_totalprice), 1) AS loss FROM orders GROUP BY 1"""),
    "lake_roundtrip": Query(lake_roundtrip, """
SELECT count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(0 AS BIGINT) AS lowest,
       CAST(0 AS BIGINT) AS gaps FROM orders"""),
    "bronze_twice": Query(bronze_twice, _ORDERS_SQL),
    "stream_drop": Query(stream_drop, _ORDERS_SQL),
    "stream_to_gold": Query(stream_to_gold, _MONTHLY_SQL),
    "bronze_insert_counts": Query(bronze_insert_counts, """
SELECT CAST(0 AS INTEGER) AS turn, count(*) AS inserted, count(*) AS held FROM orders
UNION ALL SELECT CAST(1 AS INTEGER), CAST(0 AS BIGINT), count(*) FROM orders"""),
    "ledger_lake_paths": Query(ledger_lake_paths, """
SELECT CAST(0 AS BIGINT) AS uneven, CAST(1 AS BIGINT) AS paths, count(*) AS rows FROM orders"""),
    "csv_multiline": Query(csv_multiline, """
SELECT doc_id, length(text) AS n_text, source FROM documents"""),
    "csv_mixed_headers": Query(csv_mixed_headers, """
SELECT n_nationkey AS nation, n_name AS name, n_regionkey AS region FROM nation"""),
    "csv_late_misfit": Query(csv_late_misfit, """
SELECT CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'AI02' ELSE lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') END AS box,
       count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1"""),
    "pipeline_incremental": Query(pipeline_incremental, _MONTHLY_SQL),
    "pipeline_full": Query(pipeline_full, _MONTHLY_SQL),
    "pipeline_two_drops": Query(pipeline_two_drops, _TWO_DROPS_SQL),
    "export_read": Query(export_read, f"""
WITH {gold_cte()} SELECT year, month, count(*) AS incident_count FROM star GROUP BY 1, 2"""),
    "adhoc_select": Query(adhoc_select, f"""
WITH {gold_cte()} SELECT year, count(*) AS n, CAST(sum(estimated_property_loss) AS BIGINT) AS loss
FROM star GROUP BY 1"""),
    "warehouse_tables": Query(warehouse_tables, f"""
WITH {gold_cte()}
SELECT 'silver' AS layer, 'calls_clean' AS table_name, count(*) AS row_count FROM calls
UNION ALL SELECT 'silver', 'incidents_clean', count(*) FROM incidents
UNION ALL SELECT 'gold', 'dim_date', count(*) FROM dim_date
UNION ALL SELECT 'gold', 'dim_incident_type', count(*) FROM dim_incident_type
UNION ALL SELECT 'gold', 'dim_location', count(*) FROM dim_location
UNION ALL SELECT 'gold', 'fact_incident', count(*) FROM fact"""),
}
