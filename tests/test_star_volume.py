"""What the star build sends and stores: wide rows are sorted once, numbered tables are written once."""

from pathlib import Path

from pyspark.sql import functions as F

from stratalake.operators import dedup
from stratalake.plans import silver
from stratalake.session import scratch_path
from stratalake.sources.tables import Warehouse


def _calls(spark):
    return spark.range(300).select(
        (F.col("id") % 100).alias("call_number"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("received_ts"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("ingested_ts"), F.format_string("%04d", "id").alias("rowid"))


def _limits(frame):
    return str(frame._jdf.queryExecution().executedPlan().toString()).count("WindowGroupLimit")


def test_wide_rows_are_dealt_before_they_are_ranked(spark, rows, monkeypatch):
    found = silver.latest_calls(_calls(spark))
    assert _limits(found) == 1  # none in the map tasks, where it sorts whole splits
    expected = [(k, f"{k + 200:04d}") for k in range(100)]
    assert sorted(rows(found, "call_number", "rowid")) == expected
    monkeypatch.setattr(dedup, "find_hot_keys", lambda *a, **k: {1: 2})
    hot = silver.latest_calls(_calls(spark))
    assert _limits(hot) == 2  # a hot key sends one row a map task
    assert sorted(rows(hot, "call_number", "rowid")) == expected


def test_numbered_versions_store_each_row_once(spark, rows):
    store = Warehouse(spark, scratch_path(spark, "numbered"))
    names = spark.range(500).select(F.format_string("n%04d", F.lit(499) - F.col("id")).alias("name"))
    ordered = store.stage_numbered("gold.names", names, "id", ["name"], add={"size": F.length("name")})
    plain = store.stage_numbered("gold.plain", names, "id")
    store.publish(ordered, plain)
    assert ordered.rows == plain.rows == 500
    assert store.read("gold.names").columns == ["id", "size", "name"]
    assert rows(store.read("gold.names"), "id", "name") == rows(
        spark.range(500).select((F.col("id") + 1).alias("id"), F.format_string("n%04d", "id").alias("name")))
    assert sorted(r.id for r in store.read("gold.plain").collect()) == list(range(1, 501))


def test_a_run_leaves_no_intermediate_tables(spark, tmp_path):
    """Bronze, silver and gold stay; copies made on the way go, and moved files leave nothing behind."""
    from examples import ingest
    from stratalake.plans.pipeline import Pipeline
    from stratalake.session import _own_scratch

    def scratch():
        found = {p.name for p in Path(_own_scratch(spark)).glob("*")}
        return {name for name in found if name.split("-")[0] in ("changes", "members", "matched", "csv")}

    before = scratch()
    drop = ingest._drop_calls_and_incidents(spark, "/root/testdata/sf0.001")
    pipe = Pipeline(spark, str(tmp_path / "pipe"))
    pipe.run_incremental(f"{drop}/*")
    assert scratch() == before
    ingest.copy_files(spark, f"{drop}/calls", "moved-", str(tmp_path / "to"), move=True)
    assert not list(Path(drop, "calls").glob("*.csv")) and list((tmp_path / "to").glob("moved-*.csv"))


def test_narrow_rows_give_the_winners_of_spelled_out_calls(spark, rows, tmp_path):
    """Rows without a key rank alike; the same one is kept whether calls are spelled out before or after."""
    from examples import mapping

    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(400)
    keyless = lines.withColumns({"l_orderkey": F.lit(None).cast("bigint"), "l_partkey": F.lit(None).cast(lines.schema["l_partkey"].dataType)})
    lines.unionByName(keyless).write.parquet(str(tmp_path / "lineitem.parquet"))
    spelled = silver.with_durations(silver.latest_calls(mapping.raw_calls(spark, str(tmp_path))))
    assert rows(mapping.calls(spark, str(tmp_path))) == rows(spelled)
