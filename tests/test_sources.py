import hashlib

import pytest
from pyspark.sql import functions as F

from stratalake.plans.adhoc import UnsafeSql, is_safe_select, safe_sql, strip_fences
from stratalake.sources import csv, files, serving, tables
from stratalake.sources.tables import Warehouse

MESSY = (
    'Call Number,Note,Box\n'
    '1,"say ""hi"", then go",12\n'
    'None,NULL,\n'
    '3,short\n'
    '4,long,5,6,7\n'
)


@pytest.fixture
def messy(tmp_path):
    path = tmp_path / "messy calls.csv"
    path.write_text(MESSY)
    return str(path)


def test_tolerant_csv(spark, messy, rows):
    assert rows(csv.read_text(spark, messy)) == [
        ("1", 'say "hi", then go', "12"), ("3", "short", None), ("4", "long", "5"), (None, None, None)]


def test_quoted_line_breaks_need_multi_line(spark, tmp_path, rows):
    path = tmp_path / "lines.csv"
    path.write_text('a,b\n1,"x\ny"\n')
    assert rows(csv.read_text(spark, str(path), multi_line=True)) == [("1", "x\ny")]


def test_inferred_types_and_overrides(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text("n,d,flag,t,code\n1,1.5,true,2020-01-01,7\n2,2,false,x,8\n")
    found = csv.read_inferred(spark, str(path), {"code": "string"})
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "double", "boolean", "string", "string"]


def test_late_misfits_and_leading_zeros_stay_text(spark, tmp_path, rows):
    path = tmp_path / "late.csv"
    path.write_text("n,code,z\n" + "1,7,0\n" * 12_000 + "x,08,0.5\n")
    found = csv.read_inferred(spark, str(path))
    assert [f.dataType.simpleString() for f in found.schema] == ["string", "string", "double"]
    assert found.where("n = 'x' AND code = '08'").count() == 1
    assert rows(csv.read_inferred(spark, str(path), {"n": "bigint"}).where("n IS NULL"), "code") == [("08",)]


def test_header_table(spark, messy, rows):
    assert rows(csv.header_table(spark, messy)) == [
        (0, "Call Number", "call_number"), (1, "Note", "note"), (2, "Box", "box")]


def test_csv_keeps_spaces(spark, tmp_path, rows):
    df = spark.createDataFrame([(" a ", 'q"q,'), ("", None)], "x string, y string")
    csv.write(df, str(tmp_path / "out"))
    assert rows(csv.read_text(spark, str(tmp_path / "out"))) == [(" a ", 'q"q,'), (None, None)]


def test_listing_and_fingerprint(spark, tmp_path, messy, rows):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.csv").write_text("a\n1\n")
    (tmp_path / "ignored.txt").write_text("a\n")
    (tmp_path / "100%+x.csv").write_text("a\n1\n")
    listed = files.list_drop(spark, str(tmp_path))
    assert rows(listed, "file_name") == [("100%+x.csv",), ("messy calls.csv",)]
    found = {r.file_name: r for r in files.fingerprint(listed).collect()}
    mine = found["messy calls.csv"]
    assert mine.file_sha256 == hashlib.sha256(MESSY.encode()).hexdigest()
    assert mine.header == ["Call Number", "Note", "Box"]
    assert mine.file_size_bytes == len(MESSY) and mine.error_message is None


def test_missing_drop_is_empty(spark, tmp_path):
    assert files.list_drop(spark, str(tmp_path / "nowhere")).count() == 0


def test_unreadable_file_is_reported(spark, tmp_path, messy):
    listed = files.list_drop(spark, str(tmp_path))
    ghost = listed.withColumn("file_path", F.lit("file:/nowhere/ghost.csv"))
    found = files.fingerprint(listed.unionByName(ghost)).collect()
    bad = next(r for r in found if r.error_message)
    assert bad.file_sha256 == "" and "ghost" in bad.error_message
    assert sum(r.error_message is None for r in found) == 1


def test_warehouse_versions(spark, tmp_path, rows):
    store = Warehouse(spark, str(tmp_path / "w"))
    assert not store.exists("gold.t") and store.read_optional("gold.t") is None
    assert store.write("gold.t", spark.range(3)) == 3
    # A table may be rebuilt from itself.
    assert store.write("gold.t", store.read("gold.t").filter("id > 0")) == 2
    staged = store.stage("gold.u", spark.range(5))
    assert not store.exists("gold.u")
    store.publish(staged, store.stage("silver.t", spark.range(1)))
    assert rows(store.tables()) == [("gold", "t", 2), ("gold", "u", 5), ("silver", "t", 1)]
    assert store.find("t") == "gold.t" and store.find("t", prefer="silver") == "silver.t"
    assert store.find("none") is None
    assert rows(store.columns("gold.t")) == [(0, "id", "bigint")]
    first, second = store.read("gold.t", "gold.u")
    assert (first.count(), second.count()) == (2, 5)
    with pytest.raises(LookupError, match="gold.x"):
        store.read("gold.x")


def test_serving_export(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"))
    store.write("gold.dim", spark.range(2).withColumn("s", F.lit("x")))
    with pytest.raises(LookupError, match="missing"):
        serving.export(store, str(tmp_path / "s"), ["dim", "absent"])
    served = serving.export(store, str(tmp_path / "s"), ["dim"])
    assert serving.read_serving(served, "dim").count() == 2
    meta = serving.read_serving(served, serving.METADATA).first()
    assert meta.source_db == store.root and meta.exported_at is not None
    assert serving.read_serving(served, "fact", required=False) is None
    with pytest.raises(LookupError):
        serving.read_serving(served, "fact")
    store.write("gold.dim", spark.range(7).withColumn("s", F.lit("x")))
    serving.export(store, str(tmp_path / "s"), ["dim"])
    assert serving.read_serving(served, "dim").count() == 7


def test_vacuum_keeps_the_newest_versions(spark, tmp_path):
    store = tables.Warehouse(spark, str(tmp_path / "w"))
    for n in range(4):
        store.write("gold.t", spark.range(n + 1))
    store.write("gold.u", spark.range(1))
    with pytest.raises(ValueError):
        store.vacuum(0)
    assert store.vacuum(2) == 2 and store.vacuum(2) == 0
    assert store.read("gold.t").count() == 4 and store.read("gold.u").count() == 1


def test_catalog_inspection(spark, rows):
    spark.range(1).selectExpr("id", "'x' AS s").createOrReplaceTempView("inspected")
    found = rows(tables.catalog_tables(spark).filter("table_name = 'inspected'"), "table_type")
    assert found == [("TEMPORARY",)]
    assert rows(tables.catalog_columns(spark, "inspected")) == [(0, "id", "bigint"), (1, "s", "string")]


def test_format_by_suffix(spark, tmp_path, messy):
    spark.range(2).write.parquet(str(tmp_path / "t.parquet"))
    assert tables.read_any(spark, str(tmp_path / "t.parquet")).columns == ["id"]
    assert tables.read_any(spark, messy).columns == ["Call Number", "Note", "Box"]


@pytest.mark.parametrize(
    "text, safe",
    [
        ("SELECT 1", True),
        ("with x as (select 1) select * from x;", True),
        ("```sql\nSELECT 1;\n```", True),
        ("SELECT 1; SELECT 2", False),
        ("DROP TABLE x", False),
        ("SELECT * FROM x WHERE a = 'update'", True),
        ("SELECT reflect('java.lang.System', 'getProperty', 'user.home')", False),
        ("SELECT * FROM x WHERE a IN (SELECT java_method('java.util.UUID', 'randomUUID'))", False),
        ("SELECT try_reflect('a', 'b')", False),
        ("SELECT * FROM parquet.`/any/path`", False),
        ("SELECT * FROM x JOIN csv.`/any/path` USING (a)", False),
        ("SELECT * FROM hidden", False),
        ("SELECT * FROM gold.x", True),
        ("SELECT * FROM range(5)", False),
        ("SELECT no_such_function(1)", False),
        ("SELECT upper(a), count(*) OVER (PARTITION BY b) FROM x GROUP BY ALL HAVING max(b) > 1 ORDER BY 1 LIMIT 3", True),
        ("INSERT INTO x SELECT 1", False),
        ("SET a = b", False),
        ("WITH x AS (DELETE FROM y) SELECT 1", False),
        ("SELECT updated FROM x", True),
        ("(SELECT 1)", True),
        ("", False),
    ],
)
def test_safe_select(spark, text, safe):
    assert is_safe_select(spark, text, ["x"]) is safe


def test_safe_sql(spark):
    spark.range(5).createOrReplaceTempView("fact_small")
    assert safe_sql(spark, "SELECT count(*) AS n FROM gold.fact_small").first().n == 5
    assert safe_sql(spark, "SELECT * FROM fact_small", limit=2).count() == 2
    assert safe_sql(spark, "SELECT 'gold.fact_small' AS a, 1 AS `gold.b` -- gold.c\n FROM GOLD.fact_small").first().a == "gold.fact_small"
    assert strip_fences("```SQL\nselect 1\n```") == "select 1"
    with pytest.raises(UnsafeSql):
        safe_sql(spark, "DELETE FROM fact_small")
