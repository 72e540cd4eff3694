"""Names that a common table expression defines elsewhere do not open tables of the catalog."""

import pytest

from stratalake.plans.adhoc import UnsafeSql, is_safe_select, safe_sql


@pytest.fixture
def hidden(spark, tmp_path):
    spark.range(7).write.option("path", str(tmp_path / "hidden")).saveAsTable("hidden_t")
    spark.range(5).selectExpr("id", "id % 2 AS year").createOrReplaceTempView("fact_small")
    yield
    spark.sql("DROP TABLE hidden_t")


@pytest.mark.parametrize("text", [
    "SELECT count(*) FROM hidden_t WHERE EXISTS (WITH hidden_t AS (SELECT 1 a) SELECT * FROM hidden_t)",
    "WITH a AS (WITH hidden_t AS (SELECT 1 x) SELECT * FROM hidden_t) SELECT * FROM a, hidden_t",
    "SELECT (WITH hidden_t AS (SELECT 1 a) SELECT max(a) FROM hidden_t), h.id FROM hidden_t h",
    "SELECT * FROM fact_small WHERE id IN (SELECT id FROM hidden_t) OR id IN (WITH hidden_t AS (SELECT 1 id) SELECT id FROM hidden_t)",
    "SELECT * FROM default.hidden_t", "SELECT * FROM gold.hidden_t",
])
def test_scopes_are_resolved(spark, hidden, text):
    assert not is_safe_select(spark, text)
    with pytest.raises(UnsafeSql):
        safe_sql(spark, text)


@pytest.mark.parametrize("text, rows", [
    ("WITH hidden_t AS (SELECT 1 AS id) SELECT count(*) FROM hidden_t", 1),
    ("WITH a AS (SELECT * FROM fact_small), b AS (SELECT a.id FROM a JOIN gold.fact_small f USING (id)) SELECT count(*) FROM b", 5),
    ("SELECT count(gold.year) FROM gold.fact_small AS gold", 5),
    ("SELECT count(*) FROM fact_small WHERE id > (SELECT avg(id) FROM gold.`fact_small`)", 2),
])
def test_registered_views_in_any_scope(spark, hidden, text, rows):
    assert is_safe_select(spark, text) and safe_sql(spark, text).first()[0] == rows


def test_catalog_views_are_refused(spark, hidden):
    spark.sql("CREATE OR REPLACE VIEW hidden_v AS SELECT * FROM hidden_t")
    try:
        assert not is_safe_select(spark, "SELECT * FROM hidden_v")
        assert not is_safe_select(spark, "SELECT * FROM hidden_v", ["hidden_v"])
    finally:
        spark.sql("DROP VIEW hidden_v")
