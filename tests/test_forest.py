"""The forests of all targets, with row counts and actual averages held against SQL."""

import pytest

import __spark_entry__ as entry
from stratalake.plans import profile
from tools.check_oracle import connect


def test_rf_predict_has_all_targets_and_trees(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    trained, train = {}, profile.train_forest
    monkeypatch.setattr(profile, "train_forest", lambda *a, **k: trained.setdefault("models", train(*a, **k)))
    rows = {tuple(r[c] for c in profile.FEATURES): r for r in entry.queries()["rf_predict"](spark, sf).collect()}
    forests = {target: model.stages[-1] for target, model in trained["models"].items()}
    assert set(forests) == set(profile.TARGETS)
    assert all(f.getNumTrees == 250 and f.getMaxDepth() == 10 for f in forests.values())
    averages = ", ".join(f"avg(y_{c}), min(y_{c}), max(y_{c})" for c in profile.TARGETS)
    inner = entry.oracle_sql()["profile_features"]
    cells = connect(sf).execute(f"SELECT {', '.join(profile.FEATURES)}, count(*), {averages} FROM ({inner}) GROUP BY 1, 2, 3, 4").fetchall()
    assert len(cells) == len(rows)
    for k, target in enumerate(profile.TARGETS):
        low, high = min(c[6 + 3 * k] for c in cells), max(c[7 + 3 * k] for c in cells)
        for cell in cells:
            row = rows[cell[:4]]
            assert row.n == cell[4] and row[f"actual_{target}"] == pytest.approx(cell[5 + 3 * k])
            assert max(0, low) - 1e-6 <= row[f"pred_{target}"] <= high + 1e-6


def test_forests_grow_from_groups_of_rows(spark, monkeypatch):
    """Trees are fitted on a bounded number of weighted groups that hold every row."""
    from pyspark.ml import Pipeline
    from pyspark.sql import functions as F

    rows = spark.range(60_000).select(
        "id", (F.col("id") % 4).cast("int").alias("hour"), F.lit(1).alias("dow"), F.lit(1).alias("month"), F.lit(0).alias("is_weekend"),
        ((F.col("id") % 4) * 10 + F.col("id") % 3).cast("double").alias("response_time_sec"))
    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, frame: seen.append(frame.agg(F.count("*"), F.sum("_rows")).first()) or fit(self, frame))
    models = profile.train_forest(rows, targets=["response_time_sec"], inputs=["hour"], trees=5, depth=3)
    assert seen[0][0] <= 4 * profile.GROUPS and seen[0][1] == 60_000
    cells = rows.select(*profile.FEATURES).distinct()
    for row in profile.predict(models, cells).collect():
        assert row.pred_response_time_sec == pytest.approx(row.hour * 10 + 1, abs=0.3)
