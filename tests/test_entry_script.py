import shutil

import run_pipeline
from stratalake.plans.pipeline import Pipeline
from test_pipeline import drop  # noqa: F401


def test_modes(spark, drop, tmp_path):  # noqa: F811
    warehouse, served = str(tmp_path / "w"), str(tmp_path / "served")
    found = run_pipeline.main(["incremental", warehouse, str(drop), "--export", served], spark)
    assert found["pending"] > 0 and not found["skipped_downstream"]
    assert run_pipeline.main(["incremental", warehouse, str(drop)], spark)["pending"] == 0
    run_pipeline.main(["stream", warehouse, str(drop), str(tmp_path / "state")], spark)
    assert Pipeline(spark, warehouse).warehouse.read("gold.fact_incident").count() > 0
    shutil.rmtree(served)
    assert run_pipeline.main(["export", warehouse, served], spark) == {}
    assert (tmp_path / "served").exists()
