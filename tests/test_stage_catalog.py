"""Stages found again after a failed run, and removed after a good one."""

import pytest

from tests.tables import SCHEMAS
from tests.test_profit_golden import AS_OF, ROWS, _rows
from tillroll.plans import profit_job as PJ
from tillroll.plans.stage_catalog import StageCatalog, StageOwnerLost
from tillroll.sources import load_tables


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    for name, ddl in SCHEMAS.items():
        spark.createDataFrame(ROWS.get(name, []), ddl).coalesce(1).write.parquet(f"{base}/{name}")
    return base


def test_a_killed_run_resumes_and_leaves_nothing(spark, folder):
    tables = load_tables(spark, folder)
    dead = StageCatalog(spark, "profit", tables, as_of=AS_OF).__enter__()  # and its driver is gone after these stages
    half = PJ.run_profit(tables, AS_OF, stage=dead.stage)
    half.store_sales.collect()
    assert {"line", "recent", "first-po", "by_code", "feed-sales"} <= set(dead.written) and not dead.found

    with StageCatalog(spark, "profit", load_tables(spark, folder), as_of=AS_OF) as stages:
        assert stages.root == dead.root
        report = _rows(PJ.run_profit(tables, AS_OF, stage=stages.stage).report)
        assert set(stages.found) == set(dead.written) and not set(stages.written) & set(dead.written)
        assert {"items", "flipped", "feed-open-orders"} <= set(stages.written)
        with pytest.raises(StageOwnerLost):  # the old run, were it alive after all
            dead.stage(tables["vendor_master"], "late")
    assert not stages._fs.exists(stages._path(""))
    with pytest.raises(StageOwnerLost):
        dead.stage(tables["vendor_master"], "later")
    assert report == _rows(PJ.run_profit(tables, AS_OF).report)


def test_other_parameters_or_files_are_other_stages(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    one = StageCatalog(spark, "job", {"t": spark.read.parquet(path)}, as_of="2025-01-25")
    assert StageCatalog(spark, "job", {"t": spark.read.parquet(path)}, as_of="2025-01-25").root == one.root
    assert StageCatalog(spark, "job", {"t": spark.read.parquet(path)}, as_of="2025-01-26").root != one.root
    spark.range(1).write.mode("append").parquet(path)
    assert StageCatalog(spark, "job", {"t": spark.read.parquet(path)}, as_of="2025-01-25").root != one.root


def test_a_failed_run_keeps_its_finished_stages_and_rewrites_broken_ones(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    with pytest.raises(Exception, match="boom"), StageCatalog(spark, "broken", {"t": t}) as stages:
        assert stages.stage(t, "good")[1] == 3
        stages.stage(t.selectExpr("id", "raise_error('boom') AS x"), "bad")
    with StageCatalog(spark, "broken", {"t": t}) as again:
        assert again.stage(t.limit(0), "good")[1] == 3 and again.stage(t, "bad")[1] == 3
        assert (again.found, again.written) == (["good"], ["bad"])
    assert not again._fs.exists(again._path(""))
