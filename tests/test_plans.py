"""Physical-plan checks: the scale decisions are really in the plans."""

import pytest

from checks.registry import SR_END, SR_START
from tests.tables import make_tables
from tillroll.operators import shipments as S
from tillroll.operators.items import ITEM_COLS
from tillroll.operators.sales import retail_sales_by_item
from tillroll.operators.weights import item_weights
from tillroll.plans.shipment_report import shipment_not_received
from tillroll.plans.strategy import CONF_BROADCAST_ROWS, bounded_broadcast
from tillroll.sources.normalize import with_shadows
from tillroll.sources.standins import standin_tables

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def logical_text(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_not_received_is_an_anti_join_with_pushed_scan_filters(spark):
    t = standin_tables(spark, SF)
    df = shipment_not_received(t, SR_START, SR_END, "All Locations", None, "CDC", reuse=False)
    plan = plan_text(df)
    assert "LeftAnti" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_date_range_reaches_the_parquet_scan(spark, tmp_path):
    t = standin_tables(spark, SF)
    path = str(tmp_path / "sh")
    with_shadows(t["shipment_header"], "shipment_header").write.parquet(path)
    sh = spark.read.parquet(path)
    stores = S.resolve_locations(t["locations"], t["report_locations"], "All Locations")
    df = S.shipments_in_range(sh, t["shipment_detail"], stores, SR_START, SR_END, "cdc")
    plan = plan_text(df)
    # the range (and the type test, cut off in the plan text) reach the scan
    assert "PushedFilters: [IsNotNull(DateTransferred), IsNotNull(ShipmentType_folded), GreaterThanOrEqual(DateTransferred" in plan
    assert "ReadSchema: struct<ShipmentNo_folded:string,ShipmentType_folded:string,ToLocationNo_folded:string" in plan


def test_facts_cut_by_broadcast_item_keys_before_aggregating(spark):
    t = standin_tables(spark, SF)
    items = spark.createDataFrame(
        [("T", "0000001", "R", "I", None, None, None, "S", "V", None, "", 2)],
        ", ".join(f"{c} string" for c in ITEM_COLS[:4])
        + ", Cost decimal(19,4), Price decimal(19,4), MSRP decimal(19,4), SectionCode string, VendorID string, "
        "OrgPO string, OrgBuyer string, n bigint",
    )
    w = item_weights(items, rows=1)
    plan = plan_text(retail_sales_by_item(t["sales_item_history"], t["locations"], w))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    # partial aggregation before the shuffle of the facts
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(Code20")


def test_broadcast_only_under_the_row_bound(spark):
    df = spark.range(10)
    assert "ResolvedHint (strategy=broadcast)" in logical_text(bounded_broadcast(df, limit=100)) or "broadcast" in bounded_broadcast(df, limit=100)._jdf.queryExecution().analyzed().toString().lower()
    big = bounded_broadcast(df, limit=5)
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()
    spark.conf.set(CONF_BROADCAST_ROWS, "3")
    try:
        assert "broadcast" not in bounded_broadcast(df)._jdf.queryExecution().analyzed().toString().lower()
    finally:
        spark.conf.unset(CONF_BROADCAST_ROWS)


def test_empty_inputs_run(spark):
    t = make_tables(spark)
    assert shipment_not_received(t, SR_START, SR_END, "All Locations", None, "All", reuse=False).count() == 0
