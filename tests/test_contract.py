"""The typed contract, loading both ways, and folded codes: right answers from rough input, with filters that
reach the scan."""

import pytest

from tests.test_plans import plan_text
from tillroll.operators import sales as SA
from tillroll.operators import shipments as S
from tillroll.operators.bitmap_cut import cut_by_bitmap
from tillroll.operators.items import line_rows
from tillroll.plans.profit_job import run_profit
from tillroll.plans.shipment_report import shipment_not_received
from tillroll.sources import CONTRACT, ContractError, canonical_tables, ingest_tables, load_tables
from tillroll.sources.contract import check_required, schema_problems
from tillroll.sources.normalize import canonical, fold_text, fold_violations, unstamped
from tillroll.sources.standins import standin_tables

SF = "/root/testdata/sf0.001"
DATES = ("1996-01-01", "1996-06-30")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """The rough stand-ins, ingested into a folder and into a namespace of the catalog."""
    folder = str(tmp_path_factory.mktemp("lake"))
    ingest_tables(standin_tables(spark, SF, rough=True), folder)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS contract_lake LOCATION '{tmp_path_factory.mktemp('catalog')}'")
    ingest_tables(load_tables(spark, folder), "contract_lake", catalog=True)
    yield folder
    spark.sql("DROP DATABASE contract_lake CASCADE")


def _both(spark, lake):
    return load_tables(spark, lake, check_nulls=True), load_tables(spark, "contract_lake", catalog=True)


def _pushed(df) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        return " ".join(line for line in plan_text(df).splitlines() if "PushedFilters" in line)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_all_tables_load_from_folder_and_catalog(spark, lake):
    for tables in _both(spark, lake):
        assert set(tables) == set(CONTRACT)
        assert all(not unstamped(name, df.schema) for name, df in tables.items())
        canonical_tables(tables, require_stamp=True)
    kept = spark.sql("SHOW CREATE TABLE contract_lake.product_master").first()[0]
    assert "UserChar15_folded" in kept
    assert spark.table("contract_lake.product_master").schema["UserChar15_folded"].metadata  # kept with the table
    one = load_tables(spark, "elsewhere", ("locations",), catalog=True, stored_as={"locations": "contract_lake.locations"})
    assert one["locations"].count() == standin_tables(spark, SF)["locations"].count()


def test_both_jobs_run_on_both(spark, lake):
    clean = standin_tables(spark, SF)
    for tables in _both(spark, lake):
        for kind, value, vendor in (("all locations", None, "ALL"), ("Region ", "asia", "3 "), ("state", "st1  ", "cdc")):
            got = shipment_not_received(tables, *DATES, kind, value, vendor).collect()
            want = {"Region ": ("Region", "ASIA", "3"), "state": ("State", "ST1", "CDC")}.get(kind, ("All Locations", None, "All"))
            assert sorted(got) == sorted(shipment_not_received(clean, *DATES, *want).collect()) and got
    want = sorted(map(str, run_profit(clean, "2025-01-25").report.collect()))
    assert sorted(map(str, run_profit(load_tables(spark, "contract_lake", catalog=True), "2025-01-25").report.collect())) == want


def test_filters_reach_the_scan_through_the_shadows(spark, lake):
    t = canonical_tables(load_tables(spark, lake))
    assert "EqualTo(RetailStore_folded,Y)" in _pushed(S.resolve_locations(t["locations"], t["report_locations"], "State", "st1"))
    assert "EqualTo(Region_folded,ASIA)" in _pushed(S.resolve_locations(t["locations"], t["report_locations"], "region", "Asia"))
    orders = _pushed(SA.wholesale_orders(t["sop_hist_header"]))
    assert "EqualTo(DOCID_folded,STD)" in orders and "EqualTo(BCHSOURC_folded,SALES VOID)" in orders
    assert "EqualTo(UserChar15_folded,TTB)" in _pushed(line_rows(t["product_master"], t["product_master_dist"]))
    stores = S.resolve_locations(t["locations"], t["report_locations"], "All Locations")
    ships = _pushed(S.shipments_in_range(t["shipment_header"], t["shipment_detail"], stores, *DATES, "cdc"))
    assert "ShipmentType_folded" in ships and "DateTransferred" in ships
    raw = standin_tables(spark, SF, rough=True)
    assert "_folded" not in _pushed(SA.wholesale_orders(canonical(raw["sop_hist_header"], "sop_hist_header")))


def test_wrong_types_and_missing_columns_are_named(spark, lake, tmp_path):
    tables = load_tables(spark, lake)
    bad = str(tmp_path / "bad")
    tables["sales_item_history"].withColumn("quantity", tables["sales_item_history"]["quantity"].cast("double")).write.parquet(f"{bad}/sales_item_history")
    tables["vendor_master"].drop("Name").write.parquet(f"{bad}/vendor_master")
    with pytest.raises(ContractError) as e:
        load_tables(spark, bad, ("sales_item_history", "vendor_master"))
    assert e.value.problems == ["sales_item_history.quantity is double, expected number", "vendor_master.Name is missing (expected text)"]
    for name, df in standin_tables(spark, SF).items():
        assert schema_problems(name, df.schema) == []


def test_nulls_where_there_must_be_none(spark, tmp_path):
    df = spark.createDataFrame([("V1", "n"), (None, "m")], "VendorID string, Name string")
    with pytest.raises(ContractError, match="vendor_master.VendorID is NULL in 1 rows"):
        check_required({"vendor_master": df}, ["vendor_master"])
    with pytest.raises(Exception, match="vendor_master.VendorID is NULL"):
        ingest_tables({"vendor_master": df}, str(tmp_path / "x"), ["vendor_master"])


def test_unstamped_or_stale_shadows(spark, lake):
    plain = standin_tables(spark, SF)
    with pytest.raises(LookupError, match="product_master.ItemCode"):
        canonical_tables(plain, require_stamp=True)
    df = load_tables(spark, lake, ("vendor_master",))["vendor_master"]
    assert fold_violations(df, "vendor_master").count() == 0
    # a column of that name without the stamp is not trusted, and foreign rows are found
    other = spark.createDataFrame([("v1 ", "x", "wrong")], "VendorID string, Name string, VendorID_folded string")
    assert canonical(other, "vendor_master").first()["VendorID"] == "V1"
    assert [tuple(r) for r in fold_violations(other, "vendor_master").collect()] == [("VendorID", 1)]
    once = canonical(other, "vendor_master")
    assert plan_text(canonical(once, "vendor_master")).count("upper") == plan_text(once).count("upper") == 1
    both = df.unionByName(spark.createDataFrame([(None, None, "x"), ("q", None, "x")], df.schema))
    assert [tuple(r) for r in fold_violations(both, "vendor_master").collect()] == [("VendorID", 1)]


def test_fold_is_the_collation():
    assert fold_text("ttb  ") == "TTB" and fold_text(" ttb") == " TTB" and fold_text("Sales Void") == "SALES VOID"


def test_bitmap_cut_keeps_all_matches_and_few_others(spark):
    keys = spark.range(0, 3000, 3).selectExpr("cast(id AS string) AS k", "id % 2 AS j")
    rows = spark.range(3000).selectExpr("cast(id AS string) AS k", "id % 2 AS j", "id")
    got = cut_by_bitmap(rows, keys, ["k", "j"])
    assert {r.id for r in got.join(keys, ["k", "j"], "left_semi").collect()} == set(range(0, 3000, 3))
    assert 1000 <= got.count() <= 1010 and got.columns == rows.columns
    assert 1000 < cut_by_bitmap(rows, keys, ["k", "j"], bits=10).count() <= 3000  # more keys than bits: none lost
    assert cut_by_bitmap(rows, keys.limit(0), ["k"]).count() == 0
    narrow = keys.selectExpr("cast(j AS int) AS j")
    assert cut_by_bitmap(rows, narrow, ["j"]).count() == 3000
    with pytest.raises(TypeError, match="k is"):
        cut_by_bitmap(rows, keys.selectExpr("cast(k AS int) AS k"), ["k"])


def test_undated_lines_are_cut_before_any_exchange_at_both_extremes(spark, lake):
    """One plan, built without a job, whatever broadcasts are allowed: lines meet the bitmap in their scan stage."""
    t = canonical_tables(load_tables(spark, lake))
    stores = S.resolve_locations(t["locations"], t["report_locations"], "All Locations")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    try:
        for threshold in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            df = S.shipments_in_range(t["shipment_header"], t["shipment_detail"], stores, *DATES, "all")
            plan = plan_text(df)
            lines = plan[: plan.index("Company_folded")].splitlines()
            above = [x for x in lines if "Exchange hashpartitioning(ShipmentNo" in x or "_word" in x and "BroadcastHashJoin" in x]
            assert "BroadcastHashJoin" in above[-1], plan  # nearest to the scan of the lines: the bitmap, not an exchange
            found.append(sorted(map(str, df.collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found[0] == found[1] and found[0]


def test_one_anti_join_feeds_labels_and_result(spark):
    t = standin_tables(spark, SF)
    lazy = shipment_not_received(t, *DATES, vendor_id="CDC", reuse=False)
    assert plan_text(lazy).count("LeftAnti") == 1
    for vendor in ("All", "21"):  # the difference is a written table by then
        assert "LeftAnti" not in plan_text(shipment_not_received(t, *DATES, vendor_id=vendor))
    stores = S.resolve_locations(t["locations"], t["report_locations"], "All Locations")
    ships = S.shipments_in_range(t["shipment_header"], t["shipment_detail"], stores, *DATES)
    assert plan_text(S.not_received(ships, S.received_shipments(ships, t["sr_header"], t["sr_detail"]))).count("LeftAnti") == 1
