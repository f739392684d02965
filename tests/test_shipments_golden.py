"""Golden cases for the shipment report."""

from decimal import Decimal

import pytest

from tests.tables import T, make_tables
from tillroll.operators import shipments as S
from tillroll.plans.shipment_report import report_mode, shipment_not_received

START, END = "2014-12-31", "2015-01-01"


def label(no, name):
    return f"{no} - {name}".ljust(8 + 30)


L1 = label("00001", "Store One")
L2 = label("00002", "Store Two")


@pytest.fixture(scope="module")
def tables(spark):
    loc = [
        ("L1", "00001", "Store One", "Y", "A", "S", "D0", "R0", "OK"),
        ("L2", "00002", "Store Two", "Y", "A", "S", "D1", "R1", "TX"),
        ("L3", "00003", "Depot", "Y", "A", "W", "D1", "R1", "TX"),
        ("L4", "00004", "Closed", "N", "A", "S", "D1", "R1", "TX"),
        ("L5", "00451", "Outlet", "Y", "A", "S", "D2", "R1", "OK"),
    ]
    heads = [
        ("S1", "W", "00001", T("2014-12-31 00:00:00")),  # start instant: in
        ("S2", "R", "00001", T("2015-01-01 23:59:00")),  # last minute of end day: in
        ("S3", "W", "00001", T("2015-01-02 00:00:00")),  # end + 1 day: out
        ("S4", "W", "00002", T("2015-01-01 10:00:00")),  # supply lines only: out
        ("S5", "W", "00002", T("2014-12-31 09:00:00")),  # supply and other lines: in
        ("S6", "R", "00002", T("2015-01-01 12:00:00")),  # two vendors
        ("S7", "X", "00001", T("2015-01-01 12:00:00")),  # other type: out
        ("S8", "W", "00001", T("2015-01-01 08:00:00")),  # NULL company only: out
        ("S9", "W", "00001", T("2015-01-01 07:00:00")),  # received qty NULL
        ("S10", "W", "00001", T("2014-12-31 15:00:00")),  # not received, earlier date
    ]
    lines = [
        ("S1", "W", "OWN", "V9"), ("S2", "R", "OWN", "V1"), ("S3", "W", "OWN", "V9"),
        ("S4", "W", "SUP", "V9"), ("S5", "W", "SUP", "V9"), ("S5", "W", "OWN", "V9"),
        ("S6", "R", "OWN", "V1"), ("S6", "R", "OWN", "V2"), ("S7", "X", "OWN", "V9"),
        ("S8", "W", None, "V9"), ("S9", "W", "OWN", "V9"), ("S10", "W", "OWN", "V9"),
    ]
    vend_lines = [("S2", "R", "V1"), ("S6", "R", "V1"), ("S6", "R", "V2"), ("S5", "W", "V3")]
    sr_h = [("S1", "W", 1), ("S2", "R", 2), ("S2", "R", 3), ("S5", "W", 5), ("S9", "W", 9)]
    sr_d = [(1, Decimal(5)), (2, Decimal(3)), (3, Decimal(-3)), (5, Decimal(-1)), (9, None)]
    return make_tables(
        spark,
        locations=loc,
        report_locations=[("00001", "Store One", "North", "Y"), ("00002", "Store Two", "South", "Y")],
        shipment_header=heads,
        shipment_detail=lines,
        shipment_vendor_detail=vend_lines,
        sr_header=sr_h,
        sr_detail=sr_d,
        vendor_master=[("V1", "Vendor One"), ("V3", None)],
    )


@pytest.mark.parametrize(
    "ftype,dyn,expected",
    [
        ("All Locations", None, ["00001", "00002", "00451"]),
        ("Store", "00002", ["00002"]),
        ("District", "D1", ["00002", "00003"]),  # no LocationType test
        ("Region", "North", ["00001"]),
        ("RDC", "R1", ["00002", "00003"]),  # 00451 always left out
        ("State", "TX", ["00002"]),  # LocationType 'S' required
        ("Zone", "X", []),  # unknown type: no stores
        ("Store      ", "00002    ", ["00002"]),  # char(20) blanks ignored
    ],
)
def test_store_filters(spark, tables, ftype, dyn, expected):
    got = S.resolve_locations(tables["locations"], tables["report_locations"], ftype, dyn)
    assert sorted(r.LocationNo for r in got.collect()) == expected


def test_range_and_supply_rule(tables):
    stores = S.resolve_locations(tables["locations"], tables["report_locations"], "All Locations")
    got = S.shipments_in_range(tables["shipment_header"], tables["shipment_detail"], stores, START, END, "all")
    assert sorted(r.ShipmentNo for r in got.collect()) == ["S1", "S10", "S2", "S5", "S6", "S9"]


def test_received_only_positive_sums(tables):
    stores = S.resolve_locations(tables["locations"], tables["report_locations"], "All Locations")
    ships = S.shipments_in_range(tables["shipment_header"], tables["shipment_detail"], stores, START, END, "all")
    got = S.received_shipments(ships, tables["sr_header"], tables["sr_detail"]).collect()
    assert [(r.ShipmentNo, r.qty) for r in got] == [("S1", Decimal("5.00000"))]


def test_all_mode(tables):
    got = shipment_not_received(tables, START, END, "All Locations", None, "All", reuse=False)
    assert got.columns == ["Location", "ShipmentDate", "ShipmentNumber", "ShipmentType", "Vendor"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        [
            (L1, "01/01/2015", "S2", "R", "V1 - Vendor One"),
            (L2, "12/31/2014", "S5", "W", "CDC"),
            (L2, "01/01/2015", "S6", "R", "V1 - Vendor One"),
            (L2, "01/01/2015", "S6", "R", "No Shipping Detail - "),
            (L1, "01/01/2015", "S9", "W", "CDC"),
            (L1, "12/31/2014", "S10", "W", "CDC"),
        ]
    )


def test_cdc_mode_ordered_by_date_text(tables):
    got = [tuple(r) for r in shipment_not_received(tables, START, END, "All Locations", None, "CDC", reuse=False).collect()]
    assert got == [
        (L1, "01/01/2015", "S9", "W", "CDC"),  # text order: 01/01/2015 before 12/31/2014
        (L1, "12/31/2014", "S10", "W", "CDC"),
        (L2, "12/31/2014", "S5", "W", "CDC"),
    ]


def test_vendor_mode_lists_every_vendor_of_the_shipment(tables):
    got = shipment_not_received(tables, START, END, "All Locations", None, "V1", reuse=False)
    assert got.columns[0] == "Vendor"
    assert [tuple(r) for r in got.collect()] == [
        ("V1 - Vendor One", L1, "01/01/2015", "S2", "R"),
        ("No Shipping Detail - ", L2, "01/01/2015", "S6", "R"),
        ("V1 - Vendor One", L2, "01/01/2015", "S6", "R"),
    ]


def test_mode_choice():
    assert report_mode("All") == "all"
    assert report_mode("cdc ") == "cdc"
    assert report_mode("IDCROWNPOI") == "vendor"


def test_received_and_open_partition_the_shipments(tables):
    stores = S.resolve_locations(tables["locations"], tables["report_locations"], "All Locations")
    ships = S.shipments_in_range(tables["shipment_header"], tables["shipment_detail"], stores, START, END, "all")
    rec = {r.ShipmentNo for r in S.received_shipments(ships, tables["sr_header"], tables["sr_detail"]).collect()}
    opened = {r.ShipmentNumber for r in S.not_received_cdc(S.not_received(ships, S.received_shipments(ships, tables["sr_header"], tables["sr_detail"]))).collect()}
    allships = {r.ShipmentNo for r in ships.collect()}
    assert rec | opened == allships and not (rec & opened)
