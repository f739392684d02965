"""Golden fixture for the profit roll-up.

The fixture is loaded into Spark and into DuckDB, which runs the oracle's SQL.
As that SQL sums by code too, the stages are also checked against a plain Python
run over item rows and fact rows (``model_profit``), and some rules by hand.
"""

import copy
import dataclasses
from collections import Counter
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import oracle_profit as OP
from checks.compare import compare
from tests import model_profit as model
from tests.tables import SCHEMAS, D, T, make_tables, pad20
from tillroll.operators import audit as A
from tillroll.plans import profit_job as PJ

AS_OF = "2025-01-25 00:00:00"


def pm(code, title, cost, price, line, reo, alias=None, isbn="978X"):
    return (pad20(code), title, isbn, D(cost), D(price), D(price and price * 1.25), "SEC", "VND", line, reo, alias)


ROWS = {
    "product_master": [
        pm("1000001", "One", 10, 20, "TTB", "Y"),
        pm("1000002", "Two", 11, 0, "TTB", "N", isbn="  "),  # price 0; blank ISBN -> UPC
        pm("1000003", "Three", 12, 30, "TTB", "Y"),  # second reorderable of family R1
        pm("1000004", "Four", None, None, "TTB", "Y"),  # NULL cost and price; NULL report code
        pm("1000005", "Five", 5, 9, "GEN", "N"),  # out of stock, other line
        pm("1000006", "Six", 6, 9, "TTB", "N"),  # out of stock, already tracked via family R6
        pm("1000007", "Seven", 7, 14, "TTB", "N"),  # alias target in family R1
        pm("1000008", "Eight", 8, 16, "GEN", "N", alias="UPC1000007"),
        pm("1000009", "Nine", 9, 18, "GEN", "N"),  # logged exactly one year before as_of
        pm("1000010", "Ten", 6, 12, "TTB", "Y"),  # reorderable of family R6
    ],
    "product_master_dist": [
        (pad20("1000001"), pad20("1000001"), "U1"),
        (pad20("1000002"), pad20("1000001"), "U2"),
        (pad20("1000003"), pad20("1000001"), "U3"),
        (pad20("1000004"), None, "U4"),
        (pad20("1000005"), None, "U5"),
        (pad20("1000006"), pad20("1000010"), "U6"),
        (pad20("1000007"), pad20("1000001"), "U7"),
        (pad20("1000008"), None, "U8"),
        (pad20("1000009"), None, "U9"),
        (pad20("1000010"), pad20("1000010"), "U10"),
    ],
    "order_detail": [
        ("PO2", pad20("1000001")), ("PO1", pad20("1000001")), ("PO3", pad20("1000003")),
        ("PO5", pad20("1000005")), ("PO7", pad20("1000007")),
    ],
    "order_header": [("PO1", "B7"), ("PO3", None), ("PO7", "B1"), ("PO7", "B2")],
    "oos_item_log": [
        ("1000005", T("2024-01-25 00:00:01")),
        ("1000005", T("2023-06-01 00:00:00")),
        ("1000009", T("2024-01-25 00:00:00")),
        ("1000006", T("2024-12-01 00:00:00")),
    ],
    "receipt_header": [(1, T("2014-01-05 10:00:00")), (3, T("2014-02-02 00:00:00")), (5, T("1900-01-01 00:00:00"))],
    "receipt_detail": [
        (1, "1000001", D(3)), (1, "1000001", None), (1, "1000002", None),
        (3, "1000003", D(4)), (5, "1000002", D(2)), (7, "1000001", D(100)),
    ],
    "ar_receipt_header": [(4, T("2014-02-02 00:00:00")), (2, T("2013-01-01 00:00:00"))],
    "ar_receipt_detail": [(4, "1000003", D(4)), (2, "1000001", D(1))],
    "pop_receipt_header": [
        ("P1", T("2009-05-05 00:00:00"), 1), ("P2", T("2009-05-05 00:00:00"), 2), ("P3", T("2011-01-01 00:00:00"), 1),
    ],
    "pop_receipt_line": [
        ("P1", "1000004", D(15), D(0)), ("P1", "1000004", D("7.5"), D(5)), ("P1", "1000001", D(3), D(2)),
        ("P1", "1000001", D(4), None), ("P2", "1000001", D(50), D(1)), ("P3", "1000001", D(50), D(1)),
    ],
    "transfer_header": [(1,), (2,)],
    "transfer_detail": [
        (1, pad20("1000001"), D(5)), (1, pad20("1000003"), D(2)), (2, pad20("1000003"), D(-2)), (9, pad20("1000001"), D(40)),
    ],
    "locations": [
        ("L1", "00012", "Store", "Y", "A", "S", None, None, None),
        ("L2", "201", "Big", "Y", "A", "S", None, None, None),
        ("L3", "HQ", "Office", "Y", "A", "S", None, None, None),
        ("L4", "1", "Shut", "Y", "I", "S", None, None, None),
    ],
    "sales_item_history": [
        ("L1", pad20("1000001"), "N", D(2), D(20), D(10), D(9), "S"),
        ("L1", pad20("1000001"), "Y", D(1), D(10), D(10), D(9), "S"),
        ("L1", pad20("1000001"), None, D(1), D(10), D(10), D(9), "S"),
        ("L1", pad20("1000001"), "N", D(5), D(50), D(10), D(9), "V"),
        ("L2", pad20("1000001"), "N", D(5), D(50), D(10), D(9), "S"),
        ("L3", pad20("1000003"), "N", D(5), D(50), D(10), D(9), "S"),
        ("L1", pad20("1000003"), "N", D(3), D(10), D(10), D(10), "S"),
    ],
    "sop_open_header": [
        ("S1", 3, "C1", "STD", "Sales Entry"), ("S2", 3, "RDC9", "STD", "Sales Entry"),
        ("S3", 3, None, "STD", "Sales Entry"), ("S4", 3, "C4", "STD", None), ("S5", 3, "C5", "STD", "Sales Void"),
    ],
    "sop_open_line": [
        ("S1", "1000001", D(1), D(10)), ("S1", "1000003", D(1), D(5)), ("S1", "1000003", D(-1), D(-5)),
        ("S1", "1000004", None, D(3)), ("S1", "1000002", D(2), D(8)), ("S2", "1000001", D(50), D(50)),
        ("S3", "1000001", D(50), D(50)), ("S4", "1000001", D(50), D(50)), ("S5", "1000001", D(50), D(50)),
    ],
    "sop_hist_header": [("H1", 3, "C1", "STD", "Sales Entry")],
    "sop_hist_line": [("H1", "1000001", D(99), D(1980)), ("H1", "1000002", D(2), D(8))],
    "wms_available_qty": [("1000001", 7), ("1000005", 3), ("1000003", 1), ("1000003", 2)],
}

STAGES = {
    "cr": ("reorderables", False),
    "upc": ("alias", False),
    "items_m3": ("family", True),
    "items_m4_add": ("readded", True),
    "items_m5": ("flipped", True),
    "oos": ("out_of_stock", False),
    "items": ("items", True),
}
MEASURES = {
    "receipts_hold": "receipts_feeds",
    "receipts_legacy": "legacy_receipts",
    "receipts": "receipts",
    "store_ship": "store_ship",
    "store_sales": "store_sales",
    "ws_calc": "wholesale_feeds",
    "ws": "wholesale",
}


def _duck_type(t: str) -> str:
    t = t.strip()
    return {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT", "int": "INTEGER"}.get(t, t.upper())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name, ddl in SCHEMAS.items():
        cols = [c.strip().split(" ", 1) for c in ddl.split(", ")]
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {_duck_type(t)}' for c, t in cols)})")
        rows = ROWS.get(name, [])
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' for _ in cols)})", rows)
    return con


@pytest.fixture(scope="module")
def run(spark):
    return PJ.run_profit(make_tables(spark, **ROWS), AS_OF)


def _items_sql(stage, counted):
    sel = f"SELECT {OP.ITEM_COLS}, count(*) AS n FROM {stage} GROUP BY ALL" if counted else f"SELECT * FROM {stage}"
    return f"WITH {OP.ITEM_CTES}\n{sel}"


@pytest.mark.parametrize("stage", list(STAGES))
def test_item_stage_matches_direct_sql(run, duck, stage):
    attr, counted = STAGES[stage]
    res = compare(getattr(run.items, attr), duck, _items_sql(stage, counted))
    assert res["ok"], res


@pytest.mark.parametrize("stage", list(MEASURES))
def test_measure_matches_direct_sql(run, duck, stage):
    res = compare(getattr(run, MEASURES[stage]), duck, f"WITH {OP.ITEM_CTES},{OP.MEASURE_CTES}\nSELECT * FROM {stage}")
    assert res["ok"], res


def test_report_matches_direct_sql(run, duck):
    res = compare(run.report, duck, f"WITH {OP.ITEM_CTES},{OP.MEASURE_CTES}\n{OP.FINAL}")
    assert res["ok"], res


def test_family_fanout_weights(run):
    # Q7: two reorderables share report code R1, so every family code is
    # carried twice; the alias item is re-added once per reorderable.
    w = {r.ItemCode: r.n for r in run.items.items.groupBy("ItemCode").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert w["1000001"] == 2 and w["1000002"] == 2 and w["1000003"] == 2
    assert w["1000007"] == 2 and w["1000004"] == 1
    # Q18: out-of-stock item from another line is added; the one logged
    # exactly a year before as_of is not; a tracked one is not re-added.
    oos = {r.ItemCode for r in run.items.out_of_stock.collect()}
    assert oos == {"1000005"}


def test_code_flip_and_buyer(run):
    rows = run.items.items.collect()
    # Family R1 has a reorderable whose own code differs -> highest code.
    assert {r.ReportItemCode for r in rows if r.ItemCode in ("1000001", "1000002")} == {pad20("1000003")}
    # Matched PO with NULL buyer -> NULL; unmatched -> ''; two headers -> max.
    buyers = {(r.ItemCode, r.OrgPO, r.OrgBuyer) for r in rows}
    assert ("1000003", "PO3", None) in buyers
    assert ("1000004", None, "") in buyers
    assert ("1000007", "PO7", "B2") in buyers


def test_measure_rules(run):
    legacy = {r.ItemCode: r for r in run.legacy_receipts.collect()}
    assert legacy["1000004"].RcvdQty == 16  # Q11: 15/1 + 7.5/5, truncated after the sum
    assert legacy["1000001"].RcvdQty == 3  # 2 x 1.5 = 3, not 2 x int(1.5)
    ship = sorted((r.ItemCode, r.HPBShipQty, r.HPBShipAmt) for r in run.store_ship.collect())
    assert ship == [("1000001", 5, Decimal("50.0000")), ("1000001", 5, Decimal("60.0000")), ("1000003", 0, Decimal("0.0000"))]
    ws = {r.ITEMNMBR: r for r in run.wholesale.collect()}
    assert ws["1000001"].TTBAvgSoldAmt == Decimal("15.000000")  # Q9: mean of 10 and 20
    assert ws["1000003"].TTBAvgSoldAmt == Decimal("0.000000")  # Q10: zero quantity
    assert ws["1000004"].TTBAvgSoldAmt is None  # Q10: NULL quantity
    assert ws["1000002"].TTBSoldQty == Decimal("4.00000")  # Q6: identical feeds count once
    ss = {r.ItemCode: r for r in run.store_sales.collect()}
    assert ss["1000001"].HPBSoldQty == Decimal("4.00000") and ss["1000001"].HPBmarkdowns == 2  # Q12, Q13


def test_report_rules(run):
    rep = {}
    for r in run.report.collect():
        rep.setdefault(r.ItemCode, []).append(r)
    assert len(rep["1000001"]) == 4  # Q7 attribute rows x Q8 two shipment costs
    # Q3: a 1900-01-01 receipt shows its date yet takes the no-receipt
    # branch; Q4: that branch adds a missing stock row as NULL, so the
    # quantity falls to 0 although 4 units sold wholesale.
    assert {r.RcvdDate for r in rep["1000002"]} == {"1900-01-01"}
    assert {r.RcvdQty for r in rep["1000002"]} == {0}
    assert {r.NetTTBSoldQty for r in rep["1000002"]} == {4}
    five = rep["1000005"][0]
    assert five.RcvdDate == "NA" and five.RcvdQty == 3  # Q4 fallback: stock only
    four = rep["1000004"][0]
    assert four.TTBAvgPrf is not None or four.TTBAvgDiscPct is None  # Q22 NULL cost/price
    assert len(rep["1000003"]) >= 2  # duplicate stock rows fan out


def test_unique_fanout_counts_each_code_once(spark, run):
    uniq = PJ.run_profit(make_tables(spark, **ROWS), AS_OF, fanout="unique")
    ws = {r.ITEMNMBR: r for r in uniq.wholesale.collect()}
    assert ws["1000001"].TTBSoldQty == Decimal("100.00000")  # 1 + 99 once
    ref = {r.ITEMNMBR: r for r in run.wholesale.collect()}
    assert ref["1000001"].TTBSoldQty == Decimal("200.00000")  # doubled by the two item rows


def test_audits(run):
    dup = {r.ReportItemCode: r.n_rows for r in A.duplicate_keys(run.items.reorderables, ["ReportItemCode"]).collect()}
    assert dup == {pad20("1000001"): 2}
    fan = A.family_fanout(run.items.reorderables, run.items.family).collect()
    assert [(r.reorderable_rows, r.family_rows) for r in fan] == [(2, 6)]
    traced = A.item_trace(run.report, ["1000005"]).collect()
    assert [r.ItemCode for r in traced] == ["1000005"]


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_feeds_from_the_start_equal_those_on_demand(spark, run):
    early = PJ.run_profit(make_tables(spark, **ROWS), AS_OF, feeds=PJ.FEEDS)
    assert set(early._sums) == set(PJ.FEEDS)
    assert _rows(early.report) == _rows(run.report)


def test_a_measure_sums_its_own_feed_only(spark):
    one = PJ.run_profit(make_tables(spark, **ROWS), AS_OF)
    one.store_sales.collect()
    assert set(one._sums) == {"sales"} and "items" not in vars(one.items) and "flipped" not in vars(one.items)


def check_against_model(run, rows):
    """The job's stages against a plain Python run over item rows and fact rows."""
    bag = model.items(rows, AS_OF)
    names = ["Title", "ItemCode", "ReportItemCode", "ISBN", "Cost", "Price", "MSRP", "SectionCode", "VendorID", "OrgPO", "OrgBuyer"]
    got = {tuple(r[c] for c in names): r["n"] for r in run.items.items.collect()}
    assert got == dict(Counter(bag))
    assert _rows(run.receipts_feeds.select("ItemCode", "RcvdDate", "RcvdQty", "RcvdAmt")) == model.receipts(bag, rows)
    assert _rows(run.legacy_receipts.select("ItemCode", "RcvdDate", "RcvdQty", "RcvdAmt")) == model.legacy(bag, rows)
    assert _rows(run.store_ship.select("ItemCode", "HPBShipQty", "HPBShipAmt")) == model.store_ship(bag, rows)
    sales = run.store_sales.select("ItemCode", "HPBSoldQty", "HPBSoldAmt", "HPBAvgSoldAmt", "HPBmarkdowns")
    assert _rows(sales) == model.store_sales(bag, rows)
    assert _rows(run.wholesale.select("ITEMNMBR", "TTBSoldQty", "TTBSoldAmt", "TTBAvgSoldAmt")) == model.wholesale(bag, rows)


def test_stages_equal_a_plain_python_run(run):
    check_against_model(run, ROWS)


def test_a_wrong_weight_is_noticed(run):
    wrong = dataclasses.replace(run.weights, by_code=run.weights.by_code.withColumn("n", F.col("n") + 1))
    broken = copy.copy(run)
    for name in ("receipts_feeds", "legacy_receipts", "store_sales", "wholesale", "wholesale_feeds"):
        broken.__dict__.pop(name, None)
    broken.weights = wrong
    with pytest.raises(AssertionError):
        check_against_model(broken, ROWS)


def test_money_mode_switch_reaches_the_percent_text(spark):
    rows = dict(ROWS)
    # price 3, one wholesale sale of 3 units for 3.00 -> average 1.0000;
    # discount ratio (3 - 1) / 3 = 0.66666...: HALF_UP 0.6667, cut 0.6666.
    rows["product_master"] = [pm("1000001", "One", 1, 3, "TTB", "Y")]
    rows["product_master_dist"] = [(pad20("1000001"), pad20("1000001"), "U1")]
    rows["sop_open_line"] = [("S1", "1000001", D(3), D(3))]
    rows["sop_hist_line"] = []
    half = PJ.run_profit(make_tables(spark, **rows), AS_OF).report.first()
    cut = PJ.run_profit(make_tables(spark, **rows), AS_OF, money_mode="truncate").report.first()
    assert half.TTBAvgDiscPct == "66.67 %"
    assert cut.TTBAvgDiscPct == "66.66 %"
