"""Randomised differential test of the whole profit job.

A small random product universe -- shared report codes, aliases, flags,
NULL and zero prices -- with random receipts, shipments, sales and stock
runs through Spark (weighted item bag, pre-aggregated facts) and through the
oracle's SQL in DuckDB and a plain Python run over item rows and fact rows.  Quantities
are whole numbers and prices have two decimals, as in the driver data.
"""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from checks import oracle_profit as OP
from checks.compare import compare
from tests.tables import make_tables, pad20
from tests.test_profit_golden import check_against_model
from tests.test_properties import _duck
from tillroll.plans import profit_job as PJ
from tillroll.sources import CONTRACT

CODES = [f"{1000001 + i}" for i in range(8)]
money = st.one_of(st.none(), st.just(Decimal("0")), st.integers(min_value=1, max_value=9999).map(lambda c: Decimal(c) / 100))
qty = st.one_of(st.none(), st.integers(min_value=-3, max_value=9).map(Decimal))
pos_qty = st.integers(min_value=1, max_value=9).map(Decimal)
code7 = st.sampled_from(CODES)
day = st.integers(min_value=0, max_value=900).map(lambda d: dt.datetime(2008, 1, 1) + dt.timedelta(days=d))


@st.composite
def universe(draw):
    pm, pmd = [], []
    for c in CODES:
        alias = draw(st.one_of(st.none(), st.sampled_from(CODES).map(lambda a: "UPC" + a)))
        pm.append((pad20(c), "T" + c, draw(st.sampled_from([None, "  ", "978" + c])), draw(money), draw(money),
                   Decimal("1.00"), "SEC", "V", draw(st.sampled_from(["TTB", "TTB", "GEN"])),
                   draw(st.sampled_from(["Y", "N"])), alias))
        pmd.append((pad20(c), draw(st.one_of(st.none(), st.sampled_from(CODES[:3]).map(pad20))), "U" + c))
    pos = [f"PO{i}" for i in range(5)]
    rows = {
        "product_master": pm,
        "product_master_dist": pmd,
        "order_detail": draw(st.lists(st.tuples(st.sampled_from(pos), code7.map(pad20)), max_size=8)),
        "order_header": draw(st.lists(st.tuples(st.sampled_from(pos), st.sampled_from([None, "B1", "B2"])), max_size=6)),
        "oos_item_log": draw(st.lists(st.tuples(code7, st.sampled_from([dt.datetime(2024, 6, 1), dt.datetime(2023, 6, 1)])), max_size=4)),
        "receipt_header": [(i, draw(day)) for i in range(3)],
        "receipt_detail": draw(st.lists(st.tuples(st.integers(0, 3), code7, qty), max_size=10)),
        "ar_receipt_header": [(i, draw(day)) for i in range(2)],
        "ar_receipt_detail": draw(st.lists(st.tuples(st.integers(0, 2), code7, qty), max_size=6)),
        "pop_receipt_header": [("P1", dt.datetime(2009, 1, 1), 1), ("P2", dt.datetime(2011, 1, 1), 1)],
        "pop_receipt_line": draw(st.lists(st.tuples(st.sampled_from(["P1", "P2"]), code7, money, st.one_of(money, st.just(Decimal("3")))), max_size=6)),
        "transfer_header": [(1,), (2,)],
        "transfer_detail": draw(st.lists(st.tuples(st.integers(1, 3), code7.map(pad20), pos_qty), max_size=8)),
        "locations": [("L1", "00012", "S", "Y", "A", "S", None, None, None), ("L2", "HQ", "H", "Y", "A", "S", None, None, None)],
        "sales_item_history": draw(st.lists(st.tuples(
            st.sampled_from(["L1", "L2"]), code7.map(pad20), st.sampled_from(["Y", "N", None]), pos_qty,
            money.filter(lambda m: m is not None), st.just(Decimal("10")), st.sampled_from([Decimal("9"), Decimal("11")]),
            st.sampled_from(["S", "S", "V"])), max_size=10)),
        "sop_open_header": [("S1", 3, "C1", "STD", "E"), ("S2", 3, "RDC1", "STD", "E")],
        "sop_open_line": draw(st.lists(st.tuples(st.sampled_from(["S1", "S2"]), code7, qty, money), max_size=8)),
        "sop_hist_header": [("H1", 3, "C2", "STD", "E")],
        "sop_hist_line": draw(st.lists(st.tuples(st.just("H1"), code7, qty, money), max_size=6)),
        "wms_available_qty": draw(st.lists(st.tuples(code7, st.integers(0, 9)), max_size=6)),
    }
    return rows


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(rows=universe())
def test_profit_job_equals_literal_sql(spark, rows):
    run = PJ.run_profit(make_tables(spark, **rows), OP.AS_OF)
    con = _duck(rows)
    for stage, attr in [("items", None), ("receipts", "receipts"), ("store_ship", "store_ship"),
                        ("store_sales", "store_sales"), ("ws", "wholesale")]:
        if attr is None:
            df, sql = run.items.items, f"WITH {OP.ITEM_CTES}\nSELECT {OP.ITEM_COLS}, count(*) AS n FROM items GROUP BY ALL"
        else:
            df, sql = getattr(run, attr), f"WITH {OP.ITEM_CTES},{OP.MEASURE_CTES}\nSELECT * FROM {stage}"
        res = compare(df, con, sql)
        assert res["ok"], (stage, res)
    res = compare(run.report, con, f"WITH {OP.ITEM_CTES},{OP.MEASURE_CTES}\n{OP.FINAL}")
    assert res["ok"], res
    check_against_model(run, rows)


def _rough(rows, salt):
    """The same rows with codes in mixed case and with trailing blanks, differently in every table."""

    def spell(table, k, v):
        turn = (salt + len(table) + k + ord(v[-1])) % 3 if isinstance(v, str) and v else 2
        return v.lower() if turn == 0 else v + "  " if turn == 1 else v

    kinds = {t: [f.kind for f in fields] for t, fields in CONTRACT.items()}
    return {t: [tuple(spell(t, k, v) if kinds[t][k] == "code" else v for k, v in enumerate(r)) for r in rs] for t, rs in rows.items()}


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(rows=universe(), salt=st.integers(0, 9))
def test_profit_job_on_rough_codes(spark, rows, salt):
    rough = _rough(rows, salt)
    check_against_model(PJ.run_profit(make_tables(spark, **rough), OP.AS_OF), rough)
