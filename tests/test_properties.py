"""Randomised differential tests of the shipment report.

Hypothesis draws small shipment, line and receipt tables; Spark runs the
report, DuckDB runs the literal oracle SQL on the same rows, and the outputs
must be equal.  Received and not-received shipments must partition the
shipments in range.
"""

import datetime as dt
from decimal import Decimal

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from checks import oracle_shipments as OS
from checks.compare import compare
from tests.tables import SCHEMAS, make_tables
from tillroll.operators import shipments as S
from tillroll.plans.shipment_report import shipment_not_received

START, END = "2015-01-01", "2015-01-03"
STORES = [("L1", "00001", "One", "Y", "A", "S", "D1", "R1", "TX"), ("L2", "00002", "Two", "Y", "A", "S", "D1", "R1", "OK")]
VENDORS = [("V1", "Vendor One"), ("V2", None)]

ship = st.tuples(
    st.sampled_from([f"S{i}" for i in range(8)]),
    st.sampled_from(["W", "R", "X"]),
    st.sampled_from(["00001", "00002", "00009"]),
    st.integers(min_value=-1, max_value=4).map(lambda d: dt.datetime(2015, 1, 1) + dt.timedelta(days=d, hours=d % 3)),
)


@st.composite
def report_tables(draw):
    heads = draw(st.lists(ship, min_size=1, max_size=8, unique_by=lambda r: (r[0], r[1])))
    keys = [(h[0], h[1]) for h in heads] + [("S9", "W")]
    line = st.tuples(st.sampled_from(keys), st.sampled_from(["SUP", "OWN", None]), st.sampled_from(["V1", "V2", "V3"]))
    lines = [(k[0], k[1], c, v) for k, c, v in draw(st.lists(line, max_size=14))]
    vlines = [(k[0], k[1], v) for k, _, v in draw(st.lists(line, max_size=8))]
    batch = st.tuples(st.sampled_from(keys), st.integers(min_value=1, max_value=6))
    sr_h = [(k[0], k[1], b) for k, b in draw(st.lists(batch, max_size=8))]
    qty = st.one_of(st.none(), st.integers(min_value=-2, max_value=3).map(Decimal))
    sr_d = draw(st.lists(st.tuples(st.integers(min_value=1, max_value=6), qty), max_size=10))
    return {
        "locations": STORES,
        "shipment_header": heads,
        "shipment_detail": lines,
        "shipment_vendor_detail": vlines,
        "sr_header": sr_h,
        "sr_detail": sr_d,
        "vendor_master": VENDORS,
    }


def _duck(rows):
    con = duckdb.connect()
    types = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT", "int": "INTEGER"}
    for name, ddl in SCHEMAS.items():
        cols = [c.strip().split(" ", 1) for c in ddl.split(", ")]
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {types.get(t, t.upper())}' for c, t in cols)})")
        if rows.get(name):
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' for _ in cols)})", rows[name])
    return con


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=report_tables(), vendor=st.sampled_from(["All", "CDC", "V1", "V2"]))
def test_report_equals_literal_sql(spark, rows, vendor):
    t = make_tables(spark, **rows)
    con = _duck(rows)
    mode = {"All": "all", "CDC": "cdc"}.get(vendor, "vendor")
    got = shipment_not_received(t, START, END, "All Locations", None, vendor, reuse=False)
    res = compare(got, con, OS.not_received_sql(mode, START, END, vendor if mode == "vendor" else None, standins=False))
    assert res["ok"], res


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=report_tables())
def test_received_and_open_partition_shipments(spark, rows):
    t = make_tables(spark, **rows)
    stores = S.resolve_locations(t["locations"], t["report_locations"], "All Locations")
    ships = S.shipments_in_range(t["shipment_header"], t["shipment_detail"], stores, START, END, "all")
    rec = S.received_shipments(ships, t["sr_header"], t["sr_detail"])
    keys = {(r.ShipmentNo, r.ShipmentType) for r in ships.collect()}
    got_rec = {(r.ShipmentNo, r.ShipmentType) for r in rec.collect()}
    opened = {(r.ShipmentNo, r.ShipmentType) for r in ships.join(rec, ["ShipmentNo", "ShipmentType"], "left_anti").collect()}
    assert got_rec | opened == keys and not (got_rec & opened)
    assert all(r.qty > 0 for r in rec.collect())
