"""The path beyond the broadcast bound, and skewed keys.

With every broadcast disabled (explicit row bound 0, Spark's own thresholds
off) each join is a shuffle join; results must not change.  A skewed
fixture puts over a third of all sales lines on one item code and of all
shipment lines on one shipment.
"""

from decimal import Decimal

import pytest

from checks import oracle_profit as OP
from checks.compare import compare
from tests.tables import D, T, make_tables, pad20
from tests.test_profit_golden import AS_OF, MEASURES, ROWS, duck  # noqa: F401  (fixture)
from tillroll.plans import profit_job as PJ
from tillroll.plans.shipment_report import shipment_not_received
from tillroll.plans.strategy import CONF_BROADCAST_ROWS

NO_BROADCAST = {
    CONF_BROADCAST_ROWS: "0",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_shuffle_path_matches_direct_sql(spark, duck, no_broadcast):  # noqa: F811
    run = PJ.run_profit(make_tables(spark, **ROWS), AS_OF)
    plan = run.report._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    for stage, attr in MEASURES.items():
        res = compare(getattr(run, attr), duck, f"WITH {OP.ITEM_CTES},{OP.MEASURE_CTES}\nSELECT * FROM {stage}")
        assert res["ok"], (stage, res)
    res = compare(run.report, duck, f"WITH {OP.ITEM_CTES},{OP.MEASURE_CTES}\n{OP.FINAL}")
    assert res["ok"], res


def _skewed_rows():
    rows = {k: list(v) for k, v in ROWS.items()}
    hot = pad20("1000001")  # carried twice in the item set
    sales = rows["sales_item_history"]
    for i in range(3000):
        sales.append(("L1", hot, "N" if i % 3 else "Y", D(1 + i % 5), D(10 + i % 7), D(10), D(9 + i % 2), "S"))
    for i in range(2000):
        sales.append(("L1", pad20(f"{2000000 + i}"), "N", D(1), D(10), D(10), D(9), "S"))
    return rows


def test_hot_item_code(spark, no_broadcast):
    import duckdb

    from tests.test_profit_golden import SCHEMAS, _duck_type

    rows = _skewed_rows()
    con = duckdb.connect()
    for name, ddl in SCHEMAS.items():
        cols = [c.strip().split(" ", 1) for c in ddl.split(", ")]
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {_duck_type(t)}' for c, t in cols)})")
        if rows.get(name):
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' for _ in cols)})", rows[name])
    run = PJ.run_profit(make_tables(spark, **rows), AS_OF)
    res = compare(run.store_sales, con, f"WITH {OP.ITEM_CTES},{OP.MEASURE_CTES}\nSELECT * FROM store_sales")
    assert res["ok"], res


def test_hot_shipment(spark, no_broadcast):
    heads = [("BIG", "W", "00001", T("2015-01-01 08:00:00")), ("S2", "W", "00001", T("2015-01-01 09:00:00"))]
    lines = [("BIG", "W", "SUP" if i % 2 else "OWN", f"V{i % 9}") for i in range(4000)]
    lines += [("S2", "W", "OWN", "V1")] * 10 + [(f"X{i}", "W", "OWN", "V1") for i in range(3000)]
    sr_h = [("BIG", "W", 1), ("BIG", "W", 2)]
    sr_d = [(1, Decimal(1))] * 3000 + [(2, Decimal(-1))] * 3000 + [(1, None)] * 10
    t = make_tables(
        spark,
        locations=[("L1", "00001", "One", "Y", "A", "S", "D", "R", "TX")],
        shipment_header=heads,
        shipment_detail=lines,
        sr_header=sr_h,
        sr_detail=sr_d,
    )
    got = sorted(r.ShipmentNumber for r in shipment_not_received(t, "2015-01-01", "2015-01-01", "All Locations", None, "CDC").collect())
    assert got == ["BIG", "S2"]  # BIG nets to zero: not received
