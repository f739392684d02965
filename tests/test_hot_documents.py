"""Header-line feeds in which one document holds a third of all lines: the sums are those of the plain join, and
no task has much more than the others."""

from decimal import Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan_text
from tillroll.operators import receipts as R
from tillroll.operators import sales as SA
from tillroll.operators.documents import meet_headers, times
from tillroll.operators.weights import code_keys, int_times

LINES, ITEMS, HOT = 60_000, 4_000, 7


@pytest.fixture(scope="module")
def feed(spark):
    """(lines, headers): document 7 has every third line; some headers stand twice, some documents have none."""
    lines = spark.range(LINES).selectExpr(
        f"if(id % 3 = 0, {HOT}, 100 + id % 1500) AS doc", f"lpad(cast(id * 31 % {ITEMS} AS string), 7, '0') AS item",
        "if(id % 11 = 0, null, cast(id % 100 AS decimal(19,5)) / 8) AS q", "cast(id % 50 AS decimal(19,4)) AS a",
    ).withColumn("q", F.col("q").cast("decimal(19,5)"))
    heads = spark.range(1700).selectExpr(f"if(id = 0, {HOT}, id) AS doc", "timestamp_ntz'2009-01-01 00:00:00' + make_interval(0, 0, 0, id) AS day")
    heads = heads.filter("doc % 10 <> 4").unionByName(heads.filter(f"doc = {HOT} OR doc % 9 = 0"))
    return lines.cache(), heads.cache()


@pytest.fixture()
def many_tasks(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in names}
    for k, v in zip(names, ("32", "false", "-1"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _keys(spark):
    return code_keys(spark.range(0, ITEMS, 2).selectExpr("lpad(cast(id AS string), 7, '0') AS ItemCode"), ITEMS)


def _sums(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_no_task_has_twice_the_median(spark, feed, many_tasks):
    lines, heads = feed
    met = meet_headers(lines.repartition(12), heads, "doc", "day")
    rows = {r["p"]: r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    scans = 12
    sides = [n for p, n in rows.items() if p < scans], [n for p, n in rows.items() if p >= scans]
    assert len(sides[0]) == scans and len(sides[1]) == 32  # hot lines in their scan tasks; the others dealt
    assert all(max(side) <= 2 * median(side) for side in sides)
    assert max(rows.values()) <= LINES / 12  # no task has more than a scan reads
    plain = lines.join(heads, "doc").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in plain) > 4 * median(r["count"] for r in plain)  # what the plain join would do


def test_hot_lines_are_never_dealt_by_document(spark, feed, many_tasks):
    lines, heads = feed
    met = meet_headers(lines, heads, "doc", "day")
    hot = met.filter(F.col("_times") > 1).select("doc").distinct().collect()
    assert [r["doc"] for r in hot if r["doc"] == HOT]
    plan = plan_text(met)
    assert plan.count("SortMergeJoin") == 1 and "approx_top_k" in plan
    first = plan[: plan.index("SortMergeJoin")]  # the hot side of the union comes first: broadcasts alone
    assert "BroadcastHashJoin" in first and "Exchange hashpartitioning(doc" not in first.split("BroadcastExchange")[0]


def test_feeds_equal_the_plain_join(spark, feed, many_tasks):
    lines, heads = feed
    keys = _keys(spark)
    rows = [r for r in lines.collect() if int(r["item"]) % 2 == 0]
    days = {}
    for h in heads.collect():
        days.setdefault(h["doc"], []).append(h["day"])
    want = {}
    for r in rows:
        for day in days.get(r["doc"], []):
            q0, q1, a, d, n = want.get(r["item"], (Decimal(0), None, Decimal(0), None, Decimal(0)))
            q1 = q1 if r["q"] is None else (q1 or Decimal(0)) + r["q"]
            q0 += r["q"] or 0
            want[r["item"]] = (q0, q1, a + r["a"], day if d is None else min(d, day), n + (r["a"] / (r["q"] or 1) if r["q"] is not None else 0))
    got = _sums(R.receipt_sums(heads.selectExpr("doc RECEIPT_ID", "day RECEIPT_DATE"), lines.selectExpr("doc RECEIPT_ID", "item ITEM", "q TOTAL_QTY"), keys))
    assert {k: (v[3], v[0], v[1]) for k, v in want.items()} == got
    got = _sums(SA.shipment_sums(heads.selectExpr("doc TransferID"), lines.selectExpr("doc TransferID", "lpad(item, 20, '0') ItemCode", "q Qty"), keys))
    assert {k.rjust(20, "0"): (v[1],) for k, v in want.items()} == got
    orders = heads.selectExpr("doc SOPNUMBE", "3 SOPTYPE", "'C1' CUSTNMBR", "'STD' DOCID", "'SALES ENTRY' BCHSOURC")
    got = _sums(SA.wholesale_sums(orders, lines.selectExpr("doc SOPNUMBE", "item ITEMNMBR", "q QTYTOINV", "cast(a AS decimal(19,5)) XTNDPRCE"), keys))
    assert {k: (v[1], v[2]) for k, v in want.items()} == got
    pops = heads.selectExpr("doc POPRCTNM", "day receiptdate", "1 POPTYPE")
    got = _sums(R.legacy_sums(pops, lines.selectExpr("doc POPRCTNM", "item ITEMNMBR", "cast(a AS decimal(19,5)) EXTDCOST", "q UNITCOST"), keys, "2030-01-01"))
    assert {k: (v[3], v[2]) for k, v in want.items()} == {k: (d, a) for k, (d, _, a) in got.items()}
    assert all(abs(got[k][1] - v[4]) < Decimal("1e-12") for k, v in want.items())


def test_times_keeps_all_digits(spark):
    df = spark.sql("SELECT cast('1.0000000000000000001' AS decimal(38,19)) x, cast('-2.5000000000000000003' AS decimal(38,19)) y, 3L n")
    assert df.select(times(F.col("x"), F.col("n")), times(F.col("y"), F.col("n"))).first()[:] == (Decimal("3.0000000000000000003"), Decimal("-7.5000000000000000009"))


def test_scaled_ratio_is_cut_not_rounded(spark):
    q = spark.sql("SELECT cast('0.9999999999999999999' AS decimal(38,19)) q, cast('-1.9999999999999999999' AS decimal(38,19)) r, 1L one, 2L two")
    got = q.select(int_times(F.col("q"), F.col("one")), int_times(F.col("q"), F.col("two")), int_times(F.col("r"), F.col("two"))).first()
    assert got[:] == (0, 1, -3)
