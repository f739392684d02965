"""The stored report's commits, its difference to a fresh run, several key audits at once, and order as data."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan_text
from tillroll.operators import audit as A
from tillroll.operators.order import with_position
from tillroll.plans.report_store import Commit, RefreshConflict, ReportStore
from tillroll.plans.stages import checkpointed


def _value(df):
    return [r.v for r in df.collect()]


def _rows(spark, v):
    return spark.range(1).select(F.lit(v).alias("v"))


def test_of_two_refreshes_from_one_commit_one_wins(spark, tmp_path):
    store = ReportStore(spark, str(tmp_path / "r"))
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.latest() is None
    first = store.write(_rows(spark, 0))
    assert first.number == 1 and first.parent == 0

    def refresh(v):
        try:
            return v, ReportStore(spark, store.base).write(_rows(spark, v), began=first)
        except RefreshConflict:
            return v, None

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(refresh, range(1, 5)))
    (winner,) = [(v, c) for v, c in done if c is not None]
    assert winner[1].number == 2 and _value(store.read()) == [winner[0]]
    left = [p.name for p in (tmp_path / "r" / "data").iterdir()]
    assert sorted(f"data/{n}" for n in left) == sorted(c.folder for c in store.commits())  # the losers' rows are gone
    assert not [p for p in (tmp_path / "r" / "_commits").iterdir() if p.name.startswith("_")]


def test_rebased_refreshes_all_commit_in_turn(spark, tmp_path):
    store = ReportStore(spark, str(tmp_path / "r"))
    start = store.write(_rows(spark, 0))
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda v: (store.write(_rows(spark, v), began=start, rebase=True), v), range(1, 5)))
    assert sorted(c.number for c, _ in done) == [2, 3, 4, 5]
    assert _value(store.read()) == [v for c, v in done if c.number == 5]
    assert all(_value(store.read(c.number)) == [v] for c, v in done)


def test_a_label_orders_nothing_and_old_commits_expire(spark, tmp_path):
    store = ReportStore(spark, str(tmp_path / "r"))
    store.write(_rows(spark, "old"), version="9999-12-31")
    store.write(_rows(spark, "new"), version="0000")
    assert _value(store.read()) == ["new"] and [c.version for c in store.commits()] == ["9999-12-31", "0000"]
    store.write(_rows(spark, "newer"))
    assert store.expire(2) == [1] and [c.number for c in store.commits()] == [2, 3]
    assert store.expire(1) == [2] and _value(store.read()) == ["newer"]
    assert store.write(_rows(spark, "next")).number == 4  # a number is never used again
    with pytest.raises(ValueError):
        store.expire(0)


def test_a_refresh_that_dies_leaves_the_old_report(spark, tmp_path):
    store = ReportStore(spark, str(tmp_path / "r"))
    store.write(_rows(spark, "good"))
    with pytest.raises(Exception, match="boom"):
        store.write(spark.range(3).select(F.raise_error(F.lit("boom")).alias("v")))
    assert _value(store.read()) == ["good"] and isinstance(store.latest(), Commit)


def test_report_diff_finds_planted_changes(spark):
    ddl = "k string, a int, b string, at int"
    same = [("x", 1, "p", 0), ("x", 1, "p", 0), (None, 5, None, 0), ("dup", 1, "q", 0)]
    stored = spark.createDataFrame([*same, ("c", 1, "p", 0), ("gone", 3, None, 0), ("two", 1, "s", 0), ("two", 2, "s", 0), ("n", None, "z", 0), ("dup", 1, "q", 0)], ddl)
    fresh = spark.createDataFrame([*same, ("c", 2, None, 9), ("new", 1, "p", 9), ("two", 1, "s", 9), ("two", 3, "s", 9), ("two", 4, "s", 9), ("n", None, "y", 9)], ddl)
    got = {tuple(r) for r in A.report_diff(stored, fresh, ["k"], ("at",)).collect()}
    assert got == {
        ("c", "changed", "a,b", 1, 1), ("gone", "removed", "", 1, 0), ("new", "added", "", 0, 1), ("two", "changed", "a", 1, 1),
        ("two", "added", "", 0, 1), ("n", "changed", "b", 1, 1), ("dup", "repeated", "", 2, 1),
    }
    assert A.report_diff(stored, stored, ["k"]).count() == 0
    assert A.report_diff(stored.limit(0), fresh, ["k"], ("at",)).filter("change <> 'added'").count() == 0


def test_key_audits_share_scans_and_count_before_the_exchange(spark, tmp_path):
    spark.createDataFrame([(1, "a", None), (1, "b", None), (2, "a", "x"), (2, "a", "x")], "i int, s string, z string").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    other = spark.createDataFrame([("q", 3), ("r", 1)], "s string, n bigint")
    got = A.key_audits({"by i": (t, ["i"]), "by s, z": (t, ["s", "z"]), "by z": (t, ["z"])})
    plan = plan_text(got)
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan
    assert {tuple(r) for r in got.collect()} == {("by i", "1", 2), ("by i", "2", 2), ("by s, z", "a|x", 2), ("by z", "NULL", 2), ("by z", "x", 2)}
    assert {tuple(r) for r in A.key_audits({"weighted": (other, ["s"])}, weight="n").collect()} == {("weighted", "q", 3)}


def test_positions_without_one_task_for_all(spark):
    df = spark.range(5000).selectExpr("if(id % 97 = 0, null, cast(id * 7919 % 5003 AS string)) AS s", "id % 3 AS j", "id")
    got = with_position(df, ["s", "j", "id"], checkpointed)
    assert "SinglePartition" not in plan_text(got)
    rows = sorted(got.collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(1, 5001))
    assert [(r.s is not None, r.s or "", r.j, r.id) for r in rows] == sorted((r.s is not None, r.s or "", r.j, r.id) for r in rows)
    assert with_position(df.limit(0), ["s"], checkpointed).count() == 0
