"""What a job does for each row of a large table: codes folded in the plan are worked out once, and each line table is scanned once."""

from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from tests.tables import make_tables
from tests.test_plans import logical_text, plan_text
from tests.test_profit_golden import AS_OF, ROWS
from tillroll.operators.bitmap_cut import CONF_BITS, cut_by_bitmap
from tillroll.operators.documents import meet_headers
from tillroll.operators.items import first_po
from tillroll.operators.weights import CodeKeys, ItemWeights
from tillroll.plans import profit_job as PJ
from tillroll.plans.stages import checkpointed
from tillroll.sources import ingest_tables
from tillroll.sources.normalize import canonical

KEYS = ["0000001", "0000003", None]


def _lines(spark):
    rows = [("S1", "0000001 ", 1), ("S2", "0000002", 2), ("S1", None, 3), (None, "0000003", 4), ("s1 ", "0000001", 5)]
    df = spark.createDataFrame(rows, "SOPNUMBE string, ITEMNMBR string, QTYTOINV int")
    return canonical(df.withColumn("XTNDPRCE", F.col("QTYTOINV")), "sop_open_line").select("SOPNUMBE", F.col("ITEMNMBR").alias("ItemCode"), "QTYTOINV")


def _scan_filters(df) -> list[str]:
    return [x for x in logical_text(df).splitlines() if "Filter" in x and "upper(" in x]


def test_the_bitmap_cut_tests_no_hash_for_null(spark):
    lines, keys = _lines(spark), spark.createDataFrame([("0000001",), ("0000003",)], "ItemCode string")
    cut = cut_by_bitmap(lines, keys, ["ItemCode"], 2)
    assert {r["QTYTOINV"] for r in cut.collect()} >= {1, 4, 5}
    assert not _scan_filters(cut)


def test_lines_are_cut_to_the_codes_without_folding_them_twice(spark):
    short = spark.createDataFrame([(k,) for k in KEYS], "ItemCode string")
    for small in (True, False):
        cut = CodeKeys(short, small).cut(_lines(spark), "ItemCode")
        assert sorted(r["QTYTOINV"] for r in cut.collect()) == [1, 4, 5]
        assert not _scan_filters(cut)


def test_no_line_is_exchanged_for_its_code(spark):
    short = spark.createDataFrame([(k,) for k in KEYS], "ItemCode string")
    keys, bits = CodeKeys(short, False), spark.conf.get(CONF_BITS, None)
    spark.conf.set(CONF_BITS, "1")  # so that other codes pass the bitmap
    try:
        cut = keys.cut(_lines(spark), "ItemCode")
        assert "BroadcastHashJoin" in plan_text(cut) and "SortMergeJoin" not in plan_text(cut)
        assert cut.count() > 3
        sums = keys.exact(cut.groupBy("ItemCode").agg(F.sum("QTYTOINV").alias("q")), "ItemCode")
        assert sorted(map(tuple, sums.collect())) == [("0000001", 6), ("0000003", 4)]
    finally:
        spark.conf.set(CONF_BITS, bits) if bits else spark.conf.unset(CONF_BITS)


def test_written_lines_have_headers_and_go_with_their_feed(spark, monkeypatch):
    counts, folders = [], {}

    def stage(df):
        table, n = checkpointed(df)
        counts.append(n)
        return table, n

    heads = spark.createDataFrame([("S1",), ("S1",), (None,)], "SOPNUMBE string")
    keys = CodeKeys(spark.createDataFrame([("0000001",), ("0000002",), ("0000003",)], "ItemCode string"), True)
    met = meet_headers(keys.cut(_lines(spark), "ItemCode"), heads, "SOPNUMBE", stage=stage)
    assert counts == [2] and met.agg(F.sum(F.col("QTYTOINV") * F.col("_times"))).first()[0] == 12
    # ids stored as a number in one table and as text in the other are compared by the join alone
    numbers = _lines(spark).select(F.lit(7).alias("SOPNUMBE"), "ItemCode", "QTYTOINV")
    met = meet_headers(numbers, spark.createDataFrame([("7",)], "SOPNUMBE string"), "SOPNUMBE", stage=stage)
    assert counts == [2, 5] and met.count() == 5

    def named(df, name=""):
        table, n = checkpointed(df)
        folders[name] = Path(urlparse(table.inputFiles()[0]).path).parent
        return table, n

    monkeypatch.setattr(PJ, "checkpointed", named)
    run = PJ.run_profit(make_tables(spark, **ROWS), AS_OF)
    assert run.report.count() > 0
    lines = {name for name in folders if name.startswith("lines-")}
    assert len(lines) == 6 and "feed-legacy" in folders
    assert {name for name, folder in folders.items() if not folder.exists()} == lines


def test_first_po_folds_once(spark):
    od = canonical(spark.createDataFrame([("P2", "a "), ("P1", "A"), ("P0", "b"), ("P0", None)], "PONumber string, ItemCode string"), "order_detail")
    codes = spark.createDataFrame([("A",), (None,), ("C",)], "MasterCode string")
    for rows in (3, 10**9):
        po = first_po(od, codes, rows)
        assert [tuple(r) for r in po.collect()] == [("A", "P1")]
        assert not _scan_filters(po)


def test_each_line_table_is_read_once(spark):
    staged = []

    def stage(df):
        staged.append(df)
        return checkpointed(df)

    lines, heads = _lines(spark), spark.createDataFrame([("S1",), ("S1",), ("S2",)], "SOPNUMBE string")
    keys = CodeKeys(spark.createDataFrame([(k,) for k in KEYS], "ItemCode string"), True)
    cut = keys.cut(lines, "ItemCode")
    met, plain = meet_headers(cut, heads, "SOPNUMBE", stage=stage), meet_headers(cut, heads, "SOPNUMBE")
    assert len(staged) == 1
    assert "upper(" in logical_text(plain) and "upper(" not in logical_text(met)  # it reads the written lines
    total = F.sum(F.col("QTYTOINV") * F.col("_times"))
    assert met.agg(total).first()[0] == plain.agg(total).first()[0] == 12


def test_ingested_files_are_compressed_well_and_whole(spark, tmp_path):
    raw = make_tables(spark, vendor_master=[("v1 ", "A"), ("V2", None)], sop_open_header=[("s1", 3, "c ", "std", "Sales Void")])
    names = ["vendor_master", "sop_open_header", "report_locations"]
    ingest_tables(raw, str(tmp_path), names)
    for name in names:
        files = [p.name for p in (tmp_path / name).glob("*.parquet")]
        assert files and all(f.endswith(".zstd.parquet") for f in files)
        lake = spark.read.parquet(f"{tmp_path}/{name}")
        assert sorted(map(str, canonical(lake, name).collect())) == sorted(map(str, canonical(raw[name], name).collect()))


def test_no_item_rows_pass_the_driver(spark):
    w = ItemWeights(*(spark.createDataFrame([("0000001", "1".rjust(20, "0"), 2, c)], f"ItemCode string, Code20 string, n bigint, {n} decimal(19,4)") for n, c in (("max_cost", None), ("Cost", None))), True)
    sums = spark.sql("SELECT '0000001' ItemCode, 3BD _q, 4BD _a")
    for side in (w.per_code(), w.per_code_cost()):
        met = sums.join(side, "ItemCode")
        assert met.count() == 1 and "BroadcastHashJoin" not in plan_text(met)
