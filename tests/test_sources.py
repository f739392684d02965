"""The stand-in registry."""

from tillroll.sources import TABLES
from tillroll.sources.standins import STANDIN_SQL, duckdb_standin_sql, standin_sources


def test_every_table_has_a_standin_over_driver_tables():
    assert set(STANDIN_SQL) == set(TABLES)
    for name in STANDIN_SQL:
        assert standin_sources(name), name
        assert "{" not in duckdb_standin_sql(name)


def test_standin_columns_match_registry(spark):
    from tillroll.sources.standins import standin_tables

    t = standin_tables(spark, "/root/testdata/sf0.001")
    for name, cols in TABLES.items():
        assert tuple(t[name].columns) == cols, name


def test_every_standin_keeps_all_rows(spark):
    """One view row for each driver row: the views shape values, the
    operators drop rows.  Header pairs split by date add up to their table."""
    from tillroll.sources.standins import standin_tables

    sf = "/root/testdata/sf0.001"
    t = standin_tables(spark, sf)
    source = {n: spark.read.parquet(f"{sf}/{n}.parquet").count() for n in
              ("nation", "supplier", "part", "orders", "lineitem", "events")}
    rows = {name: t[name].count() for name in STANDIN_SQL}
    for a, b in (("receipt_header", "ar_receipt_header"), ("sop_open_header", "sop_hist_header")):
        assert rows.pop(a) + rows.pop(b) == source["orders"], (a, b)
    assert rows.pop("locations") == source["nation"] + source["supplier"]
    assert rows.pop("report_locations") == source["nation"]
    for name, n in rows.items():
        (table,) = standin_sources(name)
        assert n == source[table], name
