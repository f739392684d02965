"""Every registered query against its DuckDB oracle on the driver tables."""

import os

import pytest

from checks.compare import compare, duckdb_connection
from checks.registry import REGISTRY

SF_DIR = os.environ.get("TILLROLL_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no driver data at {SF_DIR}")
    return duckdb_connection(SF_DIR)


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql is not None])
def test_query_matches_oracle(spark, con, name):
    fn, sql = REGISTRY[name]
    res = compare(fn(spark, SF_DIR), con, sql)
    assert res["ok"], res


def test_entry_contract(spark):
    import __spark_entry__ as E

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 30
    df = E.entry(spark)
    assert df.columns[:3] == ["ItemCode", "Title", "ISBN"]
    assert df.count() >= 0


_SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "double": "DOUBLE",
}


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql is not None])
def test_query_types_match_oracle(spark, con, name):
    fn, sql = REGISTRY[name]
    df = fn(spark, SF_DIR)
    spark_types = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert spark_types == duck_types
