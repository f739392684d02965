"""Correctness tooling: the query registry, its DuckDB oracle SQL, and a
local Spark-vs-DuckDB comparison used by the tests."""
