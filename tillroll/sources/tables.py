"""Loading the relations the two jobs read.

A job takes a ``Tables`` mapping (name -> DataFrame), so the same operators run over
catalog tables, Parquet folders, or the stand-in views of ``standins``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.contract import CONTRACT, check_required, check_schemas

# name -> columns used (kinds are in ``contract``)
TABLES: dict[str, tuple[str, ...]] = {name: tuple(f.name for f in fields) for name, fields in CONTRACT.items()}

Tables = Mapping[str, DataFrame]


def load_tables(
    spark: SparkSession,
    base: str,
    names: tuple[str, ...] | None = None,
    catalog: bool = False,
    stored_as: Mapping[str, str] | None = None,
    check_nulls: bool = False,
) -> dict[str, DataFrame]:
    """The registered relations, checked against the contract before anything is planned on them.

    ``base`` is a folder of Parquet folders, or with ``catalog`` a namespace of
    tables.  ``stored_as`` gives a relation another place: a folder, or with
    ``catalog`` a table's full name (the relations lie in several databases).
    A missing column or a wrong type raises ``ContractError`` naming table and
    column, from the schemas alone; ``check_nulls`` also counts NULLs where
    there must be none.  Reads are lazy; each operator selects only its columns, so
    Spark prunes the scan (``ReadSchema``) and pushes its filters (``PushedFilters``).
    """
    names, stored_as, out = tuple(names or TABLES), stored_as or {}, {}
    for name in names:
        if catalog:
            out[name] = spark.table(stored_as.get(name, f"{base}.{name}"))
        else:
            out[name] = spark.read.parquet(stored_as.get(name, f"{base.rstrip('/')}/{name}"))
    check_schemas(out, names)
    if check_nulls:
        check_required(out, names)
    return out
