"""Collation-true comparison with filters that still reach the scan.

The reports compare codes (flags and keys) under a collation that ignores case
and trailing blanks: 'y' is 'Y' and 'TTB ' is 'TTB'.  ``fold`` is that rule.
``upper(rtrim(c))`` inside a job is right but can't be pushed to Parquet, so
``ingest_tables`` writes the folded value once, as a shadow column beside the
original, and stamps the column's metadata.  The stamp lies in the schema: in
the file footers of a folder, in the table properties of a catalog table.

A job works on ``canonical_tables``: each code column is its stamped shadow
where the table has one, else ``fold`` of the original.  The answers are the same
either way; with shadows the plan's filters are on plain columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.contract import CONTRACT, Field, check_schemas

SHADOW = "_folded"
STAMP = "tillroll.fold"
RULE = "upper-rtrim-1"
CODEC = "zstd"  # a shadow mostly repeats its original: zstd finds that, snappy hardly does
WRITERS = 4  # tables written at once, so that one table's last tasks leave no core idle


def fold(c: Column) -> Column:
    """The value as the collation sees it."""
    return F.upper(F.rtrim(c))


def fold_text(value: str) -> str:
    """``fold`` of a parameter or constant."""
    return value.rstrip(" ").upper()


def _folds(field: Field, schema: T.StructType) -> bool:
    """Is the column compared as text?  (An id that is stored as a string is, too.)"""
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    kind = kinds.get(field.name.lower())
    return field.kind in ("code", "id") and isinstance(kind, (T.StringType, T.CharType, T.VarcharType))


def _stamped(name: str, schema: T.StructType) -> set[str]:
    """Shadow columns that this rule has written for the named column's original."""
    return {f.name.lower() for f in schema.fields if f.metadata.get(STAMP) == f"{RULE}:{name}.{f.name.removesuffix(SHADOW)}"}


def with_shadows(df: DataFrame, name: str) -> DataFrame:
    """The contract's columns of relation ``name`` and a stamped shadow for each code column.  A NULL in a
    column that must not have one fails the job that computes the rows, by table and column."""
    out = []
    for field in CONTRACT[name]:
        c = F.col(f"`{field.name}`")
        if field.required:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{name}.{field.name} is NULL"))).otherwise(c)
        out.append(c.alias(field.name))
        if _folds(field, df.schema):
            out.append(fold(c).alias(field.name + SHADOW, metadata={STAMP: f"{RULE}:{name}.{field.name}"}))
    return df.select(*out)


def ingest_tables(
    tables: Mapping[str, DataFrame], base: str, names: Iterable[str] | None = None, catalog: bool = False
) -> None:
    """Write the relations with their shadows below the folder ``base``, or as tables of the namespace ``base``."""
    names = tuple(names or CONTRACT)
    check_schemas(tables, names)
    frames = [(name, with_shadows(tables[name], name)) for name in names]

    def write(name: str, df: DataFrame) -> None:
        writer = df.write.mode("overwrite").option("compression", CODEC)
        if catalog:
            writer.format("parquet").saveAsTable(f"{base}.{name}")
        else:
            writer.parquet(f"{base.rstrip('/')}/{name}")

    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
        written = [pool.submit(write, *frame) for frame in frames]
        for job in written:
            job.result()


def unstamped(name: str, schema: T.StructType) -> list[str]:
    """Code columns without a stamped shadow."""
    have = _stamped(name, schema)
    return [f.name for f in CONTRACT[name] if _folds(f, schema) and (f.name + SHADOW).lower() not in have]


def canonical(df: DataFrame, name: str) -> DataFrame:
    """Relation ``name`` with every code column folded: from its shadow where the stamp is there.  The columns
    made here are marked, so folding them again changes nothing: every operator folds what it compares."""
    have, present = _stamped(name, df.schema), {c.lower() for c in df.columns}
    done = {f.name.lower() for f in df.schema.fields if f.metadata.get(STAMP) == RULE}
    out = []
    for field in CONTRACT[name]:
        if field.name.lower() not in present:
            continue
        c = F.col(f"`{field.name}`")
        if field.name.lower() not in done and _folds(field, df.schema):
            c = F.col(f"`{field.name}{SHADOW}`") if (field.name + SHADOW).lower() in have else fold(c)
            c = c.alias(field.name, metadata={STAMP: RULE})
        out.append(c)
    return df.select(*out)


class CanonicalTables(Mapping):
    """The relations as the jobs compare them, each made on first access."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._raw = tables
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = canonical(self._raw[name], name)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(CONTRACT)

    def __len__(self) -> int:
        return len(CONTRACT)


def canonical_tables(tables: Mapping[str, DataFrame], require_stamp: bool = False) -> CanonicalTables:
    """``tables`` folded (given folded ones, the same).  With ``require_stamp`` every code column must have its
    shadow, so that no filter of a job is kept from the scan."""
    if isinstance(tables, CanonicalTables):
        return tables
    if require_stamp:
        missing = [f"{name}.{c}" for name in CONTRACT for c in unstamped(name, tables[name].schema)]
        if missing:
            raise LookupError(f"columns without a stamped shadow (see ingest_tables): {', '.join(missing)}")
    return CanonicalTables(tables)


def fold_violations(df: DataFrame, name: str) -> DataFrame:
    """Rows for each code column whose shadow is not the fold of its original (as after appending files that
    were not ingested): ``column_name``, ``n_rows``.  One scan; empty for a table ingested whole."""
    columns = [f.name for f in CONTRACT[name] if _folds(f, df.schema) and f.name + SHADOW in df.columns]
    spark: SparkSession = df.sparkSession
    if not columns:
        return spark.createDataFrame([], "column_name string, n_rows bigint")
    wrong = [F.count_if(~F.col(f"`{c}{SHADOW}`").eqNullSafe(fold(F.col(f"`{c}`")))).alias(c) for c in columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n_rows")) for c in columns])
    return df.agg(*wrong).select(F.inline(pairs)).filter(F.col("n_rows") > 0)
