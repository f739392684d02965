"""Data audits (M23-M25): duplicate keys, item traces, family fan-out.

The debugging copy of the profit job checks each stage by hand: duplicate
keys with GROUP BY ... HAVING count(*) > 1, spot checks of chosen items, and
a note that a report code shared by several items replicates rows.  These
are the same checks as distributed DataFrame operators.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.plans.strategy import bounded_broadcast


def duplicate_keys(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """Keys with more than one row -> keys + ``n_rows``.

    ``weight`` names a multiplicity column (a weighted bag) to count with.
    """
    cnt = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*keys).agg(cnt.alias("n_rows")).filter(F.col("n_rows") > 1)


def key_audits(audits: dict[str, tuple[DataFrame, list[str]]], weight: str | None = None) -> DataFrame:
    """M23 for several keys at once -> ``audit``, ``key`` (values joined by '|', NULL as such), ``n_rows``.

    ``audits`` names a table and the key that should be unique in it.  Audits
    of the same DataFrame share one scan: each row gives its keys, as grouping
    sets do, and equal keys are counted map-side before the one exchange, so a
    key with a third of all rows costs a row for each task.
    """
    tables: dict[int, tuple[DataFrame, list[Column]]] = {}
    for name, (df, keys) in audits.items():
        key = F.array_join(F.array(*[F.col(k).cast("string") for k in keys]), "|", "NULL")
        tables.setdefault(id(df), (df, []))[1].append(F.struct(F.lit(name).alias("audit"), key.alias("key")))
    count = F.col(weight) if weight else F.lit(1)
    rows = [
        df.select(F.explode(F.array(*keys)).alias("_a"), count.cast("bigint").alias("_n")).select("_a.audit", "_a.key", "_n")
        for df, keys in tables.values()
    ]
    every = reduce(DataFrame.unionByName, rows)
    return every.groupBy("audit", "key").agg(F.sum("_n").alias("n_rows")).filter(F.col("n_rows") > 1)


def report_diff(stored: DataFrame, fresh: DataFrame, keys: list[str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """How a stored report and a fresh run differ as bags -> the keys, ``change``, ``columns``,
    ``n_stored``, ``n_fresh``.

    Equal rows are counted on both sides by one aggregate, partial first, so
    rows that agree (nearly all) go no further than their counts.  A row on both sides in different
    numbers is a change ``repeated``.  The rows of one side only are paired
    within their key, in the order of their values: a pair is ``changed`` and
    ``columns`` names what differs (column order, comma-joined); a row without
    a partner is ``added`` or ``removed``.  NULL equals NULL.
    """
    names = [c for c in stored.columns if c not in ignore]
    values = [c for c in names if c not in keys]
    sides = stored.select(*names, F.lit(1).alias("_s"), F.lit(0).alias("_f")).unionByName(
        fresh.select(*names, F.lit(0).alias("_s"), F.lit(1).alias("_f"))
    )
    odd = sides.groupBy(*names).agg(F.sum("_s").alias("n_stored"), F.sum("_f").alias("n_fresh")).filter("n_stored <> n_fresh")
    row = F.struct(*values, "n_stored", "n_fresh")
    side = F.when(F.col("n_stored") == 0, "fresh").when(F.col("n_fresh") == 0, "stored").otherwise("both")
    ranked = odd.select(*keys, side.alias("_side"), row.alias("_row")).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys, "_side").orderBy("_row"))
    )

    def only(which: str) -> Column:
        return F.max(F.when(F.col("_side") == which, F.col("_row")))

    pairs = ranked.groupBy(*keys, (F.col("_side") == "both").alias("_both"), "_rank").agg(
        F.coalesce(only("stored"), only("both")).alias("_old"), F.coalesce(only("fresh"), only("both")).alias("_new")
    )
    old, new = F.col("_old"), F.col("_new")
    differing = [F.when(~old[c].eqNullSafe(new[c]), c) for c in values]
    change = F.when(F.col("_both"), "repeated").when(new.isNull(), "removed").when(old.isNull(), "added").otherwise("changed")
    return pairs.select(
        *keys,
        change.alias("change"),
        F.when(old.isNotNull() & new.isNotNull(), F.concat_ws(",", *differing)).otherwise("").alias("columns"),
        F.coalesce(old["n_stored"], F.lit(0)).cast("bigint").alias("n_stored"),
        F.coalesce(new["n_fresh"], F.lit(0)).cast("bigint").alias("n_fresh"),
    )


def item_trace(df: DataFrame, codes: DataFrame | Iterable[str], key: str = "ItemCode", codes_rows: int | None = None) -> DataFrame:
    """The rows of a stage for chosen items.

    ``codes`` is either a list of codes (a spot check) or a DataFrame with a
    ``key`` column (e.g. the keys a duplicate audit found), semi-joined.
    """
    if isinstance(codes, DataFrame):
        k = codes.select(key).distinct()
        return df.join(bounded_broadcast(k, codes_rows), key, "left_semi")
    return df.filter(F.col(key).isin(list(codes)))


def family_fanout(reorderables: DataFrame, family: DataFrame) -> DataFrame:
    """Report codes held by more than one reorderable item (the join
    the debug script flags as replicating rows), with the number of
    reorderable rows and of item rows the family expansion produced."""
    shared = duplicate_keys(reorderables, ["ReportItemCode"]).withColumnRenamed("n_rows", "reorderable_rows")
    fam = family.groupBy("ReportItemCode").agg(F.sum("n").alias("family_rows"))
    return shared.join(fam, "ReportItemCode", "left").select(
        "ReportItemCode", "reorderable_rows", F.coalesce(F.col("family_rows"), F.lit(0)).cast("bigint").alias("family_rows")
    )
