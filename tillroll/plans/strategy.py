"""Join strategy: broadcast a side only under a checked row bound.

The reports join huge fact tables (receipts, register sales, shipments) to
small sets (tracked items, stores, vendors).  Broadcasting the small side
avoids shuffling the facts, but only a side whose size is *checked* may be
broadcast: ``bounded_broadcast`` counts at most ``limit + 1`` rows and falls
back to a plain (shuffle) join above the bound, where AQE can still switch to
a broadcast at run time or split skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default row bound for an explicit broadcast; a session may override it
# with the conf key below.  A million short keys is a few tens of MB.
DEFAULT_BROADCAST_ROWS = 1_000_000
CONF_BROADCAST_ROWS = "tillroll.broadcast.maxRows"


def broadcast_row_limit(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get(CONF_BROADCAST_ROWS, str(DEFAULT_BROADCAST_ROWS)))


def fits_broadcast(df: DataFrame, rows: int | None = None, limit: int | None = None) -> bool:
    """True when ``df`` has at most ``limit`` rows (counted, bounded)."""
    limit = broadcast_row_limit(df) if limit is None else limit
    if rows is None:
        rows = df.limit(limit + 1).count()
    return rows <= limit


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is never broadcast, whatever its size is taken for: attribute rows, which
    grow with the items, are joined by an exchange at every size and don't pass the driver."""
    return df.hint("merge")


def semi_join(rows: DataFrame, keys: DataFrame, column: str, broadcast: bool) -> DataFrame:
    """``rows`` whose ``column`` is among the distinct values of ``keys`` (NULL never is), as ``left_semi`` gives;
    ``broadcast`` hints that they fit.

    The comparison is null-safe over keys without NULL: from a plain one Spark infers that ``column`` is not NULL
    and tests that in the scan, writing the column's whole expression out again there.  For a code that is folded
    in the plan this costs more than the fold itself.
    """
    known = keys.select(F.col(column).alias("_known")).filter(F.col("_known").isNotNull())
    return rows.join(F.broadcast(known) if broadcast else known, F.col(column).eqNullSafe(F.col("_known")), "left_semi")


def bounded_broadcast(df: DataFrame, rows: int | None = None, limit: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its row count is within the bound, else ``df``.

    Pass ``rows`` when the count is already known (e.g. a checkpointed stage)
    to avoid a second job.
    """
    return F.broadcast(df) if fits_broadcast(df, rows, limit) else df
