"""Order as data: the position of each row in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW_BITS = 33  # as in monotonically_increasing_id: the range's number above, the row in it below


def with_position(df: DataFrame, order: list[str], stage, name: str = "position") -> DataFrame:
    """``df`` and each row's position (from 1) by ``order`` (ascending, NULLs first).

    Rows are dealt by ranges of the order, sorted and numbered within each
    range, and written with ``stage`` (which returns the table and its row
    count), so that numbers and ranges stay as they are.  A row's position is its
    number plus the rows of the ranges before it: one count for each range
    (as many as shuffle partitions) goes through the driver, and no row does.  Rows
    that agree in ``order`` take neighbouring positions.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered, _ = stage(ranged.withColumn("_id", F.monotonically_increasing_id()), name)
    part = F.shiftright("_id", _ROW_BITS)
    counts = sorted((r["part"], r["count"]) for r in numbered.groupBy(part.alias("part")).count().collect())
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    spark = df.sparkSession
    starts = spark.createDataFrame(offsets, "_part long, _before long")
    row = F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*df.columns, (F.col("_before") + row + 1).cast("bigint").alias(name))
    )
