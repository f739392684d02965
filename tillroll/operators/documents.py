"""Header-line joins that hold when one document has a third of all lines.

The feeds (receipts, legacy receipts, transfers, wholesale orders) sum lines per
item, but only lines whose document has a header that counts; what a header
adds is a date and how often it stands there.  Dealt by document, a hot one's
lines would all be one task's.  So the lines are split:

* the documents with the most lines come from a frequent-items sketch over all
  lines (one small row a task, then merged).  It holds every document with more than
  about 1 / ``TRACKED`` of the lines, and names ``HOT_PER_PARTITION`` documents for each shuffle
  partition.  Their headers, one row each, are broadcast: at most that number.
  Their lines stay where they are and are summed per item map-side;
* all other lines meet their headers by an ordinary join; none of their documents
  is large enough to unbalance it.

The sketch only chooses the side a line takes: any choice gives the same sums.  Sketch and sides each read
the lines: a job has them written once, cut to the items, so that the line table is scanned and its codes are
folded once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tillroll.operators.bitmap_cut import cut_by_bitmap

HOT_PER_PARTITION = 4
TRACKED = 100_000
TIMES = "_times"


def times(total: Column, n: Column) -> Column:
    """``total * n`` without a lost digit for sums of scale 19, which a plain decimal product would round:
    the whole and the broken part are multiplied apart."""
    whole = F.when(total >= 0, F.floor(total)).otherwise(F.ceil(total))
    part = (total % F.lit(Decimal(1))).cast("decimal(20,19)") * n.cast("decimal(10,0)")
    return ((whole * n).cast("decimal(37,19)") + part.cast("decimal(37,19)")).cast("decimal(38,19)")


def _with_header(lines: DataFrame, heads: DataFrame, document: str) -> DataFrame:
    """The lines without most of those whose document has no header that counts (by a bitmap; ids stored in types
    that it can't compare stay as they are)."""
    ours, theirs = lines.schema[document].dataType, heads.schema[document].dataType
    if ours != theirs and not (isinstance(ours, IntegralType) and isinstance(theirs, IntegralType)):
        return lines
    return cut_by_bitmap(lines, heads.select(document), [document])


def meet_headers(lines: DataFrame, headers: DataFrame, document: str, date: str | None = None, stage=None) -> DataFrame:
    """``lines`` whose document has a header row, with ``_times`` (a line's sums count so often) and, if
    ``date`` names a header column, ``_date`` (the earliest for the line).  A document's header rows all
    count, so a line may come several times with ``_times`` 1 or once with their number.  ``stage`` writes
    the lines once, without most of those that have no such header: the sketch and both sides read them."""
    spark = lines.sparkSession
    k = min(TRACKED // 2, HOT_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    heads = headers.filter(F.col(document).isNotNull())
    heads = heads.select(document, *([F.col(date).alias("_date")] if date else []))
    if stage is not None:
        lines, _ = stage(_with_header(lines, heads, document))
    lines = lines.filter(F.col(document).isNotNull())
    top = lines.agg(F.expr(f"approx_top_k(`{document}`, {k}, {TRACKED})").alias("_top"))
    hot = top.select(F.explode("_top").alias("_x")).select(F.col("_x.item").alias(document))
    dates = [F.min("_date").alias("_date")] if date else []
    hot_heads = heads.join(F.broadcast(hot), document, "left_semi").groupBy(document).agg(
        F.count(F.lit(1)).alias(TIMES), *dates
    )  # at most k rows
    rest = lines.join(F.broadcast(hot), document, "left_anti").join(
        heads.withColumn(TIMES, F.lit(1).cast("bigint")), document
    )
    return lines.join(F.broadcast(hot_heads), document).unionByName(rest)
