"""Cutting a large table to the keys of another one, with one plan at every size.

The keys' hashes set bits in a bitmap, built by one aggregate: words of 64 bits,
combined map-side; only words with a bit set are rows.  The bitmap has at most
2**bits / 64 rows whatever the tables hold (a million by default, some 50 MB, and no more
than one for each key), so it can always be broadcast, and the large table is cut in its scan stage by integer arithmetic: rows
that can't match are never exchanged.  A few rows whose hashes collide pass, so
a join on the keys has to follow; with many more keys than bits more rows
pass, but none is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BITS = 26
CONF_BITS = "tillroll.bitmapCut.bits"


def cut_by_bitmap(rows: DataFrame, keys: DataFrame, columns: list[str], n_keys: int | None = None, bits: int | None = None) -> DataFrame:
    """The rows whose ``columns`` may be among those of ``keys``: all that are, and few others.

    The bitmap has 2**``bits`` bits (default ``tillroll.bitmapCut.bits``, else 26); with ``n_keys``,
    the number of keys where a stage has counted them, no more than 32 bits for each.
    Whole numbers of different widths are compared as text; other types must agree.
    """
    wide = []
    for c in columns:
        ours, theirs = rows.schema[c].dataType, keys.schema[c].dataType
        if ours != theirs and not (isinstance(ours, IntegralType) and isinstance(theirs, IntegralType)):
            raise TypeError(f"{c} is {ours.simpleString()} on one side and {theirs.simpleString()} on the other")
        wide.append(F.col(c) if ours == theirs else F.col(c).cast("string"))
    bits = bits or int(rows.sparkSession.conf.get(CONF_BITS, str(BITS)))
    if n_keys is not None:
        bits = min(bits, max(15, (32 * n_keys).bit_length()))
    # a mask, not pmod: never NULL, so that no not-null test of the hashed columns is made in the scan, where Spark
    # would write each column's whole expression out again, several times for a code folded in the plan
    place = F.xxhash64(*wide).bitwiseAND(F.lit((1 << bits) - 1))
    bit = "shiftleft(1L, cast(_place % 64 AS int))"
    marks = (
        keys.select(place.alias("_place"))
        .groupBy(F.shiftright("_place", 6).alias("_word"))
        .agg(F.bit_or(F.expr(bit)).alias("_bits"))
    )
    return (
        rows.withColumn("_place", place)
        .withColumn("_word", F.shiftright("_place", 6))
        .join(F.broadcast(marks), "_word")
        .filter(F.expr(f"(_bits & {bit}) <> 0"))
        .select(*rows.columns)
    )
