"""Item multiplicities for the fact roll-ups.

Joining facts to the item bag repeats each fact row once per item row with
the same code, so every *sum* is multiplied by that count while ``min``,
``max`` and averages are not.  Instead of joining facts to the bag, facts
are cut to the item codes (broadcast semi join when the key set is within
the row bound), summed per code with map-side partial aggregation -- a code
holding a third of all rows still ships one row per map task -- and the
sums are then scaled by the multiplicity.  ``fanout="unique"`` counts each
code once (the corrected reading of the duplicated-code audit).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import key20
from tillroll.operators.bitmap_cut import cut_by_bitmap
from tillroll.plans.strategy import dealt, fits_broadcast, semi_join

FANOUTS = ("reference", "unique")


@dataclass
class CodeKeys:
    """Short and padded item codes a fact table is cut to."""

    short: DataFrame  # ItemCode (7)
    small: bool  # within the broadcast bound

    def _b(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df

    def keys7(self, name: str = "ItemCode") -> DataFrame:
        return self._b(self.short.select(F.col("ItemCode").alias(name)))

    def keys20(self, name: str = "Code20") -> DataFrame:
        return self._b(self.short.select(key20(F.col("ItemCode")).alias(name)).distinct())

    def cut(self, lines: DataFrame, name: str, padded: bool = False) -> DataFrame:
        """The lines whose code ``name`` (short, or ``padded``) is among the keys: by a broadcast semi join, or, with
        more keys than may be broadcast, by a bitmap in the scan.  That lets a few lines of other codes pass:
        ``exact`` cuts what is summed of them.  No line is exchanged for its code."""
        keys = self._named(name, padded)
        return semi_join(lines, keys, name, True) if self.small else cut_by_bitmap(lines, keys, [name])

    def exact(self, sums: DataFrame, name: str, padded: bool = False) -> DataFrame:
        """Sums by code of lines that were ``cut``, without codes that are none of the keys."""
        return sums if self.small else semi_join(sums, self._named(name, padded), name, False)

    def _named(self, name: str, padded: bool) -> DataFrame:
        code = key20(F.col("ItemCode")) if padded else F.col("ItemCode")
        return self.short.select(code.alias(name)).filter(F.col(name).isNotNull()).distinct()


def code_keys(short_codes: DataFrame, rows: int | None = None) -> CodeKeys:
    """Keys from a DataFrame with a short ``ItemCode`` column; ``rows``
    bounds its size when known."""
    short = short_codes.select("ItemCode").distinct()
    return CodeKeys(short, fits_broadcast(short, rows))


@dataclass
class ItemWeights:
    by_code: DataFrame  # ItemCode, Code20, n, max_cost
    by_code_cost: DataFrame  # ItemCode, Code20, Cost, n
    small: bool  # the key set is within the broadcast bound

    @property
    def keys(self) -> CodeKeys:
        return CodeKeys(self.by_code.select("ItemCode"), self.small)

    def keys7(self, name: str = "ItemCode") -> DataFrame:
        return self.keys.keys7(name)

    def keys20(self, name: str = "Code20") -> DataFrame:
        return self.keys.keys20(name)

    def per_code(self) -> DataFrame:
        return dealt(self.by_code)

    def per_code_cost(self) -> DataFrame:
        return dealt(self.by_code_cost)


def item_weights(items: DataFrame, fanout: str = "reference", rows: int | None = None) -> ItemWeights:
    """Multiplicities from the weighted item set (``ItemCode``, ``Cost``, ``n``).

    ``rows`` is the item set's row count when known (it bounds the keys).
    """
    small = fits_broadcast(items.select("ItemCode"), rows)
    return _weights(items.select("ItemCode", "n", F.col("Cost").alias("max_cost")), items.select("ItemCode", "Cost", "n"), fanout, small)


def stage_weights(stages, fanout: str = "reference", rows: int | None = None) -> ItemWeights:
    """The same from the item steps (``ItemStages``), without expanding a family; ``rows`` bounds the codes."""
    per_code = stages.per_code()
    return _weights(per_code, stages.per_code_cost(), fanout, fits_broadcast(per_code.select("ItemCode"), rows))


def _weights(per_code: DataFrame, per_code_cost: DataFrame, fanout: str, small: bool) -> ItemWeights:
    if fanout not in FANOUTS:
        raise ValueError(f"fanout must be one of {FANOUTS}")
    w = F.sum("n") if fanout == "reference" else F.lit(1).cast("bigint")
    by_code = per_code.groupBy("ItemCode").agg(w.alias("n"), F.max("max_cost").alias("max_cost"))
    by_code = by_code.withColumn("Code20", key20(F.col("ItemCode")))
    by_cost = per_code_cost.groupBy("ItemCode", "Cost").agg(w.alias("n")).withColumn("Code20", key20(F.col("ItemCode")))
    return ItemWeights(by_code, by_cost, small)


def int_times(q: Column, n: Column) -> Column:
    """``trunc(q * n)`` as int, exact for any scale of ``q``.

    Spark keeps at most 38 digits, so ``decimal(38,19) * bigint`` would be
    rounded to 6 decimals before the truncation.  Splitting ``q`` into its
    integer and fractional parts keeps both products exact.
    """
    whole = F.when(q >= 0, F.floor(q)).otherwise(F.ceil(q))
    frac = (q % F.lit(Decimal(1))).cast("decimal(20,19)")  # q - whole would be rounded to 17 places
    part = frac * n.cast("decimal(10,0)")
    part_whole = F.when(part >= 0, F.floor(part)).otherwise(F.ceil(part))
    return (whole * n + part_whole).cast("int")
