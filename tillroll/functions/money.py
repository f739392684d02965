"""Money and number formatting with the reference's fixed-point rules.

Money is ``decimal(19,4)``.  Aggregates widen decimals (``sum`` adds ten
digits), so results are cast back after each aggregate.  Casts to ``int``
truncate toward zero, as numeric-to-int conversion does in the reference.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.fixed import PERCENT_SUFFIX

MONEY = "decimal(19,4)"

# Rounding of the fifth decimal in a money division is not visible in the
# reference; HALF_UP is the default and "truncate" is the alternative.
_DIV_MODES = ("half_up", "truncate")


def money(c: Column) -> Column:
    return c.cast(MONEY)


def to_int(c: Column) -> Column:
    """Numeric to int, truncating toward zero; overflow raises (ANSI)."""
    return c.cast("int")


def money_div(a: Column, b: Column, mode: str = "half_up") -> Column:
    """``money / money`` kept to four decimals."""
    if mode not in _DIV_MODES:
        raise ValueError(f"mode must be one of {_DIV_MODES}")
    q = a.cast(MONEY) / b.cast(MONEY)
    if mode == "half_up":
        return q.cast(MONEY)
    scaled = q * F.lit(Decimal("10000"))
    cut = F.when(scaled >= 0, F.floor(scaled)).otherwise(F.ceil(scaled))
    return (cut.cast("decimal(38,0)") / F.lit(Decimal("10000"))).cast(MONEY)


def money_pct_text(num: Column, den: Column, guard: Column, mode: str = "half_up") -> Column:
    """Percent text of a money ratio: ``0`` under ``guard``, else
    ``(num / den) * 100`` in money, shown with two decimals and ``' %'``."""
    pct = F.when(guard, F.lit(Decimal("0")).cast(MONEY)).otherwise(
        money(money_div(num, den, mode) * F.lit(Decimal("100")))
    )
    return F.concat(pct.cast("decimal(19,2)").cast("string"), F.lit(PERCENT_SUFFIX))


def ratio_pct_text(num: Column, den: Column, guard: Column) -> Column:
    """Percent text of a count ratio: both sides as ``decimal(18,0)``
    (rounded), quotient times 100 as ``decimal(8,4)``, then ``' %'``.
    A value of 10000 % or more overflows ``decimal(8,4)`` and raises."""
    q = num.cast("decimal(18,0)") / den.cast("decimal(18,0)")
    pct = F.when(guard, F.lit(Decimal("0"))).otherwise(q * F.lit(Decimal("100")))
    return F.concat(pct.cast("decimal(8,4)").cast("string"), F.lit(PERCENT_SUFFIX))
