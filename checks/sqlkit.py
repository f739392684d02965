"""Assembling oracle SQL: stand-in views as CTEs, plus exact decimal helpers.

DuckDB divides decimals in DOUBLE; the Spark jobs divide in DECIMAL and
round HALF_UP.  ``div_half_up`` reproduces the exact rounding with integer
arithmetic so the oracle does not depend on binary floating point.
"""

from __future__ import annotations

import re

from tillroll.sources.standins import STANDIN_SQL, duckdb_standin_sql


def with_standins(body: str) -> str:
    """Prefix ``body`` with the stand-in views it names, as CTEs.

    ``body`` may itself start with ``WITH``; its CTEs follow the stand-ins.
    """
    used = [n for n in STANDIN_SQL if re.search(rf"\b{n}\b", body)]
    ctes = ",\n".join(f"{n} AS (\n{duckdb_standin_sql(n).strip()}\n)" for n in used)
    text = body.strip()
    if not ctes:
        return text
    if text[:4].upper() == "WITH":
        return f"WITH {ctes},\n{text[4:].lstrip()}"
    return f"WITH {ctes}\n{text}"


def _scaled_int(expr: str, scale: int) -> str:
    return f"CAST(({expr}) * {10 ** scale} AS HUGEINT)"


def div_half_up(num: str, den: str, num_scale: int, den_scale: int, out_scale: int, precision: int = 38) -> str:
    """``num / den`` rounded HALF_UP (away from zero) to ``out_scale``.

    ``num``/``den`` are exact decimals with at most ``num_scale``/``den_scale``
    decimals.  NULL when either side is NULL or the divisor is zero.
    """
    a = _scaled_int(num, num_scale)
    b = _scaled_int(den, den_scale)
    e = out_scale + den_scale - num_scale
    top = f"({a}) * {10 ** e}" if e >= 0 else f"({a})"
    bot = f"({b})" if e >= 0 else f"({b}) * {10 ** (-e)}"
    q = (
        f"(CASE WHEN ({b}) = 0 THEN NULL ELSE sign({a}) * sign({b}) * "
        f"((2 * abs({top}) + abs({bot})) // (2 * abs({bot}))) END)"
    )
    unit = "0." + "0" * (out_scale - 1) + "1" if out_scale > 0 else "1"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST({unit} AS DECIMAL({max(out_scale, 1)},{out_scale})) AS DECIMAL({precision},{out_scale}))"
