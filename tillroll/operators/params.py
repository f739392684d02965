"""Parameter handling shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_datetime(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))


def ts_literal(v) -> Column:
    """A wall-clock timestamp literal (TIMESTAMP_NTZ, no time-zone shift)."""
    return F.lit(as_datetime(v).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def one_year_before(v) -> dt.datetime:
    """Same wall-clock time one year earlier; 29 February maps to the 28th."""
    t = as_datetime(v)
    try:
        return t.replace(year=t.year - 1)
    except ValueError:
        return t.replace(year=t.year - 1, day=28)


def char_param(v: str | None, width: int) -> str | None:
    """A ``char(n)`` argument: cut to ``width``; trailing blanks do not count."""
    return None if v is None else str(v)[:width].rstrip()


def varchar_param(v: str | None, width: int) -> str | None:
    """A ``varchar(n)`` argument: a longer value is cut to ``width``."""
    return None if v is None else str(v)[:width]
