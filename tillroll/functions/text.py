"""Date and label text helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.fixed import (
    LABEL_SEPARATOR,
    LOCATION_NAME_WIDTH,
    LOCATION_NO_WIDTH,
    NO_DATE_TEXT,
    NO_VENDOR_TEXT,
    SENTINEL_DATE as _SENTINEL,
    US_DATE_FORMAT,
)

SENTINEL_DATE = dt.date(*_SENTINEL)


def date_text_or_na(ts: Column) -> Column:
    """``yyyy-MM-dd`` of the date part, or ``'NA'`` when NULL."""
    return F.coalesce(F.to_date(ts).cast("string"), F.lit(NO_DATE_TEXT))


def no_receipt_date(ts: Column) -> Column:
    """True when the date is NULL *or* the 1900-01-01 sentinel."""
    d = F.lit(SENTINEL_DATE)
    return F.coalesce(F.to_date(ts), d) == d


def mmddyyyy(ts: Column) -> Column:
    """US date text, ``MM/dd/yyyy`` (sorts as text, not as a date)."""
    return F.date_format(ts, US_DATE_FORMAT)


def _fixed_char(c: Column, width: int) -> Column:
    """Blank-pad to a fixed width; a longer value is an error, not a cut."""
    return F.when(
        F.length(c) > width,
        F.raise_error(F.concat(F.lit(f"value longer than char({width}): "), c)),
    ).otherwise(F.rpad(c, width, " "))


def store_label(location_no: Column, name: Column) -> Column:
    """``char(5) + ' - ' + char(30)``: NULL if either part is NULL."""
    return F.concat(
        _fixed_char(location_no, LOCATION_NO_WIDTH), F.lit(LABEL_SEPARATOR), _fixed_char(name, LOCATION_NAME_WIDTH)
    )


def vendor_label(vendor_id: Column, name: Column) -> Column:
    """``vendor id - name`` with the no-detail default for a missing vendor."""
    return F.concat(
        F.coalesce(vendor_id, F.lit(NO_VENDOR_TEXT)),
        F.lit(LABEL_SEPARATOR),
        F.coalesce(name, F.lit("")),
    )
