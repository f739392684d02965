"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from tillroll.functions.codes import key7, key20, not_blank, pick_isbn
from tillroll.functions.money import (
    MONEY,
    money,
    money_div,
    ratio_pct_text,
    money_pct_text,
    to_int,
)
from tillroll.functions.text import (
    date_text_or_na,
    mmddyyyy,
    no_receipt_date,
    store_label,
    vendor_label,
)

__all__ = [
    "MONEY",
    "date_text_or_na",
    "key7",
    "key20",
    "mmddyyyy",
    "money",
    "money_div",
    "money_pct_text",
    "no_receipt_date",
    "not_blank",
    "pick_isbn",
    "ratio_pct_text",
    "store_label",
    "to_int",
    "vendor_label",
]
