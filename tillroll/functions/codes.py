"""Item-code helpers.

Item codes come in two widths: a 20-character zero-padded master code and
its last seven characters (the short code the reports key on).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.fixed import CODE_WIDTH, SHORT_CODE_WIDTH

_ZEROS = "0" * CODE_WIDTH


def key20(c: Column) -> Column:
    """Zero-pad to 20 keeping the *rightmost* 20 characters; NULL stays NULL.

    Not ``lpad``: ``lpad`` keeps the leftmost 20 of a longer value.
    """
    return F.right(F.concat(F.lit(_ZEROS), c), F.lit(CODE_WIDTH))


def key7(c: Column) -> Column:
    """Short item code: the last seven characters."""
    return F.right(c, F.lit(SHORT_CODE_WIDTH))


def not_blank(c: Column) -> Column:
    """True when the value has a non-space character (NULL counts as blank)."""
    return F.coalesce(F.trim(c), F.lit("")) != F.lit("")


def pick_isbn(isbn: Column, upc: Column) -> Column:
    """The product's ISBN when it is not blank, else its UPC."""
    return F.when(not_blank(isbn), isbn).otherwise(upc)
