"""Scalar helpers against the reference's string, money and date rules."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.functions import (
    date_text_or_na,
    key7,
    key20,
    mmddyyyy,
    money_div,
    money_pct_text,
    no_receipt_date,
    not_blank,
    pick_isbn,
    ratio_pct_text,
    store_label,
    vendor_label,
)
from tillroll.operators.params import char_param, one_year_before, varchar_param


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_key20_keeps_rightmost_and_null(spark):
    df = spark.createDataFrame([("1503026",), ("",), (None,), ("ABCDEFGHIJKLMNOPQRSTUVW",)], "c string")
    got = [r.v for r in df.select(key20(F.col("c")).alias("v")).collect()]
    assert got == ["00000000000001503026", "00000000000000000000", None, "DEFGHIJKLMNOPQRSTUVW"]


def test_key7_short_code(spark):
    assert one(spark, key7(F.col("c")), "c string", ("00000000000001503026",)) == "1503026"
    assert one(spark, key7(F.col("c")), "c string", ("12",)) == "12"


def test_not_blank_and_isbn(spark):
    df = spark.createDataFrame([("  ", "U1"), (None, "U2"), ("978", "U3")], "isbn string, upc string")
    got = [r.v for r in df.select(pick_isbn(F.col("isbn"), F.col("upc")).alias("v")).collect()]
    assert got == ["U1", "U2", "978"]
    assert one(spark, not_blank(F.col("c")), "c string", (None,)) is False


def test_money_div_half_up_and_truncate(spark):
    row = (Decimal("2"), Decimal("3"))
    schema = "a decimal(19,4), b decimal(19,4)"
    assert one(spark, money_div(F.col("a"), F.col("b")), schema, row) == Decimal("0.6667")
    assert one(spark, money_div(F.col("a"), F.col("b"), "truncate"), schema, row) == Decimal("0.6666")
    neg = (Decimal("-2"), Decimal("3"))
    assert one(spark, money_div(F.col("a"), F.col("b"), "truncate"), schema, neg) == Decimal("-0.6666")
    with pytest.raises(ValueError):
        money_div(F.col("a"), F.col("b"), "bankers")


def test_percent_texts(spark):
    schema = "num decimal(19,4), den decimal(19,4), g boolean"
    assert one(spark, money_pct_text(F.col("num"), F.col("den"), F.col("g")), schema, (Decimal(1), Decimal(3), False)) == "33.33 %"
    assert one(spark, money_pct_text(F.col("num"), F.col("den"), F.col("g")), schema, (Decimal(1), Decimal(3), True)) == "0.00 %"
    assert one(spark, money_pct_text(F.col("num"), F.col("den"), F.col("g")), schema, (Decimal(1), None, False)) is None
    schema2 = "md int, q decimal(38,5), g boolean"
    assert one(spark, ratio_pct_text(F.col("md"), F.col("q"), F.col("g")), schema2, (1, Decimal(3), False)) == "33.3333 %"
    assert one(spark, ratio_pct_text(F.col("md"), F.col("q"), F.col("g")), schema2, (0, Decimal(0), True)) == "0.0000 %"


def test_received_date_sentinel(spark):
    df = spark.createDataFrame(
        [(None,), (dt.datetime(1900, 1, 1),), (dt.datetime(2014, 3, 12, 10, 0),)], "d timestamp_ntz"
    )
    rows = df.select(date_text_or_na(F.col("d")).alias("t"), no_receipt_date(F.col("d")).alias("nd")).collect()
    assert [(r.t, r.nd) for r in rows] == [("NA", True), ("1900-01-01", True), ("2014-03-12", False)]


def test_us_date_text(spark):
    assert one(spark, mmddyyyy(F.col("d")), "d timestamp_ntz", (dt.datetime(2014, 12, 31, 23, 59),)) == "12/31/2014"


def test_labels(spark):
    got = one(spark, store_label(F.col("n"), F.col("m")), "n string, m string", ("00012", "Dallas"))
    assert got == "00012 - Dallas" + " " * 24
    assert one(spark, store_label(F.col("n"), F.col("m")), "n string, m string", ("00012", None)) is None
    with pytest.raises(Exception):
        one(spark, store_label(F.col("n"), F.col("m")), "n string, m string", ("00012", "x" * 31))
    schema = "v string, n string"
    assert one(spark, vendor_label(F.col("v"), F.col("n")), schema, ("V1", None)) == "V1 - "
    assert one(spark, vendor_label(F.col("v"), F.col("n")), schema, (None, None)) == "No Shipping Detail - "


def test_parameters():
    assert one_year_before(dt.datetime(2024, 2, 29, 8, 0)) == dt.datetime(2023, 2, 28, 8, 0)
    assert char_param("All Locations   ", 20) == "All Locations"
    assert varchar_param("IDCROWNPOI-EXTRA", 10) == "IDCROWNPOI"
