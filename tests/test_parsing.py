"""Hand-written rows for every parsing and cleaning rule (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillsight.functions.parsing import parse_invoice_timestamp, parse_price, parse_quantity
from tillsight.operators.prepare import cleaned_sales, typed_sales


def _one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("12", 12),
        ("12.7", 12),  # legacy cast truncates
        ("-3", -3),
        ("+5", 5),
        ("12.", 12),
        (".5", 0),
        ("1e3", None),
        ("abc", None),
        ("", None),
        ("+", None),
        ("2147483647", 2147483647),
        ("2147483648", None),  # overflow
        ("\t7", 7),  # control bytes around the number are ignored
    ],
)
def test_quantity_legacy_cast(spark, text, expected):
    assert _one(spark, parse_quantity, text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2,55", 2.55),
        (",5", 0.5),
        ("1.234,50", None),  # all commas replaced -> two dots -> NULL
        ("N/A", None),
        ("NaN", None),
        ("0", 0.0),
        ("3.14159", 3.14159),
        ("0,00004", 0.00004),
        ("1e30", 1e30),
        ("5d", None),
        ("0x1p3", None),
        ("Infinity", None),
        ("1e999", None),
    ],
)
def test_price_decimal_comma(spark, text, expected):
    assert _one(spark, parse_price, text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("01/12/2010 08:26", dt.datetime(2010, 12, 1, 8, 26)),
        ("01/12/2010 8:26", None),
        ("1/12/2010 08:26", None),
        ("31/02/2011 08:26", None),
        ("01/12/2010 08:26:00", None),
    ],
)
def test_invoice_timestamp(spark, text, expected):
    assert _one(spark, parse_invoice_timestamp, text) == expected


def test_typing_and_cleaning_rules(raw_frame):
    rows = [
        # id, StockCode, Description, Quantity, Date, Price, Customer, Country
        ("1", "A", "ok", "2", "01/12/2010 08:26", "1,50", "10", "UK"),
        ("2", "A", "\t", "2", "01/12/2010 08:26", "1,50", "10", "UK"),  # tab kept
        ("3", "A", "   ", "2", "01/12/2010 08:26", "1,50", "10", "UK"),  # blank
        ("4", "A", None, "2", "01/12/2010 08:26", "1,50", "10", "UK"),
        ("5", "A", "ok", "2", "01/12/2010 08:26", "1,50", "  ", "UK"),  # blank customer
        ("6", "A", "ok", "0", "01/12/2010 08:26", "1,50", "10", "UK"),
        ("7", "A", "ok", "2", "01/12/2010 08:26", "0", "10", "UK"),
        ("C8", "A", "ok", "2", "01/12/2010 08:26", "1,50", "10", "UK"),  # cancelled
        ("c9", "A", "ok", "2", "01/12/2010 08:26", "1,50", "10", "UK"),  # lower case: kept
        (None, "A", "ok", "2", "01/12/2010 08:26", "1,50", "10", "UK"),  # NULL flag: dropped
        ("11", "A", "ok", "2", "31/02/2011 08:26", "1,50", "10", None),  # NULL date kept
        ("12", "A", "ok", "12.7", "01/12/2010 08:26", "2,555", "10", "UK"),
        ("13", "A", "ok", "1", "01/12/2010 08:26", "1,005", "10", "UK"),  # HALF_UP cent
    ]
    typed = typed_sales(raw_frame(rows))
    cleaned = {r["InvoiceNo"]: r for r in cleaned_sales(typed).collect()}
    assert sorted(cleaned) == ["1", "11", "12", "13", "2", "c9"]
    assert cleaned["13"]["Revenue"] == Decimal("1.01")
    assert cleaned["2"]["Description"] == "\t"
    assert cleaned["11"]["InvoiceDate"] is None and cleaned["11"]["YearMonth"] is None
    assert cleaned["11"]["Hour"] is None and cleaned["11"]["Country"] is None
    assert cleaned["12"]["Quantity"] == 12
    # 12 x 2.555 = 30.66 exactly HALF_UP
    assert cleaned["12"]["Revenue"] == Decimal("30.66")
    r1 = cleaned["1"]
    assert (r1["YearMonth"], r1["DayOfWeek"], r1["Hour"], r1["Year"], r1["Month"]) == (
        "2010-12", "Wednesday", 8, 2010, 12,
    )
    assert r1["InvoiceDateOnly"] == dt.date(2010, 12, 1)
    flags = {r["InvoiceNo"]: r["IsCancelled"] for r in typed.collect()}
    assert flags["C8"] is True and flags["c9"] is False and flags[None] is None


def test_trim_only_spaces(raw_frame):
    typed = typed_sales(raw_frame([(" 1 ", " A ", " x\t", " 3 ", " 01/12/2010 08:26 ", " 1,5 ", " 7 ", " UK ")]))
    r = typed.first()
    assert (r["InvoiceNo"], r["StockCode"], r["Description"], r["CustomerID"], r["Country"]) == (
        "1", "A", "x\t", "7", "UK",
    )
    assert r["Quantity"] == 3 and r["UnitPrice"] == Decimal("1.5000")


@pytest.mark.parametrize(
    "quantity, price, revenue",
    [
        ("100000", "0,00004", "4.00"),
        ("100000", "0,00005", "5.00"),
        ("100000", "1,23456", "123456.00"),
        ("1", "0,005", "0.01"),
        ("3", "0,335", "1.01"),  # 1.005 exactly, HALF_UP
        ("2", "100000000000000", "200000000000000.00"),
        ("1", "123456789012345678901", "123456789012345680000.00"),  # beyond the decimal: as a double
        ("4", "0,12345678901234", "0.49"),  # more decimals than it holds
        ("2147483647", "9999999999999,99", "21474836469999978525163.53"),
        ("1", "0,0000001", "0.00"),
    ],
)
def test_prices_are_neither_rounded_nor_dropped(raw_frame, quantity, price, revenue):
    row = ("1", "A", "ok", quantity, "01/12/2010 08:26", price, "10", "UK")
    got = cleaned_sales(typed_sales(raw_frame([row]))).collect()
    assert len(got) == 1 and got[0]["Revenue"] == Decimal(revenue)
    assert got[0]["UnitPrice"] == float(price.replace(",", "."))
