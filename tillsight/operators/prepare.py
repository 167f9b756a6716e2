"""Typing and cleaning of invoice lines.

``typed_sales`` and ``cleaned_sales`` are lazy projections/filters: Catalyst
merges the five cleaning predicates into one ``Filter`` and prunes unused
columns down to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.parsing import (
    is_cancelled_invoice,
    parse_invoice_timestamp,
    parse_price,
    parse_quantity,
    trim_spaces,
)
from tillsight.functions.rounding import line_revenue

TYPED_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
    "IsCancelled",
)

DERIVED_COLUMNS = (
    "Revenue",
    "InvoiceDateOnly",
    "Year",
    "Month",
    "YearMonth",
    "DayOfWeek",
    "Hour",
)

# Fixed calendar formats of the original job.
YEAR_MONTH_PATTERN = "yyyy-MM"
DAY_NAME_PATTERN = "EEEE"


def typed_sales(raw: DataFrame) -> DataFrame:
    """Trim all eight columns, parse Quantity/InvoiceDate/UnitPrice, flag cancels."""
    t = {name: trim_spaces(F.col(name)) for name in (
        "InvoiceNo", "StockCode", "Description", "Quantity",
        "InvoiceDate", "UnitPrice", "CustomerID", "Country",
    )}
    return raw.select(
        t["InvoiceNo"].alias("InvoiceNo"),
        t["StockCode"].alias("StockCode"),
        t["Description"].alias("Description"),
        parse_quantity(t["Quantity"]).alias("Quantity"),
        parse_invoice_timestamp(t["InvoiceDate"]).alias("InvoiceDate"),
        parse_price(t["UnitPrice"]).alias("UnitPrice"),
        t["CustomerID"].alias("CustomerID"),
        t["Country"].alias("Country"),
        is_cancelled_invoice(t["InvoiceNo"]).alias("IsCancelled"),
    )


def is_blank(c: Column) -> Column:
    """NULL, or empty after trimming spaces."""
    return c.isNull() | (F.trim(c) == "")


def is_present(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def cleaning_condition() -> Column:
    """The five cleaning rules, ANDed. A NULL cancel flag drops the row."""
    return (
        is_present(F.col("Description"))
        & is_present(F.col("CustomerID"))
        & (F.col("Quantity").isNotNull() & (F.col("Quantity") > 0))
        & (F.col("UnitPrice").isNotNull() & (F.col("UnitPrice") > 0))
        & ~F.col("IsCancelled")
    )


def calendar_columns(ts: Column) -> dict[str, Column]:
    """T3 calendar fields; all NULL when the timestamp is NULL."""
    return {
        "InvoiceDateOnly": F.to_date(ts),
        "Year": F.year(ts),
        "Month": F.month(ts),
        "YearMonth": F.date_format(ts, YEAR_MONTH_PATTERN),
        "DayOfWeek": F.date_format(ts, DAY_NAME_PATTERN),
        "Hour": F.hour(ts),
    }


def cleaned_sales(typed: DataFrame) -> DataFrame:
    """T2 + T3: regular sales lines with revenue and calendar fields."""
    ts = F.col("InvoiceDate")
    return typed.filter(cleaning_condition()).withColumns(
        {"Revenue": line_revenue(F.col("Quantity"), F.col("UnitPrice")), **calendar_columns(ts)}
    )


def cancelled_lines(typed: DataFrame) -> DataFrame:
    """T4: lines of cancelled invoices (NULL flag excluded)."""
    return typed.filter(F.col("IsCancelled"))
