"""Viewer and chart feeds re-aimed as Spark operators.

The original computed these in Python/pandas over exported CSV files.  Here
they are post-aggregation DataFrame steps; every whole-frame window runs over
an already aggregated (bounded) table, never over line-grain rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.formatting import (
    integer_text,
    millions_label,
    money_text,
    percent_text,
    thousands_label,
)
from tillsight.functions.rounding import count_percent, percent

TOP_N = 10
LABEL_LENGTH = 34

# Fixed display labels of the KPI viewer page, in display order.
KPI_DISPLAY = (
    ("Total Revenue", "TotalRevenue", "money"),
    ("Total Orders", "TotalOrders", "integer"),
    ("Total Quantity Sold", "TotalQuantitySold", "integer"),
    ("Total Customers", "TotalCustomers", "integer"),
    ("Total Products", "TotalProducts", "integer"),
    ("Total Countries", "TotalCountries", "integer"),
    ("Average Order Value", "AverageOrderValue", "money"),
    ("Average Revenue Per Customer", "AverageRevenuePerCustomer", "money"),
    ("Cancelled Orders", "CancelledOrders", "integer"),
    ("Total Raw Invoices", "TotalRawInvoices", "integer"),
    ("Cancellation Rate", "CancellationRatePercent", "percent"),
)

_FORMATTERS = {"money": money_text, "integer": integer_text, "percent": percent_text}


def top_hours_by_revenue(hourly: DataFrame, n: int = TOP_N) -> DataFrame:
    """V1: hourly table re-sorted by revenue, first n (Hour breaks ties)."""
    return hourly.orderBy(F.desc("HourlyRevenue"), F.asc("Hour")).limit(n)


def market_share_chart(markets: DataFrame) -> DataFrame:
    """V2: each market's percent of total revenue, 1 decimal."""
    total = F.sum("MarketRevenue").over(Window.partitionBy())
    return markets.select(
        "Market", "MarketRevenue", percent(F.col("MarketRevenue"), total, 1).alias("SharePercent")
    )


def customer_segment_share_chart(segments: DataFrame) -> DataFrame:
    """V3: each segment's percent of customers, 1 decimal."""
    total = F.sum("CustomerCount").over(Window.partitionBy())
    return segments.select(
        "CustomerSegment",
        "CustomerCount",
        count_percent(F.col("CustomerCount"), total, 1).alias("SharePercent"),
    )


def top_products_chart(top_by_revenue: DataFrame) -> DataFrame:
    """V4: top products ascending, label = first 34 characters of Description."""
    return top_by_revenue.orderBy(F.asc("ProductRevenue"), F.desc("StockCode")).select(
        F.substring("Description", 1, LABEL_LENGTH).alias("Label"), "ProductRevenue"
    )


def top_countries_chart(top_countries: DataFrame) -> DataFrame:
    """V5: top countries ascending by revenue."""
    return top_countries.orderBy(F.asc("CountryRevenue"), F.desc("Country")).select(
        "Country", "CountryRevenue"
    )


def monthly_revenue_chart(monthly: DataFrame) -> DataFrame:
    """V6: 0-based position along the month axis (NULL month first)."""
    position = F.row_number().over(Window.orderBy(F.asc("YearMonth"))) - 1
    return monthly.select(position.alias("Position"), "YearMonth", "MonthlyRevenue")


def weekday_revenue_chart(weekday: DataFrame) -> DataFrame:
    """V7a."""
    return weekday.select("DayOfWeek", "WeekdayRevenue")


def hourly_orders_chart(hourly: DataFrame) -> DataFrame:
    """V7b."""
    return hourly.select("Hour", "HourlyOrders")


def formatted_kpis(kpis: DataFrame) -> DataFrame:
    """V8: the eleven KPI display lines (Metric, DisplayValue)."""
    entries = [
        F.struct(F.lit(label).alias("Metric"), _FORMATTERS[kind](F.col(col)).alias("DisplayValue"))
        for label, col, kind in KPI_DISPLAY
    ]
    return kpis.select(F.inline(F.array(*entries)))


def scaled_revenue_labels(monthly: DataFrame) -> DataFrame:
    """V9: month axis labels in millions ('$1.2M')."""
    return monthly.select("YearMonth", millions_label(F.col("MonthlyRevenue")).alias("RevenueLabel"))


def scaled_chart_labels(weekday: DataFrame, products: DataFrame, countries: DataFrame) -> DataFrame:
    """V9: axis labels of the weekday and country charts in millions, of the product
    chart in thousands ('$168K')."""
    feeds = (
        ("weekday", weekday, "DayOfWeek", millions_label(F.col("WeekdayRevenue"))),
        ("product", products, "Description", thousands_label(F.col("ProductRevenue"))),
        ("country", countries, "Country", millions_label(F.col("CountryRevenue"))),
    )
    rows = [
        table.select(F.lit(chart).alias("Chart"), F.col(label).alias("Label"), value.alias("RevenueLabel"))
        for chart, table, label, value in feeds
    ]
    return reduce(DataFrame.unionByName, rows)
