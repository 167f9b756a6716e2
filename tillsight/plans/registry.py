"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query starts from the given test tables through the fixture adapter
(raw -> typed -> cleaned), so its work grows with the data.  Money is
published as double in the last projection of each query.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.parsing import (
    decimal_comma_to_dot,
    is_cancelled_invoice,
    parse_invoice_timestamp,
    parse_price,
    parse_quantity,
    trim_spaces,
)
from tillsight.functions.rounding import decimals_to_double, half_up_div, line_revenue
from tillsight.operators import quality as P
from tillsight.operators.markets import MarketRules
from tillsight.operators.prepare import (
    DAY_NAME_PATTERN,
    YEAR_MONTH_PATTERN,
    cancelled_lines,
    cleaned_sales,
    is_blank,
    is_present,
    typed_sales,
)
from tillsight.plans import export as X
from tillsight.plans.catalog import Params, SalesTables
from tillsight.sources.fixture import RAW_COLUMNS, raw_invoice_lines

Query = Callable[[SparkSession, str], DataFrame]

# The focus market of the test tables (FIXTURES.md §3).
FIXTURE_PARAMS = Params(market=MarketRules(focus_country="NATION_7", rest_label="Rest of World"))
STRICT_GROWTH = MarketRules(
    focus_country="NATION_7", rest_label="Rest of World", min_customers=60, min_orders=450
)


def fixture_tables(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> SalesTables:
    typed = typed_sales(raw_invoice_lines(spark, sf_dir))
    return SalesTables(typed, cleaned_sales(typed), params)


def _table(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_tables(spark, sf_dir).table(name)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_invoice_lines(spark, sf_dir)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_sales(_raw(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_sales(_typed(spark, sf_dir))


# ------------------------------------------------------------ scalar forms
def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F3 over every raw line."""
    return _raw(spark, sf_dir).select(
        *RAW_COLUMNS,
        trim_spaces(F.col("Description")).alias("TrimmedDescription"),
        decimal_comma_to_dot(trim_spaces(F.col("UnitPrice"))).alias("DottedUnitPrice"),
        is_cancelled_invoice(trim_spaces(F.col("InvoiceNo"))).alias("StartsWithC"),
    )


def numeric_parse_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4-F5 over every raw line."""
    return decimals_to_double(
        _raw(spark, sf_dir).select(
            *RAW_COLUMNS,
            parse_quantity(trim_spaces(F.col("Quantity"))).alias("ParsedQuantity"),
            parse_price(trim_spaces(F.col("UnitPrice"))).alias("ParsedUnitPrice"),
        )
    )


def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6-F10 over every raw line."""
    ts = parse_invoice_timestamp(trim_spaces(F.col("InvoiceDate")))
    day = F.to_date(ts)
    return _raw(spark, sf_dir).select(
        *RAW_COLUMNS,
        ts.alias("ParsedInvoiceDate"),
        day.alias("InvoiceDateOnly"),
        F.year(ts).alias("Year"),
        F.month(ts).alias("Month"),
        F.hour(ts).alias("Hour"),
        F.date_format(ts, YEAR_MONTH_PATTERN).alias("YearMonth"),
        F.date_format(ts, DAY_NAME_PATTERN).alias("DayOfWeek"),
        F.dayofweek(ts).alias("DayOfWeekNumber"),
        F.date_add(day, 1).alias("NextDay"),
        F.datediff(day, F.lit("2000-01-01").cast("date")).alias("DaysSince2000"),
    )


def math_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line revenue, and exact HALF_UP ratios (x / 0 is NULL)."""
    qty = parse_quantity(trim_spaces(F.col("Quantity")))
    price = parse_price(trim_spaces(F.col("UnitPrice")))
    revenue = line_revenue(qty, price)
    signed_cents = F.when(qty < 0, -revenue).otherwise(revenue) * 100
    # abs() of the smallest int does not fit an int.
    per_unit = half_up_div(signed_cents, F.abs(qty.cast("bigint")) * 100, 2)
    return decimals_to_double(
        _raw(spark, sf_dir).select(
            *RAW_COLUMNS,
            revenue.alias("LineRevenue"),
            per_unit.alias("RevenuePerUnit"),
            half_up_div(revenue * 100, F.lit(300), 2).alias("ThirdOfRevenue"),
        )
    )


def null_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL/blank tests, CASE, cast to string."""
    qty = parse_quantity(trim_spaces(F.col("Quantity")))
    price = parse_price(trim_spaces(F.col("UnitPrice")))
    return _raw(spark, sf_dir).select(
        *RAW_COLUMNS,
        is_blank(F.col("Description")).alias("DescriptionBlank"),
        is_present(F.col("CustomerID")).alias("CustomerPresent"),
        F.when(qty.isNull(), "missing")
        .when(qty <= 0, "non_positive")
        .otherwise("positive")
        .alias("QuantityStatus"),
        qty.cast("string").alias("QuantityText"),
        (price.isNotNull() & (price > 0)).alias("PriceValid"),
    )


# ---------------------------------------------------------------- quality
def _quality(fn, source, spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(fn(source(spark, sf_dir)))


def _strict_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fixture_tables(spark, sf_dir, Params(market=STRICT_GROWTH))
    return tables.table("potential_growth_markets")


TABLE_KEYS = (
    "sales_kpis",
    "cancellation_kpis",
    "overall_kpis",
    "monthly_sales_trend",
    "weekday_sales",
    "hourly_sales",
    "monthly_revenue_extremes",
    "product_performance",
    "top_products_by_quantity",
    "top_products_by_revenue",
    "bottom_products_by_revenue",
    "customer_performance",
    "top_customers",
    "analysis_date",
    "customer_rfm",
    "customer_rfm_top",
    "customer_segment_summary",
    "country_performance",
    "top_countries_by_revenue",
    "market_share_uk_vs_non_uk",
    "potential_growth_markets",
    "top_hours_by_revenue",
    "market_share_chart",
    "customer_segment_share_chart",
    "top_products_chart",
    "top_countries_chart",
    "monthly_revenue_chart",
    "weekday_revenue_chart",
    "hourly_orders_chart",
    "formatted_kpis",
    "scaled_revenue_labels",
    "scaled_chart_labels",
)


def registered_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "csv_source_scan": X.csv_source_scan,
        "clean_column_names": X.clean_column_names,
        "export_csv_roundtrip": X.export_csv_roundtrip,
        "export_json_roundtrip": X.export_json_roundtrip,
        "export_json_array_roundtrip": X.export_json_array_roundtrip,
        "checked_source_scan": X.checked_source_scan,
        "malformed_line_counts": X.malformed_line_counts,
        "export_all_tables": X.export_all_tables_query,
        "export_all_values": X.export_all_values,
        "typed_sales": lambda s, d: decimals_to_double(_typed(s, d)),
        "cleaned_sales": lambda s, d: decimals_to_double(_cleaned(s, d)),
        "cancelled_lines": lambda s, d: decimals_to_double(cancelled_lines(_typed(s, d))),
        "raw_row_count": partial(_quality, P.row_count, _raw),
        "null_or_empty_profile_raw": partial(_quality, P.null_or_empty_profile, _raw),
        "null_or_empty_profile_cleaned": partial(_quality, P.null_or_empty_profile, _cleaned),
        "null_profile_strict": partial(_quality, P.null_profile_strict, _raw),
        "sample_rows_raw": partial(_quality, P.sample_rows, _raw),
        "sample_rows_cleaned": partial(_quality, P.sample_rows, _cleaned),
        "cleaning_summary": partial(_quality, P.cleaning_summary, _typed),
        "string_functions": string_functions,
        "numeric_parse_functions": numeric_parse_functions,
        "date_functions": date_functions,
        "math_functions": math_functions,
        "null_predicates": null_predicates,
        "potential_growth_markets_strict": _strict_growth,
    }
    for name in TABLE_KEYS:
        q[name] = partial(_table, name)
    return q
