"""Product tables.

Top-k sorts end in a full tie-break (StockCode, Description) so the k rows
are deterministic; ``orderBy(...).limit(k)`` plans as a per-partition top-k
plus one k-row merge (``TakeOrderedAndProject``), never a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.rounding import money_sum

TOP_N = 10


def _tie_break():
    return (F.asc("StockCode"), F.asc("Description"))


def by_quantity():
    return (F.desc("ProductQuantitySold"), F.desc("ProductRevenue"), *_tie_break())


def by_revenue():
    return (F.desc("ProductRevenue"), F.desc("ProductQuantitySold"), *_tie_break())


def by_revenue_ascending():
    return (F.asc("ProductRevenue"), F.asc("ProductQuantitySold"), *_tie_break())


def product_performance(cleaned: DataFrame) -> DataFrame:
    """Per (StockCode, Description); a code with two descriptions is two rows."""
    return cleaned.groupBy("StockCode", "Description").agg(
        F.sum("Quantity").alias("ProductQuantitySold"),
        money_sum("Revenue").alias("ProductRevenue"),
        F.count_distinct("InvoiceNo").alias("ProductOrderCount"),
    )


def top_products_by_quantity(products: DataFrame, n: int = TOP_N) -> DataFrame:
    """R2."""
    return products.orderBy(*by_quantity()).limit(n)


def top_products_by_revenue(products: DataFrame, n: int = TOP_N) -> DataFrame:
    """R3."""
    return products.orderBy(*by_revenue()).limit(n)


def bottom_products_by_revenue(products: DataFrame, n: int = TOP_N) -> DataFrame:
    """R4."""
    return products.orderBy(*by_revenue_ascending()).limit(n)
