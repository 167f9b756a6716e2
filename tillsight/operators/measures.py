"""Shared measure set of every grouped sales table.

All measures are decomposable or distinct counts, so a table built on the
line-grain cleaned facts and one built on the invoice-grain rollup
(``tillsight.plans.rollup``) give identical results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.rounding import money_sum, percent, ratio


def sales_measures(
    revenue: str,
    orders: str,
    quantity: str,
    customers: str | None = None,
) -> list[Column]:
    """round(sum(Revenue), 2), countDistinct(InvoiceNo), sum(Quantity)
    and, for market tables, countDistinct(CustomerID)."""
    cols = [
        money_sum("Revenue").alias(revenue),
        F.count_distinct("InvoiceNo").alias(orders),
        F.sum("Quantity").alias(quantity),
    ]
    if customers is not None:
        cols.append(F.count_distinct("CustomerID").alias(customers))
    return cols


def with_unit_values(table: DataFrame, money: str, per: dict[str, str]) -> DataFrame:
    """``table`` with, for each (name, count column), ``money`` per unit of the count."""
    return table.withColumns({name: ratio(F.col(money), F.col(count)) for name, count in per.items()})


def with_share(table: DataFrame, money: str, name: str) -> DataFrame:
    """``table`` with each row's percentage of the sum of ``money``.  The sum runs over
    the rows of a bounded result table, never over lines."""
    whole = F.sum(money).over(Window.partitionBy())
    return table.withColumn(name, percent(F.col(money), whole))
