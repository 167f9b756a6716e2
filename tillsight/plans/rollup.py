"""Invoice-grain rollup shared by the time, customer and market tables.

Every measure of those tables is a sum, a max, or a distinct count of
InvoiceNo / CustomerID, and every grouping key (month, weekday, hour,
customer, country, market) is a function of (InvoiceNo, CustomerID, Country,
InvoiceDate).  Summing lines to that grain first is therefore exact and
shrinks the input of eleven tables by the number of lines per invoice.

The rollup is one hash aggregation with map-side partial aggregation, so a
hot invoice or customer is collapsed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.markets import MarketRules, market_of
from tillsight.operators.measures import sales_measures
from tillsight.operators.prepare import calendar_columns

INVOICE_GRAIN = ("InvoiceNo", "CustomerID", "Country", "InvoiceDate")


def invoice_rollup(cleaned: DataFrame) -> DataFrame:
    """Cleaned lines summed per invoice grain, with the calendar columns."""
    return (
        cleaned.groupBy(*INVOICE_GRAIN)
        .agg(F.sum("Revenue").alias("Revenue"), F.sum("Quantity").alias("Quantity"))
        .withColumns(calendar_columns(F.col("InvoiceDate")))
    )


# The groupings of the time and market tables, each a grouping set of its own.
DIMENSIONS = {
    "month": ("YearMonth",),
    "weekday": ("DayOfWeekNumber", "DayOfWeek"),
    "hour": ("Hour",),
    "country": ("Country",),
    "market": ("Market",),
}
MEASURES = ("Revenue", "Orders", "Quantity", "Customers")


def _grouping_id(dimension: str) -> int:
    """Spark's number of a grouping set: a bit for each key that is not in it, the first key's the highest."""
    keys = [key for own in DIMENSIONS.values() for key in own]
    return sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in DIMENSIONS[dimension])


def dimension_rollup(facts: DataFrame, rules: MarketRules) -> DataFrame:
    """Sales measures by month, by weekday, by hour, by country and by market in one aggregate over
    ``facts`` (``GROUPING SETS``), so five tables read the facts once.  A few rows per value."""
    keys = [key for own in DIMENSIONS.values() for key in own]
    with_keys = facts.withColumns({"DayOfWeekNumber": F.dayofweek("InvoiceDate"), "Market": market_of(rules)})
    sets = [[F.col(key) for key in own] for own in DIMENSIONS.values()]
    return with_keys.groupingSets(sets, *keys).agg(F.grouping_id().alias("Dimension"), *sales_measures(*MEASURES))


def dimension(rollup: DataFrame, name: str, *measures: str) -> DataFrame:
    """One table of ``dimension_rollup``: its keys, then the first measures under the given names."""
    named = [F.col(m).alias(n) for m, n in zip(MEASURES, measures, strict=False)]
    return rollup.filter(F.col("Dimension") == _grouping_id(name)).select(*DIMENSIONS[name], *named)
