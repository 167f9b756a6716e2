"""Display formatting for viewer and chart feeds.

Amounts are formatted from exact decimals; scaled labels round HALF_UP.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillsight.functions.rounding import scaled_money

MILLION = 1_000_000
THOUSAND = 1_000


def money_text(c: Column) -> Column:
    """1234.5 -> '1,234.50'."""
    return F.format_number(c, 2)


def integer_text(c: Column) -> Column:
    """1234 -> '1,234'."""
    return F.format_number(c, 0)


def percent_text(c: Column) -> Column:
    """14.81 -> '14.81%' (the value as stored, then a percent sign)."""
    return F.concat(c.cast("double").cast("string"), F.lit("%"))


def millions_label(money: Column) -> Column:
    """1161817.38 -> '$1.2M'."""
    return F.concat(F.lit("$"), scaled_money(money, MILLION, 1).cast("string"), F.lit("M"))


def thousands_label(money: Column) -> Column:
    """168469.6 -> '$168K'."""
    return F.concat(F.lit("$"), scaled_money(money, THOUSAND, 0).cast("string"), F.lit("K"))
