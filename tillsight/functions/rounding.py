"""Exact money arithmetic.

Money is a decimal from the line revenue to the last projection.  HALF_UP rounding of a
double is not exact (``round(1.005, 2)``), and even a decimal quotient is
rounded once at its result scale before ``round`` rounds it again, so every
ratio here is computed as an exact integer division in units:

    round(p / q, s) = sign(p) * floor((2 * |p| * 10^s + q) / (2 * q)) / 10^s

for integer-valued ``p`` and ``q > 0``.  A zero divisor gives NULL (the legacy
"x / 0 is NULL"), without turning ANSI mode off.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

UNITS = DecimalType(38, 0)
CENTS = 100


# Holds the product with any int quantity in a decimal(38,10).
EXACT_PRICE = DecimalType(27, 10)
REVENUE = DecimalType(31, 2)


# Prices of up to four decimals below this times any int quantity fit a long, in units of 1/10,000.
FINE_UNITS = 10_000
SMALL_PRICE = 200_000


def line_revenue(quantity: Column, unit_price: Column) -> Column:
    """Revenue of one line, rounded HALF_UP to cents.

    A price that a decimal(27,10) holds (its shortest decimal form, so what
    the text said) is multiplied exactly.  Any other finite price, with more decimals or
    larger, is multiplied as a double, as the original job did.

    Nearly all prices are whole numbers of 1/10,000: such a double is told by a correctly rounded
    division giving it back, and is multiplied in whole numbers.  Only others are made decimals, which
    goes through their text.
    """
    exact = unit_price.try_cast(EXACT_PRICE)
    price = unit_price.cast(DoubleType())
    by_decimal = F.round(quantity * exact, 2).cast(REVENUE)
    by_double = F.round(quantity * price, 2).try_cast(REVENUE)
    fine = F.rint(price * F.lit(float(FINE_UNITS)))
    is_fine = (F.abs(price) < F.lit(float(SMALL_PRICE))) & (fine / F.lit(float(FINE_UNITS)) == price)
    product = quantity.cast("bigint") * fine.cast("bigint")
    cents = F.call_function("div", F.abs(product) + F.lit(FINE_UNITS // CENTS // 2), F.lit(FINE_UNITS // CENTS))
    by_units = (F.when(product < 0, -cents).otherwise(cents).cast(DecimalType(20, 0)) * F.lit(Decimal("0.01"))).cast(REVENUE)
    return F.when(is_fine, by_units).when(exact.cast(DoubleType()) == price, by_decimal).otherwise(by_double)


def money_sum(c: Column | str) -> Column:
    """round(sum(money), 2); the sum of cent values is already exact."""
    return F.round(F.sum(c), 2)


def _units(c: Column, factor: int = 1) -> Column:
    return (c * F.lit(factor)).cast(UNITS)


def half_up_div(p: Column, q: Column, scale: int) -> Column:
    """round(p / q, scale) HALF_UP, exact, for integer-valued p and q >= 0."""
    p, q = p.cast(UNITS), q.cast(UNITS)
    shift = 10**scale
    magnitude = F.call_function("div", F.abs(p) * F.lit(2 * shift) + q, q * F.lit(2))
    rounded = (F.signum(p).cast(UNITS) * magnitude.cast(UNITS)) / F.lit(shift)
    return F.when(q != 0, rounded.cast(DecimalType(38, scale)))


def ratio(money: Column, count: Column, scale: int = 2) -> Column:
    """round(money / count, scale): average order value, revenue per customer."""
    return half_up_div(_units(money, CENTS), _units(count, CENTS), scale)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """round(part / whole * 100, scale) for two money (cent) amounts."""
    return half_up_div(_units(part, CENTS * 100), _units(whole, CENTS), scale)


def count_percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """round(part / whole * 100, scale) for two integer counts."""
    return half_up_div(_units(part, 100), _units(whole), scale)


def exact_average(c: Column | str, scale: int = 2) -> Column:
    """round(avg(x), scale) for an integer column, ignoring NULLs."""
    c = F.col(c) if isinstance(c, str) else c
    return half_up_div(F.sum(c), F.count(c), scale)


def scaled_money(money: Column, unit: int, scale: int) -> Column:
    """round(money / unit, scale), e.g. revenue in millions to 1 decimal."""
    return half_up_div(_units(money, CENTS), F.lit(unit * CENTS), scale)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Final projection: publish every decimal column as double."""
    return df.select(
        *[
            F.col(f.name).cast(DoubleType()).alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
