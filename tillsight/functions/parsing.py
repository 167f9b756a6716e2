"""Typed parsing of raw invoice strings.

Every parser is a pure Column -> Column expression built from built-in
functions, so it stays inside whole-stage codegen and never raises under
ANSI mode: malformed input becomes NULL, as the legacy (non-ANSI) casts of
the original job did.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

# Fixed values of the input format (must match the original job).
INVOICE_TIMESTAMP_PATTERN = "dd/MM/yyyy HH:mm"
CANCELLED_INVOICE_PREFIX = "C"
DECIMAL_COMMA = ","

# A double parser also takes "5d", "1f" and hexadecimal text; a price is none of these.
_NOT_A_PRICE = "[dDfFxX]"

# Legacy string -> int cast: optional blanks/control bytes around an optional
# sign, then at least one digit or dot: integer digits (may be empty) and an
# optional '.' fraction that is truncated.  "12.7" -> 12, ".5" -> 0,
# "1e3" / "abc" / "+" / "" / overflow -> NULL.
_LEGACY_INT = (
    r"^[\x00-\x20\x7f]*(?<sign>[+-]?)(?=[0-9.])(?<digits>[0-9]*)(?:\.[0-9]*)?[\x00-\x20\x7f]*$"
)
# sign, a zero (so an empty integer part reads as 0), then the digits
_LEGACY_INT_KEEP = "${sign}0${digits}"


def trim_spaces(c: Column) -> Column:
    """strip ASCII spaces only (tabs survive)."""
    return F.trim(c)


def decimal_comma_to_dot(c: Column) -> Column:
    """F2: replace every comma with a dot ("1.234,50" -> "1.234.50")."""
    return F.replace(c, F.lit(DECIMAL_COMMA), F.lit("."))


def is_cancelled_invoice(invoice_no: Column) -> Column:
    """case-sensitive prefix test; NULL invoice gives NULL."""
    return invoice_no.startswith(CANCELLED_INVOICE_PREFIX)


def parse_quantity(c: Column) -> Column:
    """string -> int with the legacy (truncating) cast semantics.

    Plain integers take the strict ``try_cast``.  Only what that leaves is
    matched with a regex: a well-formed value is rewritten to its signed
    integer part; anything else is left as is and fails the cast again.
    """
    legacy = F.regexp_replace(c, _LEGACY_INT, _LEGACY_INT_KEEP)
    return F.coalesce(c.try_cast(IntegerType()), legacy.try_cast(IntegerType()))


def parse_price(c: Column) -> Column:
    """F2 + F5: decimal comma -> dot -> double, unrounded and of any size; malformed
    or not finite -> NULL.  ``line_revenue`` takes it back to the decimal it was
    written as."""
    text = decimal_comma_to_dot(c)
    value = text.try_cast(DoubleType())
    return F.when((F.abs(value) < float("inf")) & ~text.rlike(_NOT_A_PRICE), value)


def parse_invoice_timestamp(c: Column, pattern: str = INVOICE_TIMESTAMP_PATTERN) -> Column:
    """strict pattern parse; unparsable or impossible dates -> NULL.

    The result is pinned to TIMESTAMP_NTZ right after parsing, so later
    calendar fields do not depend on the session time zone.
    """
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")
