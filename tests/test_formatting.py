"""Display formats of the viewer and chart feeds (V8/V9), hand-written values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tillsight.functions.formatting import (
    integer_text,
    millions_label,
    money_text,
    percent_text,
    thousands_label,
)


def _apply(spark, fn, values, dtype):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r["r"] for r in df.select(fn(F.col("v")).alias("r")).collect()]


def test_money_and_integer_text(spark):
    assert _apply(spark, money_text, [Decimal("1234.5"), Decimal("8911407.90"), Decimal("0")], "decimal(38,2)") == [
        "1,234.50", "8,911,407.90", "0.00",
    ]
    assert _apply(spark, integer_text, [1234, 5167812, 0], "bigint") == ["1,234", "5,167,812", "0"]


def test_percent_text_is_the_stored_value(spark):
    assert _apply(spark, percent_text, [Decimal("14.81"), Decimal("7.00"), None], "decimal(38,2)") == [
        "14.81%", "7.0%", None,
    ]


def test_scaled_labels_round_half_up(spark):
    values = [Decimal("1161817.38"), Decimal("1250000.00"), Decimal("1249999.99"), Decimal("447137.35")]
    assert _apply(spark, millions_label, values, "decimal(38,2)") == ["$1.2M", "$1.3M", "$1.2M", "$0.4M"]
    assert _apply(spark, thousands_label, [Decimal("168469.60"), Decimal("500.00"), Decimal("499.99")], "decimal(38,2)") == [
        "$168K", "$1K", "$0K",
    ]
