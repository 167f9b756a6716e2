"""Profiling and data-quality counters.

Each profile is ONE aggregate over ONE scan: per-column counters are
``count_if`` expressions inside a single ``agg``, never an action per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tillsight.operators.prepare import cleaning_condition, is_blank

SAMPLE_ROWS = 30

SUMMARY_COLUMNS = (
    "RawRows",
    "CleanedRows",
    "RemovedRows",
    "CancelledRows",
    "EmptyDescriptionRows",
    "EmptyCustomerIdRows",
    "InvalidQuantityRows",
    "InvalidUnitPriceRows",
)


def row_count(df: DataFrame) -> DataFrame:
    """One row, RowCount."""
    return df.agg(F.count(F.lit(1)).alias("RowCount"))


def schema_listing(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(Ordinal, ColumnName, DataType) of a frame's schema.

    Metadata only: it is built from the analysed plan, not from the rows.
    """
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    schema = StructType(
        [
            StructField("Ordinal", IntegerType(), False),
            StructField("ColumnName", StringType(), False),
            StructField("DataType", StringType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)


def null_or_empty_counters(columns: list[str]) -> list[Column]:
    """The aggregates of P3/P4, also for observing a frame on its way elsewhere."""
    return [F.count_if(is_blank(F.col(c).cast("string"))).alias(c) for c in columns]


def null_or_empty_profile(df: DataFrame) -> DataFrame:
    """Per column, rows that are NULL or blank after a string cast."""
    return df.agg(*null_or_empty_counters(df.columns))


def null_counters(columns: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def null_profile_strict(df: DataFrame) -> DataFrame:
    """Per column, rows that are NULL (blank is not NULL)."""
    return df.agg(*null_counters(df.columns))


def sample_rows(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """P5: first n rows in a total order over all columns (top-k, no global sort)."""
    return df.orderBy(*[F.asc(c) for c in df.columns]).limit(n)


def cleaning_summary(typed: DataFrame) -> DataFrame:
    """Independent counters over the typed table (they overlap)."""
    quantity, price = F.col("Quantity"), F.col("UnitPrice")
    counts = typed.agg(
        F.count(F.lit(1)).alias("RawRows"),
        F.count_if(cleaning_condition()).alias("CleanedRows"),
        F.count_if(F.col("IsCancelled")).alias("CancelledRows"),
        F.count_if(is_blank(F.col("Description"))).alias("EmptyDescriptionRows"),
        F.count_if(is_blank(F.col("CustomerID"))).alias("EmptyCustomerIdRows"),
        F.count_if(quantity.isNull() | (quantity <= 0)).alias("InvalidQuantityRows"),
        F.count_if(price.isNull() | (price <= 0)).alias("InvalidUnitPriceRows"),
    )
    return counts.withColumn("RemovedRows", F.col("RawRows") - F.col("CleanedRows")).select(
        *SUMMARY_COLUMNS
    )
