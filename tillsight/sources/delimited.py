"""Delimited invoice-file source.

Any Hadoop-compatible path works (local, ``hdfs://``, object stores): path
resolution is Spark's.  All columns are strings, never inferred.  Columns are
bound by name: the header of the first file gives the names, a header that
another file does not share is an error, and the declared columns are selected
whatever their order, padding or byte-order mark.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillsight.sources.fixture import RAW_COLUMNS

# Fixed reader settings of the original job; headers are checked file by file.
READER_OPTIONS = {
    "header": "true",
    "sep": ";",
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    "enforceSchema": "false",
}
# A file's first name may carry the mark; blanks may surround any name.
_AROUND_NAMES = "﻿ \t"


class HeaderError(ValueError):
    """A header that lacks a declared column or names one twice."""


def raw_schema(columns: tuple[str, ...] = RAW_COLUMNS) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def bind_columns(lines: DataFrame, columns: tuple[str, ...] = RAW_COLUMNS) -> DataFrame:
    """The declared ``columns`` of ``lines``, found by their bare names."""
    places: dict[str, list[str]] = {}
    for written in lines.columns:
        places.setdefault(written.strip(_AROUND_NAMES), []).append(written)
    faulty = [c for c in columns if len(places.get(c, ())) != 1]
    if faulty:
        raise HeaderError(f"header {lines.columns} does not name once each: {faulty}")
    return lines.select(*(F.col(f"`{places[c][0].replace('`', '``')}`").alias(c) for c in columns))


def read_invoice_lines(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...] = RAW_COLUMNS,
    **options: str,
) -> DataFrame:
    """Header CSV, ';', UTF-8, PERMISSIVE (short rows padded with NULL).

    One small read takes the names from the header; the scan itself checks the
    header of every file it opens against them.
    """
    reader = spark.read.options(**{**READER_OPTIONS, **options})
    header = reader.csv(path).schema
    return bind_columns(reader.schema(raw_schema(tuple(header.names))).csv(path), columns)


MALFORMED = "MalformedLine"
# A quoted field in the reader's default quoting: separators in it separate nothing.
_QUOTED = r'"(?:[^"\\]|\\.)*"'


def read_checked_lines(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...] = RAW_COLUMNS,
    **options: str,
) -> DataFrame:
    """``read_invoice_lines`` with a record of what PERMISSIVE pads or cuts in silence: of a line
    with fewer or more fields than the header, ``MalformedLine`` keeps the text and ``FieldCount`` its
    number of fields; both are NULL for all others.  The parsed columns are the same as without."""
    settings = {**READER_OPTIONS, **options}
    reader = spark.read.options(**settings)
    header = reader.csv(path).schema
    schema = raw_schema(tuple(header.names)).add(MALFORMED, StringType(), True)
    # A reader that skips unused fields would not count them.
    lines = reader.option("columnPruning", "false").option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path)
    bound = bind_columns(lines, (*columns, MALFORMED))
    # Spark refuses queries that read nothing but the record of faulty lines (a count of them), and a filter on it
    # that reaches the reader finds none: so it is bound to an empty part of another column, null by value only.
    nothing = F.substring(F.coalesce(F.col(columns[0]), F.lit("")), 1, 0)
    bound = bound.withColumn(MALFORMED, F.nullif(F.concat_ws("", MALFORMED, nothing), F.lit("")))
    unquoted = F.regexp_replace(MALFORMED, _QUOTED, "")
    return bound.withColumn("FieldCount", F.size(F.split(unquoted, re.escape(settings["sep"]), -1))).withColumn(
        "FieldCount", F.when(F.col(MALFORMED).isNotNull(), F.col("FieldCount"))
    )


def malformed_lines(checked: DataFrame) -> DataFrame:
    """The rejected lines of ``read_checked_lines``."""
    return checked.filter(F.col(MALFORMED).isNotNull())
