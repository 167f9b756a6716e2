"""Staged multi-table export.

The original ran 41 actions, each re-reading and re-parsing the CSV, and
then collected every table to the driver to write files.  This plan:

1. parses the raw lines once and stages the typed table as Parquet in the
   shared checkpoint folder (cuts lineage; an executor lost later only costs
   re-reading Parquet, not re-parsing text);
2. stages the exact invoice-grain rollup once for the eleven time, customer
   and market tables, so they read a table smaller by the number of lines
   per invoice; stages the month, weekday, hour, country and market measures of
   one aggregate with grouping sets over it, so those five tables and what is
   derived from them read the rollup once; and persists the aggregates that
   several other tables share (product, customer, RFM) so each is computed once;
3. writes each result table through the distributed CSV and JSON writers
   (result tables are bounded by dimension sizes or k, so each is one file).
   The tables are independent jobs, so a few are submitted concurrently from
   driver threads and share the executors instead of running one by one;
4. deletes the folders it staged, and returns a manifest (TableName, RowCount)
   read back from the CSV files.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tillsight.functions.rounding import decimals_to_double
from tillsight.operators.prepare import cleaned_sales, typed_sales
from tillsight.plans.catalog import EXPORTED_TABLES, Params, SalesTables
from tillsight.plans.rollup import dimension_rollup, invoice_rollup
from tillsight.plans.scratch import discard, new_run_dir, stage
from tillsight.sinks.files import (
    CSV_WRITE_OPTIONS,
    as_named_file,
    read_csv_table,
    read_json_array,
    read_json_table,
    write_csv,
    write_json,
    write_json_array,
)
from tillsight.sources.delimited import malformed_lines, read_checked_lines, read_invoice_lines
from tillsight.sources.fixture import raw_invoice_lines


def staged_tables(
    spark: SparkSession, raw: DataFrame, params: Params, rollup: bool = True, paths: list[str] | None = None
) -> SalesTables:
    """Stage the typed lines (one parse of ``raw``), then the tables over them;
    ``paths`` gets the staged folders."""
    return tables_over_typed(spark, stage(spark, typed_sales(raw), "typed", paths), params, rollup, paths)


def tables_over_typed(
    spark: SparkSession, typed: DataFrame, params: Params, rollup: bool = True, paths: list[str] | None = None
) -> SalesTables:
    """Tables over an already materialized typed table (staged, or written by
    the streaming ingest), with the invoice rollup staged once."""
    cleaned = cleaned_sales(typed)
    if not rollup:
        return SalesTables(typed, cleaned, params)
    facts = stage(spark, invoice_rollup(cleaned), "invoice-rollup", paths)
    dimensions = stage(spark, dimension_rollup(facts, params.market), "dimension-rollup", paths)
    return SalesTables(typed, cleaned, params, facts, dimensions)


EXPORT_THREADS = 8


JSON_FORMATS = ("lines", "array")


def _export_one(name: str, df: DataFrame, output_root: str, json_format: str = "lines", named_files: bool = False):
    """One table: computed and counted once, written twice from what is kept of it."""
    result = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = result.count()
        csv_path = write_csv(result, f"{output_root}/{name}/csv", small=True, rows=rows)
        if json_format == "array":
            json_path = write_json_array(result, f"{output_root}/{name}/json", rows=rows)
        else:
            json_path = write_json(result, f"{output_root}/{name}/json", small=True, rows=rows)
    finally:
        result.unpersist()
    if named_files:
        spark = df.sparkSession
        moved = [as_named_file(spark, folder, f"{output_root}/{name}.{kind}") for folder, kind in ((csv_path, "csv"), (json_path, "json"))]
        if moved[0]:
            csv_path = f"{output_root}/{name}.csv"
        if all(moved):
            discard(spark, [f"{output_root}/{name}"])
    return name, csv_path, result.schema


def export_all_tables(
    spark: SparkSession,
    raw: DataFrame,
    output_root: str,
    params: Params | None = None,
    rollup: bool = True,
    threads: int = EXPORT_THREADS,
    json_format: str = "lines",
    named_files: bool = False,
) -> DataFrame:
    """Write the fifteen result tables as CSV and JSON; return the manifest.

    ``json_format="array"`` writes each table as one JSON array of objects
    (the original's file shape) instead of JSON Lines.  ``named_files`` moves each table that is one
    file to ``<output_root>/<table>.csv`` and ``.json``; larger ones stay folders.
    """
    paths: list[str] = []
    try:
        tables = staged_tables(spark, raw, params or Params(), rollup, paths)
        return _export(spark, tables, output_root, threads, json_format, named_files)
    finally:
        discard(spark, paths)


def export_typed_tables(
    spark: SparkSession,
    typed: DataFrame,
    output_root: str,
    params: Params | None = None,
    rollup: bool = True,
    threads: int = EXPORT_THREADS,
    json_format: str = "lines",
    named_files: bool = False,
) -> DataFrame:
    """S8 over a materialized typed table, e.g. the streaming ingest's output."""
    paths: list[str] = []
    try:
        tables = tables_over_typed(spark, typed, params or Params(), rollup, paths)
        return _export(spark, tables, output_root, threads, json_format, named_files)
    finally:
        discard(spark, paths)


def _export(
    spark: SparkSession, tables: SalesTables, output_root: str, threads: int, json_format: str, named_files: bool = False
) -> DataFrame:
    if json_format not in JSON_FORMATS:
        raise ValueError(f"json_format must be one of {JSON_FORMATS}")
    shared = tables.persist_shared()
    try:
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            # materialize each shared aggregate once (RFM after the customer
            # aggregate it reads), then write every table
            list(pool.map(lambda df: df.count(), [df for n, df in shared.items() if n != "customer_rfm"]))
            shared["customer_rfm"].count()
            futures = [
                pool.submit(_export_one, name, df, output_root, json_format, named_files)
                for name, df in tables.exported().items()
            ]
            written = [f.result() for f in futures]
    finally:
        for df in shared.values():
            df.unpersist()
    counts = [
        read_csv_table(spark, path, schema).agg(F.count(F.lit(1)).alias("RowCount"))
        .select(F.lit(name).alias("TableName"), "RowCount")
        for name, path, schema in written
    ]
    return reduce(DataFrame.unionByName, counts)


def missing_tables(spark: SparkSession, output_root: str, names=EXPORTED_TABLES) -> list[str]:
    """The exported tables absent under ``output_root`` (the viewer's check).

    A table is absent if neither its CSV folder nor its named file is there, or the folder has no data file.  Folders are listed
    (and a header read) per name; any other fault is an error of its own.
    """
    missing = []
    for name in names:
        if not any(_has_data(spark, path) for path in (f"{output_root}/{name}/csv", f"{output_root}/{name}.csv")):
            missing.append(name)
    return missing


def _has_data(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.option("header", "true").csv(path).schema
    except AnalysisException as fault:
        if fault.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


# ------------------------------------------------------- registered queries
def _fixture_params():
    from tillsight.plans.registry import FIXTURE_PARAMS

    return FIXTURE_PARAMS


def csv_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines written as a ';' invoice CSV, then scanned back."""
    path = new_run_dir(spark, "invoice-csv")
    write_csv(raw_invoice_lines(spark, sf_dir), path, sep=";")
    return read_invoice_lines(spark, path)


def clean_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines written with columns in another order and names with a
    byte-order mark and padding, then scanned by name."""
    path = new_run_dir(spark, "padded-invoice-csv")
    raw = raw_invoice_lines(spark, sf_dir)
    names = list(reversed(raw.columns))
    padded = [f"\ufeff{names[0]} ", *(f" {n}  " for n in names[1:])]
    write_csv(raw.select(*(F.col(n).alias(p) for n, p in zip(names, padded, strict=True))), path, sep=";")
    return read_invoice_lines(spark, path)


def _roundtrip(spark: SparkSession, sf_dir: str, table: str, fmt: str) -> DataFrame:
    from tillsight.plans.registry import fixture_tables

    df = fixture_tables(spark, sf_dir).table(table)
    path = new_run_dir(spark, f"export-{fmt}")
    if fmt == "csv":
        write_csv(df, path, small=True)
        return read_csv_table(spark, path, df.schema)
    write_json(df, path, small=True)
    return read_json_table(spark, path, df.schema)


def export_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country table -> CSV -> typed read-back (NULL country kept)."""
    return _roundtrip(spark, sf_dir, "country_performance", "csv")


def export_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top customers (with a date column) -> JSON Lines -> read-back."""
    return _roundtrip(spark, sf_dir, "top_customers", "json")


def export_json_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 array form over every typed line: written as one JSON array and read back by line."""
    from tillsight.plans.registry import fixture_tables

    df = decimals_to_double(fixture_tables(spark, sf_dir).typed)
    path = new_run_dir(spark, "export-json-array")
    return read_json_array(spark, write_json_array(df, path), df.schema)


def _uneven_lines(spark: SparkSession, sf_dir: str) -> str:
    """The raw lines written as ';' text, some of them one or two fields short or with a field too many."""
    raw = raw_invoice_lines(spark, sf_dir)
    line = lambda *columns: F.to_csv(F.struct(*columns), {**CSV_WRITE_OPTIONS, "sep": ";"})
    by_stock = F.substring("StockCode", -1, 1)
    text = (
        F.when(by_stock == "3", line(*raw.columns[:-1]))
        .when(by_stock == "5", line(*raw.columns[:-2]))
        .when(by_stock == "7", line(*raw.columns, F.lit("surplus")))
        .otherwise(line(*raw.columns))
    )
    path = new_run_dir(spark, "uneven-invoice-text")
    # One field without quotes or separators of its own: the lines as they are, under the header.
    as_is = {"header": "true", "sep": "\u0001", "quote": "\u0000", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    raw.select(text.alias(";".join(raw.columns))).write.options(**as_is).csv(path)
    return path


def checked_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with a record of malformed lines: every line of the uneven text, with how many fields it has
    if that is not the declared number."""
    return read_checked_lines(spark, _uneven_lines(spark, sf_dir)).drop("MalformedLine")


def malformed_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected lines of the uneven text by their number of fields."""
    lines = malformed_lines(read_checked_lines(spark, _uneven_lines(spark, sf_dir)))
    return lines.groupBy("FieldCount").agg(F.count(F.lit(1)).alias("Lines"), F.count_distinct("InvoiceNo").alias("Invoices"))


def export_all_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 over the test tables: manifest of the fifteen exported tables."""
    root = new_run_dir(spark, "export")
    return export_all_tables(spark, raw_invoice_lines(spark, sf_dir), root, _fixture_params())


def export_all_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 over the test tables, by value: each double of each row of the fifteen
    written tables, read back from CSV and from JSON, under the row's other
    values as its key."""
    root = new_run_dir(spark, "export-values")
    tables = fixture_export_schemas(spark, sf_dir)
    export_all_tables(spark, raw_invoice_lines(spark, sf_dir), root, _fixture_params())
    parts = []
    for name, schema in tables.items():
        for kind, read in (("csv", read_csv_table), ("json", read_json_table)):
            rows = read(spark, f"{root}/{name}/{kind}", schema)
            numbers = [f.name for f in schema if f.dataType == DoubleType()]
            key = F.concat_ws("|", *(F.coalesce(F.col(f.name).cast("string"), F.lit("NULL")) for f in schema if f.name not in numbers))
            cells = F.array(*(F.struct(F.lit(n).alias("ColumnName"), F.col(n).alias("NumberValue")) for n in numbers))
            parts.append(
                rows.select(F.lit(name).alias("TableName"), F.lit(kind).alias("Format"), key.alias("RowKey"), F.explode(cells).alias("cell"))
                .select("TableName", "Format", "RowKey", "cell.*")
            )
    return reduce(DataFrame.unionByName, parts)


def fixture_export_schemas(spark: SparkSession, sf_dir: str) -> dict:
    from tillsight.plans.registry import fixture_tables

    tables = fixture_tables(spark, sf_dir)
    return {name: tables.table(name).schema for name in EXPORTED_TABLES}


__all__ = [
    "EXPORTED_TABLES",
    "export_all_tables",
    "export_typed_tables",
    "missing_tables",
    "stage",
    "staged_tables",
    "tables_over_typed",
]
