"""Batch job: profile, clean and export every table (the original's entry point).

    spark-submit tillsight/job.py [input path] [output root] [--focus-country X]
    python -m tillsight.job hdfs://namenode:9000/data/online-retail/ /out

Input is any Hadoop-compatible path (file, folder or glob) of ';' invoice
CSVs.  The text is parsed once into a staged Parquet copy of the typed lines; the
raw counters are observed on the way.  Console output
uses ``show`` on one-row / bounded results only; the tables themselves are
written by executors (``export_typed_tables``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import Observation, SparkSession

from tillsight.operators import quality as P
from tillsight.operators.customers import SegmentRules
from tillsight.operators.markets import MarketRules
from tillsight.operators.prepare import cleaned_sales, typed_sales
from tillsight.plans.catalog import EXPORTED_TABLES, Params
from tillsight.plans.export import export_typed_tables
from tillsight.plans.scratch import discard, stage
from tillsight.sources.delimited import read_invoice_lines


# Where a local run looks for its input.
DEFAULT_INPUT = "data/Online Retail.csv"


def parse_args(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="tillsight.job", description=__doc__.splitlines()[0])
    ap.add_argument("input", nargs="?", default=DEFAULT_INPUT, help="invoice CSV path (file, folder or glob; any Hadoop FS)")
    ap.add_argument("output", nargs="?", default="output", help="output root for CSV/JSON tables")
    ap.add_argument("--focus-country", default=MarketRules.focus_country)
    ap.add_argument("--rest-label", default=MarketRules.rest_label)
    ap.add_argument("--min-customers", type=int, default=MarketRules.min_customers)
    ap.add_argument("--min-orders", type=int, default=MarketRules.min_orders)
    ap.add_argument("--top-n", type=int, default=10)
    ap.add_argument(
        "--json-array", action="store_true",
        help="write each table's JSON as one array of objects instead of JSON Lines",
    )
    ap.add_argument(
        "--named-files", action="store_true",
        help="write each table as <output>/<table>.csv and .json where it is one file",
    )
    ap.add_argument(
        "--show", type=int, default=0, metavar="N",
        help="print the first N rows of every exported table (read back from its CSV)",
    )
    return ap.parse_args(argv)


def _titled(text: str) -> None:
    print(f"=== {text}")


def main(argv: list[str] | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("tillsight-sales-analytics").getOrCreate()
    params = Params(
        market=MarketRules(args.focus_country, args.rest_label, args.min_customers, args.min_orders),
        segments=SegmentRules(),
        top_n=args.top_n,
    )
    raw = read_invoice_lines(spark, args.input)
    _titled("Raw lines")
    raw.printSchema()
    raw.show(P.SAMPLE_ROWS, truncate=False)
    # The text is parsed and typed once; the raw profile is counted while the
    # typed lines are written (to the shared checkpoint folder).
    blanks, nulls = Observation("raw blanks"), Observation("raw nulls")
    paths: list[str] = []
    try:
        watched = raw.observe(blanks, *P.null_or_empty_counters(raw.columns)).observe(nulls, *P.null_counters(raw.columns))
        typed = stage(spark, typed_sales(watched), "typed", paths)
        for title, counts in (("Raw null or empty values", blanks), ("Raw NULL values", nulls)):
            _titled(title)
            spark.createDataFrame([counts.get]).select(*raw.columns).show(truncate=False)
        cleaned = cleaned_sales(typed)
        _titled("Cleaning summary")
        P.cleaning_summary(typed).show(truncate=False)
        _titled("Cleaned lines")
        cleaned.printSchema()
        P.null_or_empty_profile(cleaned).show(truncate=False)
        cleaned.show(P.SAMPLE_ROWS, truncate=False)
        root = args.output.rstrip("/")
        json_format = "array" if args.json_array else "lines"
        _titled("Exported tables")
        export_typed_tables(spark, typed, root, params, json_format=json_format, named_files=args.named_files).show(len(EXPORTED_TABLES), truncate=False)
    finally:
        discard(spark, paths)
    if args.show > 0:
        # Console sink over the small written tables: no recomputation.
        for name in EXPORTED_TABLES:
            _titled(name)
            folder = f"{root}/{name}.csv" if args.named_files else f"{root}/{name}/csv"
            spark.read.option("header", "true").csv(folder).show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
