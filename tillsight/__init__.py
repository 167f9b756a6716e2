"""tillsight: Spark-native retail invoice analytics.

Pipeline: ``raw`` (8 string columns) -> ``typed_sales`` -> ``cleaned_sales``
-> result tables -> distributed CSV / JSON sinks.  Every stage is a pure
DataFrame -> DataFrame function; actions happen only in sinks.

    from tillsight import read_invoice_lines, typed_sales, cleaned_sales, SalesTables
    typed = typed_sales(read_invoice_lines(spark, "hdfs://.../invoices/"))
    SalesTables(typed, cleaned_sales(typed)).table("overall_kpis").show()
"""

from tillsight.operators.customers import SegmentRules
from tillsight.operators.markets import MarketRules
from tillsight.operators.prepare import cancelled_lines, cleaned_sales, typed_sales
from tillsight.plans.catalog import EXPORTED_TABLES, Params, SalesTables
from tillsight.plans.export import export_all_tables
from tillsight.sources.delimited import read_invoice_lines
from tillsight.streaming.ingest import start_typed_ingest

__all__ = [
    "EXPORTED_TABLES",
    "MarketRules",
    "Params",
    "SalesTables",
    "SegmentRules",
    "cancelled_lines",
    "cleaned_sales",
    "export_all_tables",
    "read_invoice_lines",
    "start_typed_ingest",
    "typed_sales",
]
