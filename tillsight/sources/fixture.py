"""Adapter from the TPC-H-like test tables to raw invoice lines (FIXTURES.md §3).

The original job reads one semicolon CSV of untyped invoice lines.  The test
tables are clean star-schema parquet, so this adapter derives the same raw
shape (eight string columns) and injects dirt deterministically.

Plan shape: every rule that depends only on an order (invoice number,
customer, country, timestamp text) is evaluated on the orders side, and every
rule that depends only on a part (stock code, description, price text) on the
part side, so the line-grain stream only carries finished strings through its
two joins.  Parts are joined first and orders last, so the lines of an order lie together.  The line x order join is a declared shuffle join (both sides are
fact-sized); the dimension joins are left to Catalyst/AQE, which broadcasts a
side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles.  AQE's skew
handling splits a hot order or part key across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
)

# Fixed values of the fixture mapping (FIXTURES.md §3).
CANCELLED_STATUS = "P"
CANCELLED_ORDER_MODULUS = 5
MISSING_DESCRIPTION_MODULUS = 97  # 0 -> NULL, 1 -> three spaces
BAD_QUANTITY_MODULUS = 223  # 0 -> "abc", 1 -> "0", 2 -> the smallest int
SMALLEST_INT_TEXT = "-2147483648"
BAD_DATE_MODULUS = 199
IMPOSSIBLE_DATE_TEXT = "31/02/2011 08:26"
# 0 -> "0", 1 -> "N/A", 2 -> half a cent more, 3 -> five decimals, 4 -> seven
# decimals and far below a cent, 5 -> a thousands dot
BAD_PRICE_MODULUS = 89
MISSING_CUSTOMER_MODULUS = 11  # 3 -> NULL, 4 -> two spaces
MISSING_COUNTRY_MODULUS = 149
MINUTE_OFFSET_BASE = 360
MINUTE_OFFSET_MODULUS = 840
FIXTURE_TIMESTAMP_PATTERN = "dd/MM/yyyy HH:mm"

# Declared types of the test-table columns the adapter reads: no schema
# inference (footer reads) when a query is built.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _order_side(orders: DataFrame, customers: DataFrame, nations: DataFrame) -> DataFrame:
    orders = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customers = customers.select("c_custkey", "c_nationkey")
    nations = nations.select("n_nationkey", "n_name")

    key = F.col("o_orderkey")
    cancelled = (F.col("o_orderstatus") == CANCELLED_STATUS) & (
        key % CANCELLED_ORDER_MODULUS == 0
    )
    minutes = F.lit(MINUTE_OFFSET_BASE) + key % MINUTE_OFFSET_MODULUS
    placed_at = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0)
    )
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, F.col("c_nationkey") == nations.n_nationkey)
        .select(
            key.alias("order_key"),
            cancelled.alias("order_cancelled"),
            F.when(cancelled, F.concat(F.lit("C"), _text(key)))
            .otherwise(_text(key))
            .alias("InvoiceNo"),
            F.date_format(placed_at, FIXTURE_TIMESTAMP_PATTERN).alias("order_time_text"),
            F.when(key % MISSING_CUSTOMER_MODULUS == 3, F.lit(None).cast("string"))
            .when(key % MISSING_CUSTOMER_MODULUS == 4, F.lit("  "))
            .otherwise(_text(F.col("o_custkey")))
            .alias("CustomerID"),
            F.when(F.col("o_custkey") % MISSING_COUNTRY_MODULUS == 0, F.lit(None).cast("string"))
            .otherwise(F.col("n_name"))
            .alias("Country"),
        )
    )


def _part_side(part: DataFrame) -> DataFrame:
    part = part.select("p_partkey", "p_name", "p_retailprice")
    key = F.col("p_partkey")
    price_text = F.replace(
        _text(F.col("p_retailprice").cast("decimal(18,2)")), F.lit("."), F.lit(",")
    )
    return part.select(
        key.alias("part_key"),
        F.concat(F.lit("P"), _text(key)).alias("StockCode"),
        F.when(key % MISSING_DESCRIPTION_MODULUS == 0, F.lit(None).cast("string"))
        .when(key % MISSING_DESCRIPTION_MODULUS == 1, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")))
        .alias("Description"),
        F.when(key % BAD_PRICE_MODULUS == 0, F.lit("0"))
        .when(key % BAD_PRICE_MODULUS == 1, F.lit("N/A"))
        .when(key % BAD_PRICE_MODULUS == 2, F.concat(price_text, F.lit("5")))
        .when(key % BAD_PRICE_MODULUS == 3, F.concat(price_text, F.lit("125")))
        .when(key % BAD_PRICE_MODULUS == 4, F.concat(F.lit("0,0000"), _text(key % 900 + 100)))
        .when(key % BAD_PRICE_MODULUS == 5, F.concat(F.lit("1."), price_text))
        .otherwise(price_text)
        .alias("UnitPrice"),
    )


def raw_invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoice lines (8 string columns), one per ``lineitem`` row of the
    test tables under ``sf_dir``."""
    return invoice_lines_from_tables(
        *(_table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "nation", "part"))
    )


def invoice_lines_from_tables(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    part: DataFrame,
) -> DataFrame:
    """Raw invoice lines from the five star-schema frames.

    Repeated ``(l_orderkey, l_linenumber)`` pairs are kept: the original job
    never de-duplicates invoice lines.
    """
    keyed = F.col("l_orderkey").isNotNull() & F.col("l_partkey").isNotNull()  # others join nothing
    lines = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity").filter(keyed)
    orders = _order_side(orders, customer, nation)
    parts = _part_side(part)

    # Line x part goes first, and is left to Catalyst's size-checked broadcast; a part
    # side too large for it shuffles four numbers a line.  Line x order is a
    # fact-to-fact join: at any real scale neither side fits a broadcast, so it is
    # declared as a shuffle (sort-merge) join on the order key; AQE splits a skewed
    # order key.  Being last, it leaves the lines of an order together, whatever the
    # part join was, so the aggregates by invoice collapse them before their shuffle.
    joined = lines.join(parts, lines.l_partkey == parts.part_key).join(
        orders.hint("merge"), lines.l_orderkey == orders.order_key
    )
    whole_quantity = _text(F.col("l_quantity").cast("bigint"))
    quantity_dirt = (F.col("l_orderkey") + F.col("l_linenumber")) % BAD_QUANTITY_MODULUS
    quantity = (
        F.when(quantity_dirt == 0, F.lit("abc"))
        .when(quantity_dirt == 1, F.lit("0"))
        .when(quantity_dirt == 2, F.lit(SMALLEST_INT_TEXT))
        .when(F.col("order_cancelled"), F.concat(F.lit("-"), whole_quantity))
        .otherwise(whole_quantity)
    )
    invoice_date = F.when(
        (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % BAD_DATE_MODULUS == 0,
        F.lit(IMPOSSIBLE_DATE_TEXT),
    ).otherwise(F.col("order_time_text"))
    return joined.select(
        "InvoiceNo",
        "StockCode",
        "Description",
        quantity.alias("Quantity"),
        invoice_date.alias("InvoiceDate"),
        "UnitPrice",
        "CustomerID",
        "Country",
    )
