"""Plan-shape checks: no Python UDFs, one scan per source in
profiles, no single-partition exchange below the first aggregate, pruning and
pushdown reach the parquet scan."""

from __future__ import annotations

import re

import pytest

from conftest import SF_SMALL
from tillsight.plans.registry import registered_queries


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def queries():
    return registered_queries()


@pytest.mark.parametrize("key", sorted(registered_queries()))
def test_no_python_udf(spark, queries, key):
    plan = _plan(queries[key](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, key


@pytest.mark.parametrize(
    "key", ["null_or_empty_profile_raw", "null_profile_strict", "cleaning_summary", "raw_row_count"]
)
def test_profiles_scan_each_source_once(spark, queries, key):
    plan = queries[key](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    for column in ("l_orderkey", "o_orderkey", "c_custkey", "n_nationkey", "p_partkey"):
        assert len([s for s in scans if re.search(rf"\[{column}#", s)]) == 1, (key, column)


@pytest.mark.parametrize(
    "key",
    ["monthly_sales_trend", "country_performance", "overall_kpis", "customer_rfm", "product_performance"],
)
def test_no_single_partition_exchange_on_fact_rows(spark, queries, key):
    """A SinglePartition exchange may only sit above an aggregate (one row per
    task or per group), never directly over line-grain rows."""
    plan = queries[key](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = "\n".join(lines[i + 1 : i + 3])
            assert "HashAggregate" in below or "TakeOrdered" in below, (key, below)


def test_pruning_reaches_scan(spark, queries):
    plan = queries["monthly_sales_trend"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    lineitem = next(l for l in plan.splitlines() if "FileScan parquet" in l and "l_orderkey" in l)
    assert "l_extendedprice" not in lineitem and "l_shipdate" not in lineitem
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in lineitem


def test_fact_join_is_shuffled_not_broadcast(spark, queries):
    plan = queries["cleaned_sales"](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan
    # lineitem (the fact table) is never a broadcast build side
    broadcast_builds = [l for l in plan.splitlines() if "BroadcastExchange" in l]
    assert not any("l_orderkey" in l for l in broadcast_builds)


def test_hot_customer_is_spread_by_invoice(spark, raw_frame):
    """A customer holding a third of all lines: the first shuffle of the
    customer table is keyed by (CustomerID, InvoiceNo), so the hot customer's
    lines are spread over tasks, and map-side partial aggregation runs first."""
    from tillsight.operators.customers import customer_performance
    from tillsight.operators.prepare import cleaned_sales, typed_sales

    rows = [
        (str(i), "S", "x", "1", "05/01/2011 10:00", "1", "HOT" if i % 3 == 0 else str(i), "UK")
        for i in range(300)
    ]
    df = customer_performance(cleaned_sales(typed_sales(raw_frame(rows))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]
    assert any("CustomerID" in l and "InvoiceNo" in l for l in exchanges), exchanges
    lines = plan.splitlines()
    first_exchange = max(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert "HashAggregate" in lines[first_exchange + 1]  # partial aggregate below the shuffle
    got = {r["CustomerID"]: r["CustomerOrderCount"] for r in df.collect()}
    assert got["HOT"] == 100


def test_job_cli_end_to_end(spark, tmp_path, capsys):
    from tillsight.job import main
    from tillsight.operators.quality import null_or_empty_profile
    from tillsight.plans.scratch import new_run_dir
    from tillsight.sinks.files import write_csv
    from tillsight.sources.fixture import raw_invoice_lines

    landing = new_run_dir(spark, "job-input")
    write_csv(raw_invoice_lines(spark, SF_SMALL), landing, sep=";")
    out = str(tmp_path / "out")
    import os

    from tillsight.plans.scratch import checkpoint_root

    scratch = os.path.join(checkpoint_root(spark).removeprefix("file:"), "tillsight")
    staged = lambda: sorted(f for f in os.listdir(scratch) if f.startswith(("raw-", "typed-", "invoice-rollup-")))
    before = staged()
    assert main([landing, out, "--focus-country", "NATION_7", "--show", "3"]) == 0
    assert staged() == before  # the run's own folders are gone
    shown = capsys.readouterr().out
    for title in ("Raw lines", "Raw null or empty values", "Raw NULL values", "Cleaning summary", "Cleaned lines", "Exported tables", "overall_kpis"):
        assert f"=== {title}" in shown
    profile = shown.split("=== Raw null or empty values")[1].splitlines()
    raw = raw_invoice_lines(spark, SF_SMALL)
    wanted = null_or_empty_profile(raw).first()
    names = [c.strip() for c in profile[2].strip("|").split("|")]
    assert dict(zip(names, (int(v) for v in profile[4].strip("|").split("|")))) == wanted.asDict()

    assert sorted(os.listdir(out))[:3] == ["bottom_products_by_revenue", "country_performance", "customer_rfm_top"]
    assert len(os.listdir(out)) == 15


def test_hot_order_key_is_split_by_aqe(spark):
    """One order holds a third of all lines: the declared line x order
    sort-merge join is split by AQE's skew handling, and results stay exact."""
    import datetime as dt

    from pyspark.sql import functions as F

    from tillsight.sources.fixture import invoice_lines_from_tables

    n = 3000
    lineitem = spark.createDataFrame(
        [(0 if i % 3 == 0 else i, i % 50, i, 1.0 + i % 7) for i in range(n)],
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double",
    )
    orders = spark.createDataFrame(
        [(i, i % 40, "F", dt.datetime(2011, 1, 1) + dt.timedelta(days=i % 300)) for i in range(n)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    )
    customer = spark.createDataFrame([(i, i % 5) for i in range(40)], "c_custkey bigint, c_nationkey int")
    nation = spark.createDataFrame([(i, f"NATION_{i}") for i in range(5)], "n_nationkey int, n_name string")
    part = spark.createDataFrame([(i, f"part {i}", 10.0 + i) for i in range(50)], "p_partkey bigint, p_name string, p_retailprice double")

    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    previous = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        raw = invoice_lines_from_tables(lineitem, orders, customer, nation, part)
        rows = raw.groupBy("InvoiceNo").agg(F.count(F.lit(1)).alias("n"))
        got = {r["InvoiceNo"]: r["n"] for r in rows.collect()}
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got["0"] == n // 3 and sum(got.values()) == n
    assert "SortMergeJoin(skew=true)" in plan or "isSkewJoin=true" in plan, plan


def test_staged_tables_prune_and_push_down(spark):
    """Tables over the staged Parquet read only their columns; the cleaning
    predicates that parquet can evaluate are pushed into the scan."""
    from tillsight.plans.export import staged_tables
    from tillsight.plans.registry import FIXTURE_PARAMS
    from tillsight.sources.fixture import raw_invoice_lines

    tables = staged_tables(spark, raw_invoice_lines(spark, SF_SMALL), FIXTURE_PARAMS)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        products = tables.top_products_by_revenue()._jdf.queryExecution().executedPlan().toString()
        customers = tables.customer_performance()._jdf.queryExecution().executedPlan().toString()
        monthly = tables.monthly_sales_trend()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(l for l in products.splitlines() if "FileScan parquet" in l)
    assert "GreaterThan(Quantity,0)" in scan and "IsNotNull(IsCancelled)" in scan
    assert "Country" not in scan.split("ReadSchema")[1]
    scan = next(l for l in customers.splitlines() if "FileScan parquet" in l)
    assert "invoice-rollup" in scan
    assert scan.split("ReadSchema: ")[1].startswith(
        "struct<InvoiceNo:string,CustomerID:string,Revenue:decimal(38,2),Quantity:bigint,InvoiceDateOnly:date>"
    )
    scan = next(l for l in monthly.splitlines() if "FileScan parquet" in l)
    assert "dimension-rollup" in scan and "EqualTo(Dimension,31)" in scan


def test_month_extremes_read_the_months_once(spark):
    from tillsight.plans.registry import fixture_tables

    plan = _plan(fixture_tables(spark, SF_SMALL).monthly_revenue_extremes())
    assert "Union" not in plan and plan.count("TakeOrdered") == 0


ORDERS = {
    "monthly_sales_trend": [("YearMonth", 1)],
    "weekday_sales": [("DayOfWeekNumber", 1)],
    "hourly_sales": [("Hour", 1)],
    "product_performance": None,
    "top_products_by_quantity": [("ProductQuantitySold", -1)],
    "top_products_by_revenue": [("ProductRevenue", -1)],
    "bottom_products_by_revenue": [("ProductRevenue", 1)],
    "top_customers": [("CustomerRevenue", -1), ("CustomerOrderCount", -1), ("CustomerID", 1)],
    "customer_rfm_top": [("Monetary", -1), ("Frequency", -1), ("RecencyDays", 1), ("CustomerID", 1)],
    "customer_segment_summary": [("SegmentRevenue", -1), ("CustomerSegment", 1)],
    "country_performance": [("CountryRevenue", -1), ("CountryOrderCount", -1), ("Country", 1)],
    "top_countries_by_revenue": [("CountryRevenue", -1), ("CountryOrderCount", -1), ("Country", 1)],
    "market_share_uk_vs_non_uk": [("MarketRevenue", -1), ("Market", 1)],
    "potential_growth_markets": [("RevenuePerCustomer", 1), ("CountryCustomerCount", -1), ("CountryOrderCount", -1), ("Country", 1)],
    "top_products_chart": [("ProductRevenue", 1)],
    "top_countries_chart": [("CountryRevenue", 1)],
    "monthly_revenue_chart": [("YearMonth", 1)],
}


@pytest.mark.parametrize("key", sorted(k for k, v in ORDERS.items() if v))
def test_rows_come_in_the_tables_order(spark, queries, key):
    """L1: NULL first where a column ascends, last where it descends."""
    rows = queries[key](spark, SF_SMALL).collect()
    for a, b in zip(rows, rows[1:]):
        for column, way in ORDERS[key]:
            x, y = a[column], b[column]
            if x == y:
                continue
            assert (x is None) if way == 1 and None in (x, y) else (y is None) if None in (x, y) else (x < y) == (way == 1), (key, a, b)
            break


def test_five_tables_read_one_dimension_aggregate(spark):
    """The export's month, weekday, hour, country and market tables (and what is derived from them) read the
    staged dimension aggregate; none of them reads the invoice rollup again."""
    from tillsight.plans.export import staged_tables
    from tillsight.plans.registry import FIXTURE_PARAMS, fixture_tables
    from tillsight.plans.scratch import discard
    from tillsight.sources.fixture import raw_invoice_lines

    paths: list[str] = []
    tables = staged_tables(spark, raw_invoice_lines(spark, SF_SMALL), FIXTURE_PARAMS, paths=paths)
    direct = fixture_tables(spark, SF_SMALL)
    try:
        for name in (
            "monthly_sales_trend", "weekday_sales", "hourly_sales", "country_performance", "market_share_uk_vs_non_uk",
            "monthly_revenue_extremes", "top_countries_by_revenue", "potential_growth_markets",
        ):
            files = tables.table(name).inputFiles()
            assert files and all("dimension-rollup" in f for f in files), name
            assert tables.table(name).schema.simpleString() == direct.table(name).schema.simpleString()
            assert [tuple(r) for r in tables.table(name).collect()] == [tuple(r) for r in direct.table(name).collect()], name
    finally:
        discard(spark, paths)


def test_lines_of_an_order_stay_together_after_a_part_shuffle(spark):
    """A part side too large for a broadcast is joined before the orders, so the lines come out
    clustered by order and the aggregates by invoice collapse them within a task."""
    from pyspark.sql import functions as F

    from tillsight.sources.fixture import invoice_lines_from_tables

    tables = [
        spark.range(0, 4000, 1, 4).selectExpr("id DIV 8 AS l_orderkey", "id * 7 % 300 AS l_partkey", "CAST(id % 8 AS int) AS l_linenumber", "2D AS l_quantity"),
        spark.range(500).selectExpr("id AS o_orderkey", "id % 50 AS o_custkey", "'O' AS o_orderstatus", "timestamp_ntz'2011-01-01 00:00:00' AS o_orderdate"),
        spark.range(50).selectExpr("id AS c_custkey", "1 AS c_nationkey"),
        spark.sql("SELECT 1 AS n_nationkey, 'NATION_1' AS n_name"),
        spark.range(300).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "1.5D AS p_retailprice"),
    ]
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = invoice_lines_from_tables(*tables).select("InvoiceNo", F.spark_partition_id().alias("at"))
        spread = lines.groupBy("InvoiceNo").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("at").alias("parts")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(spread) == 500 and all(r.n == 8 and r.parts == 1 for r in spread)
