"""Pinned fixture results (FIXTURES.md §3) and cross-table invariants."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillsight.operators import quality as P
from tillsight.plans.catalog import SalesTables
from tillsight.plans.registry import FIXTURE_PARAMS, fixture_tables
from tillsight.plans.rollup import invoice_rollup

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def tables(spark):
    return fixture_tables(spark, SF_SMALL)


def test_pinned_cleaning_counts(tables):
    s = P.cleaning_summary(tables.typed).first().asDict()
    assert s == {
        "RawRows": 6000,
        "CleanedRows": 4210,
        "RemovedRows": 1790,
        "CancelledRows": 414,
        "EmptyDescriptionRows": 200,
        "EmptyCustomerIdRows": 1093,
        "InvalidQuantityRows": 477,
        "InvalidUnitPriceRows": 273,
    }
    c = tables.cleaned
    assert c.filter(F.col("InvoiceDate").isNull()).count() == 19
    assert c.filter(F.col("Country").isNull()).count() == 42
    assert tables.typed.filter(F.col("InvoiceDate").isNull()).count() == 26


def test_pinned_kpis(tables):
    k = tables.overall_kpis().first()
    assert k["TotalRevenue"] == Decimal("95252224.56")
    assert (k["TotalOrders"], k["TotalQuantitySold"]) == (1113, 106659)
    assert (k["TotalCustomers"], k["TotalProducts"], k["TotalCountries"]) == (150, 187, 25)
    assert (k["TotalRawInvoices"], k["CancelledOrders"]) == (1473, 97)


def test_pinned_segments(tables):
    got = {
        r["CustomerSegment"]: (r["CustomerCount"], r["SegmentRevenue"])
        for r in tables.customer_segment_summary().collect()
    }
    assert got == {
        "Active": (32, Decimal("22351036.30")),
        "At Risk": (80, Decimal("42880274.46")),
        "High Value": (11, Decimal("10479010.27")),
        "Regular": (27, Decimal("19541903.53")),
    }


def test_pinned_markets_and_months(tables):
    m = {r["Market"]: r for r in tables.market_share_uk_vs_non_uk().collect()}
    assert (m["NATION_7"]["MarketRevenue"], m["NATION_7"]["MarketOrderCount"],
            m["NATION_7"]["MarketCustomerCount"]) == (Decimal("1598016.52"), 18, 3)
    assert (m["Rest of World"]["MarketRevenue"], m["Rest of World"]["MarketOrderCount"],
            m["Rest of World"]["MarketCustomerCount"]) == (Decimal("93654208.04"), 1095, 147)
    assert tables.potential_growth_markets().count() == 18
    ext = {r["Metric"]: (r["YearMonth"], r["MonthlyRevenue"]) for r in tables.monthly_revenue_extremes().collect()}
    assert ext == {
        "HighestRevenueMonth": ("2001-07", Decimal("2673681.83")),
        "LowestRevenueMonth": ("2001-08", Decimal("105234.00")),
    }
    months = tables.monthly_sales_trend().filter(F.col("YearMonth").isNotNull()).count()
    hours = tables.hourly_sales().filter(F.col("Hour").isNotNull()).count()
    assert (months, hours) == (80, 14)


def _total(df, col):
    return df.agg(F.sum(col).alias("t")).first()["t"]


def test_revenue_invariants(tables):
    total = tables.sales_kpis().first()["TotalRevenue"]
    assert _total(tables.monthly_sales_trend(), "MonthlyRevenue") == total
    assert _total(tables.weekday_sales(), "WeekdayRevenue") == total
    assert _total(tables.hourly_sales(), "HourlyRevenue") == total
    assert _total(tables.product_performance(), "ProductRevenue") == total
    assert _total(tables.country_performance(), "CountryRevenue") == total
    assert _total(tables.customer_performance(), "CustomerRevenue") == total
    assert _total(tables.customer_segment_summary(), "CustomerCount") == tables.sales_kpis().first()["TotalCustomers"]
    share = _total(tables.market_share_uk_vs_non_uk(), "RevenueSharePercent")
    assert abs(share - Decimal(100)) <= Decimal("0.01")


def test_rollup_facts_give_identical_tables(spark, tables):
    rolled = SalesTables(tables.typed, tables.cleaned, FIXTURE_PARAMS, invoice_rollup(tables.cleaned))
    for name in (
        "monthly_sales_trend", "weekday_sales", "hourly_sales", "customer_performance",
        "customer_rfm", "customer_segment_summary", "country_performance",
        "market_share_uk_vs_non_uk", "potential_growth_markets", "monthly_revenue_extremes",
    ):
        a, b = tables.table(name), rolled.table(name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
        assert a.count() == b.count(), name


def test_profiles_single_aggregate(tables):
    raw_profile = P.null_or_empty_profile(tables.typed).first().asDict()
    assert raw_profile["Description"] == 200 and raw_profile["CustomerID"] == 1093
    strict = P.null_profile_strict(tables.typed).first().asDict()
    assert strict["CustomerID"] < raw_profile["CustomerID"]  # blank is not NULL
