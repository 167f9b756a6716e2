"""RFM segment boundaries and ordering ties (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillsight.operators.customers import customer_rfm, customer_segment_summary
from tillsight.operators.prepare import cleaned_sales, typed_sales
from tillsight.plans.catalog import Params, SalesTables

ANALYSIS_DATE = dt.date(2011, 12, 10)


def _customer_rows(cid: str, monetary: str, frequency: int, recency: int | None):
    """``frequency`` one-line invoices adding up to ``monetary``, last one
    ``recency`` days before the analysis date (None: unparsable dates)."""
    if recency is None:
        when = "31/02/2011 10:00"
    else:
        when = (ANALYSIS_DATE - dt.timedelta(days=recency)).strftime("%d/%m/%Y 10:00")
    total = Decimal(monetary)
    rows = []
    for i in range(frequency):
        price = Decimal("0.01") if i < frequency - 1 else total - Decimal("0.01") * (frequency - 1)
        rows.append((f"{cid}-{i}", "S1", "item", "1", when, str(price).replace(".", ","), cid, "UK"))
    return rows


CASES = {
    # customer: (monetary, frequency, recency, expected segment)
    "m4999": ("4999.99", 10, 60, "Active"),
    "m5000": ("5000.00", 10, 60, "High Value"),
    "f9": ("5000.00", 9, 60, "Active"),
    "f10": ("5000.00", 10, 60, "High Value"),
    "r61": ("5000.00", 10, 61, "Active"),
    "r90": ("100.00", 5, 90, "Active"),
    "r91": ("100.00", 5, 91, "Regular"),
    "r180": ("100.00", 1, 180, "Regular"),
    "r181": ("100.00", 1, 181, "At Risk"),
    "nodate": ("100.00", 1, None, "Regular"),
    "anchor": ("1.00", 1, 1, "Regular"),  # holds the latest purchase date
}


def _rfm(raw_frame):
    rows = [r for cid, (m, f, rec, _) in CASES.items() for r in _customer_rows(cid, m, f, rec)]
    return customer_rfm(cleaned_sales(typed_sales(raw_frame(rows))))


def test_segment_boundaries(raw_frame):
    got = {r["CustomerID"]: r for r in _rfm(raw_frame).collect()}
    for cid, (m, f, rec, seg) in CASES.items():
        r = got[cid]
        assert r["CustomerSegment"] == seg, cid
        assert r["Monetary"] == Decimal(m) and r["Frequency"] == f
        assert r["RecencyDays"] == rec
        assert r["AnalysisDate"] == ANALYSIS_DATE


def test_segment_summary_exact_averages(raw_frame):
    summary = {r["CustomerSegment"]: r for r in customer_segment_summary(_rfm(raw_frame)).collect()}
    assert summary["High Value"]["CustomerCount"] == 2
    assert summary["Active"]["CustomerCount"] == 4
    # Active: frequencies 10, 9, 10, 5 -> 8.5; recency 60, 60, 61, 90 -> 67.75
    assert summary["Active"]["AverageFrequency"] == Decimal("8.50")
    assert summary["Active"]["AverageRecencyDays"] == Decimal("67.75")
    # Regular recency ignores the NULL-date customer: (91 + 180 + 1) / 3 = 90.67
    assert summary["Regular"]["AverageRecencyDays"] == Decimal("90.67")
    assert summary["Regular"]["CustomerCount"] == 4


def test_month_tie_goes_to_earlier_month(raw_frame):
    rows = [
        ("1", "S", "x", "1", "05/01/2011 10:00", "10", "1", "UK"),
        ("2", "S", "x", "1", "05/02/2011 10:00", "10", "1", "UK"),
        ("3", "S", "x", "1", "05/03/2011 10:00", "5", "1", "UK"),
        ("4", "S", "x", "1", "05/04/2011 10:00", "5", "1", "UK"),
    ]
    typed = typed_sales(raw_frame(rows))
    t = SalesTables(typed, cleaned_sales(typed), Params())
    got = {r["Metric"]: r["YearMonth"] for r in t.monthly_revenue_extremes().collect()}
    assert got == {"HighestRevenueMonth": "2011-01", "LowestRevenueMonth": "2011-03"}


def test_null_country_asymmetry(raw_frame):
    rows = [
        ("1", "S", "x", "1", "05/01/2011 10:00", "10", "1", None),
        ("2", "S", "x", "1", "05/01/2011 10:00", "10", "2", "United Kingdom"),
        ("3", "S", "x", "1", "05/01/2011 10:00", "10", "3", "France"),
    ]
    typed = typed_sales(raw_frame(rows))
    t = SalesTables(typed, cleaned_sales(typed), Params())
    countries = {r["Country"] for r in t.country_performance().collect()}
    assert countries == {None, "United Kingdom", "France"}
    markets = {r["Market"]: r["MarketOrderCount"] for r in t.market_share_uk_vs_non_uk().collect()}
    assert markets == {"United Kingdom": 1, "Non-UK": 2}
    growth = t.potential_growth_markets()
    assert growth.count() == 0  # below thresholds
    from tillsight.operators.markets import MarketRules

    t2 = SalesTables(typed, cleaned_sales(typed), Params(market=MarketRules(min_customers=1, min_orders=1)))
    assert {r["Country"] for r in t2.potential_growth_markets().collect()} == {"France"}


def test_empty_cleaned_table_gives_null_ratios(raw_frame):
    typed = typed_sales(raw_frame([("C1", "S", "x", "-1", "05/01/2011 10:00", "10", "1", "UK")]))
    t = SalesTables(typed, cleaned_sales(typed), Params())
    r = t.overall_kpis().first()
    assert r["TotalOrders"] == 0 and r["TotalRevenue"] is None
    assert r["AverageOrderValue"] is None and r["AverageRevenuePerCustomer"] is None
    assert r["CancelledOrders"] == 1 and r["TotalRawInvoices"] == 1
    assert r["CancellationRatePercent"] == Decimal("100.00")


def test_rfm_is_lazy_and_reads_the_facts_once(raw_frame, spark, tmp_path):
    rows = [r for cid, (m, f, rec, _) in CASES.items() for r in _customer_rows(cid, m, f, rec)]
    raw_frame(rows).write.parquet(f"{tmp_path}/raw")
    tracker, group = spark.sparkContext.statusTracker(), "building-rfm"
    spark.sparkContext.setJobGroup(group, group)
    try:
        raw = spark.read.schema(raw_frame(rows).schema).parquet(f"{tmp_path}/raw")
        before = len(tracker.getJobIdsForGroup(group))
        cleaned = cleaned_sales(typed_sales(raw))
        table = SalesTables(cleaned, cleaned, Params()).customer_segment_summary()
        assert len(tracker.getJobIdsForGroup(group)) == before
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert table.count() > 0
    rfm = customer_rfm(cleaned)
    rfm.collect()
    final = rfm._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final, final
    assert "(max(struct(LastPurchaseDate" in final.replace("named_struct", "struct") or "max(" in final


def test_rfm_anchor_is_the_last_purchase_of_all(raw_frame):
    rows = [r for cid, (m, f, rec, _) in CASES.items() for r in _customer_rows(cid, m, f, rec)]
    cleaned = cleaned_sales(typed_sales(raw_frame(rows)))
    from tillsight.operators.customers import analysis_date

    assert {r["AnalysisDate"] for r in customer_rfm(cleaned).collect()} == {analysis_date(cleaned).first()[0]}
