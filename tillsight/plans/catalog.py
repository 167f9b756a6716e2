"""Named result tables over one typed / cleaned pair.

``SalesTables`` wires the operators together; every accessor returns a lazy
DataFrame.  ``facts`` is what the time, customer and market tables group:
the cleaned lines by default, or the exact invoice-grain rollup when a plan
stages it once for many tables.  ``dimensions``, if given, holds the month, weekday, hour, country
and market measures of one shared aggregate (``rollup.dimension_rollup``); those tables are then read from it.

The aggregates several tables are derived from (monthly, product, customer,
RFM, country) are built once per instance; a multi-table plan can persist
them (``persist_shared``) so each is computed once for all its consumers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tillsight.functions.rounding import decimals_to_double
from tillsight.operators import customers as C
from tillsight.operators import kpis as K
from tillsight.operators import markets as N
from tillsight.operators import presentation as V
from tillsight.operators import products as R
from tillsight.operators import trends as M
from tillsight.plans.rollup import dimension


@dataclass(frozen=True)
class Params:
    market: N.MarketRules = field(default_factory=N.MarketRules)
    segments: C.SegmentRules = field(default_factory=C.SegmentRules)
    top_n: int = 10


# The fifteen tables the original job exports, in its order.
EXPORTED_TABLES = (
    "overall_kpis",
    "monthly_sales_trend",
    "weekday_sales",
    "hourly_sales",
    "monthly_revenue_extremes",
    "top_products_by_quantity",
    "top_products_by_revenue",
    "bottom_products_by_revenue",
    "top_customers",
    "customer_rfm_top",
    "customer_segment_summary",
    "country_performance",
    "top_countries_by_revenue",
    "market_share_uk_vs_non_uk",
    "potential_growth_markets",
)


# Aggregates read by more than one exported table.
SHARED_AGGREGATES = (
    "monthly_sales_trend",
    "product_performance",
    "customer_performance",
    "customer_rfm",
    "country_performance",
)
# Those of them that the shared dimension aggregate holds.
OF_DIMENSIONS = ("monthly_sales_trend", "country_performance")


class SalesTables:
    """Named result tables over one typed / cleaned pair.

    Each accessor returns a lazy DataFrame; the shared aggregates are built
    once per instance.  Call ``persist_shared`` before asking for tables when
    many of them will be computed (the export does).
    """

    def __init__(
        self,
        typed: DataFrame,
        cleaned: DataFrame,
        params: Params | None = None,
        facts: DataFrame | None = None,
        dimensions: DataFrame | None = None,
    ):
        self.typed = typed
        self.cleaned = cleaned
        self.params = params or Params()
        self.facts = cleaned if facts is None else facts
        self.dimensions = dimensions
        self._shared: dict[str, DataFrame] = {}

    def _once(self, name: str, build) -> DataFrame:
        if name not in self._shared:
            self._shared[name] = build()
        return self._shared[name]

    def persist_shared(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> dict[str, DataFrame]:
        """Persist the shared aggregates (in dependency order: RFM is derived
        from the customer aggregate) but those read from ``dimensions``; the caller materializes and unpersists."""
        names = [n for n in SHARED_AGGREGATES if self.dimensions is None or n not in OF_DIMENSIONS]
        for name in names:
            getattr(self, name)()
            self._shared[name] = self._shared[name].persist(level)
        return {name: self._shared[name] for name in names}

    def _grouped(self, name: str, measures: tuple[str, ...], lines) -> DataFrame:
        """A dimension's table from the shared aggregate, else from the ``lines`` it groups."""
        return lines() if self.dimensions is None else dimension(self.dimensions, name, *measures)

    # KPIs and time
    def overall_kpis(self) -> DataFrame:
        return K.overall_kpis(self.typed)

    def sales_kpis(self) -> DataFrame:
        return K.sales_kpis(self.cleaned)

    def cancellation_kpis(self) -> DataFrame:
        return K.cancellation_kpis(self.typed)

    def monthly_sales_trend(self) -> DataFrame:
        return self._once("monthly_sales_trend", self._monthly)

    def _monthly(self) -> DataFrame:
        return self._grouped("month", M.MONTHLY_MEASURES, lambda: M.monthly_sales_trend(self.facts)).orderBy("YearMonth")

    def weekday_sales(self) -> DataFrame:
        return self._grouped("weekday", M.WEEKDAY_MEASURES, lambda: M.weekday_sales(self.facts)).orderBy("DayOfWeekNumber")

    def hourly_sales(self) -> DataFrame:
        return self._grouped("hour", M.HOURLY_MEASURES, lambda: M.hourly_sales(self.facts)).orderBy("Hour")

    def monthly_revenue_extremes(self) -> DataFrame:
        return M.monthly_revenue_extremes(self.monthly_sales_trend())

    # products
    def product_performance(self) -> DataFrame:
        return self._once("product_performance", lambda: R.product_performance(self.cleaned))

    def top_products_by_quantity(self) -> DataFrame:
        return R.top_products_by_quantity(self.product_performance(), self.params.top_n)

    def top_products_by_revenue(self) -> DataFrame:
        return R.top_products_by_revenue(self.product_performance(), self.params.top_n)

    def bottom_products_by_revenue(self) -> DataFrame:
        return R.bottom_products_by_revenue(self.product_performance(), self.params.top_n)

    # customers
    def customer_performance(self) -> DataFrame:
        return self._once("customer_performance", lambda: C.customer_performance(self.facts))

    def top_customers(self) -> DataFrame:
        return C.top_customers(self.customer_performance(), self.params.top_n)

    def analysis_date(self) -> DataFrame:
        return C.analysis_date(self.facts)

    def customer_rfm(self) -> DataFrame:
        return self._once(
            "customer_rfm",
            lambda: C.customer_rfm(self.facts, self.params.segments, self.customer_performance()),
        )

    def customer_rfm_top(self) -> DataFrame:
        return C.customer_rfm_top(self.customer_rfm(), self.params.top_n)

    def customer_segment_summary(self) -> DataFrame:
        return C.customer_segment_summary(self.customer_rfm())

    # countries and markets
    def country_performance(self) -> DataFrame:
        return self._once("country_performance", self._countries)

    def _countries(self) -> DataFrame:
        if self.dimensions is None:
            return N.country_performance(self.facts)
        return N.in_country_order(dimension(self.dimensions, "country", *N.COUNTRY_MEASURES))

    def top_countries_by_revenue(self) -> DataFrame:
        return N.top_countries_by_revenue(self.country_performance(), self.params.top_n)

    def market_share_uk_vs_non_uk(self) -> DataFrame:
        if self.dimensions is None:
            return N.market_share(self.facts, self.params.market)
        return N.with_market_shares(dimension(self.dimensions, "market", *N.MARKET_MEASURES))

    def potential_growth_markets(self) -> DataFrame:
        return N.potential_growth_markets(self.country_performance(), self.params.market)

    # viewer and chart feeds
    def top_hours_by_revenue(self) -> DataFrame:
        return V.top_hours_by_revenue(self.hourly_sales(), self.params.top_n)

    def market_share_chart(self) -> DataFrame:
        return V.market_share_chart(self.market_share_uk_vs_non_uk())

    def customer_segment_share_chart(self) -> DataFrame:
        return V.customer_segment_share_chart(self.customer_segment_summary())

    def top_products_chart(self) -> DataFrame:
        return V.top_products_chart(self.top_products_by_revenue())

    def top_countries_chart(self) -> DataFrame:
        return V.top_countries_chart(self.top_countries_by_revenue())

    def monthly_revenue_chart(self) -> DataFrame:
        return V.monthly_revenue_chart(self.monthly_sales_trend())

    def weekday_revenue_chart(self) -> DataFrame:
        return V.weekday_revenue_chart(self.weekday_sales())

    def hourly_orders_chart(self) -> DataFrame:
        return V.hourly_orders_chart(self.hourly_sales())

    def formatted_kpis(self) -> DataFrame:
        return V.formatted_kpis(self.overall_kpis())

    def scaled_revenue_labels(self) -> DataFrame:
        return V.scaled_revenue_labels(self.monthly_sales_trend())

    def scaled_chart_labels(self) -> DataFrame:
        return V.scaled_chart_labels(
            self.weekday_sales(), self.top_products_by_revenue(), self.top_countries_by_revenue()
        )

    def table(self, name: str) -> DataFrame:
        """A named table, published with money as double."""
        return decimals_to_double(getattr(self, name)())

    def exported(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in EXPORTED_TABLES}
