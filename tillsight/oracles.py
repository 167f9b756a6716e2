"""Independent DuckDB SQL for every registered query (the correctness gate).

Each statement is self-contained: it rebuilds the raw invoice lines from the
test tables (FIXTURES.md §3), types and cleans them, then computes one table.
Rounding is done with integer HALF_UP arithmetic on cents, which is exact;
DuckDB-specific type differences (HUGEINT sums, BIGINT hour, Sunday = 0) are
cast back to Spark's types.
"""

from __future__ import annotations

from tillsight.plans.catalog import EXPORTED_TABLES

FOCUS_COUNTRY = "NATION_7"
REST_LABEL = "Rest of World"

BASE = """
WITH ord AS (
  SELECT o.o_orderkey AS order_key,
         (o.o_orderstatus = 'P' AND o.o_orderkey % 5 = 0) AS order_cancelled,
         CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 5 = 0
              THEN 'C' || CAST(o.o_orderkey AS VARCHAR)
              ELSE CAST(o.o_orderkey AS VARCHAR) END AS InvoiceNo,
         strftime(CAST(o.o_orderdate AS TIMESTAMP)
                  + to_minutes(CAST(360 + o.o_orderkey % 840 AS BIGINT)),
                  '%d/%m/%Y %H:%M') AS order_time_text,
         CASE WHEN o.o_orderkey % 11 = 3 THEN NULL
              WHEN o.o_orderkey % 11 = 4 THEN '  '
              ELSE CAST(o.o_custkey AS VARCHAR) END AS CustomerID,
         CASE WHEN o.o_custkey % 149 = 0 THEN NULL ELSE n.n_name END AS Country
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
prt AS (
  SELECT p_partkey AS part_key,
         'P' || CAST(p_partkey AS VARCHAR) AS StockCode,
         CASE WHEN p_partkey % 97 = 0 THEN NULL
              WHEN p_partkey % 97 = 1 THEN '   '
              ELSE ' ' || p_name || ' ' END AS Description,
         CASE WHEN p_partkey % 89 = 0 THEN '0'
              WHEN p_partkey % 89 = 1 THEN 'N/A'
              WHEN p_partkey % 89 = 2
                THEN replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') || '5'
              WHEN p_partkey % 89 = 3
                THEN replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') || '125'
              WHEN p_partkey % 89 = 4 THEN '0,0000' || CAST(p_partkey % 900 + 100 AS VARCHAR)
              WHEN p_partkey % 89 = 5
                THEN '1.' || replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
              ELSE replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         END AS UnitPrice
  FROM part
),
raw AS (
  SELECT o.InvoiceNo, p.StockCode, p.Description,
         CASE WHEN (l.l_orderkey + l.l_linenumber) % 223 = 0 THEN 'abc'
              WHEN (l.l_orderkey + l.l_linenumber) % 223 = 1 THEN '0'
              WHEN (l.l_orderkey + l.l_linenumber) % 223 = 2 THEN '-2147483648'
              WHEN o.order_cancelled THEN '-' || CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR)
              ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS Quantity,
         CASE WHEN (l.l_orderkey * 7 + l.l_linenumber) % 199 = 0 THEN '31/02/2011 08:26'
              ELSE o.order_time_text END AS InvoiceDate,
         p.UnitPrice, o.CustomerID, o.Country
  FROM lineitem l
  JOIN ord o ON l.l_orderkey = o.order_key
  JOIN prt p ON l.l_partkey = p.part_key
),
typed AS (
  SELECT trim(InvoiceNo) AS InvoiceNo,
         trim(StockCode) AS StockCode,
         trim(Description) AS Description,
         TRY_CAST(trim(Quantity) AS INTEGER) AS Quantity,
         try_strptime(trim(InvoiceDate), '%d/%m/%Y %H:%M') AS InvoiceDate,
         TRY_CAST(replace(trim(UnitPrice), ',', '.') AS DECIMAL(27,10)) AS UnitPrice,
         trim(CustomerID) AS CustomerID,
         trim(Country) AS Country,
         starts_with(trim(InvoiceNo), 'C') AS IsCancelled
  FROM raw
),
cleaned AS (
  SELECT *,
         round(CAST(Quantity AS DECIMAL(10,0)) * UnitPrice, 2) AS Revenue,
         CAST(InvoiceDate AS DATE) AS InvoiceDateOnly,
         CAST(year(InvoiceDate) AS INTEGER) AS Year,
         CAST(month(InvoiceDate) AS INTEGER) AS Month,
         strftime(InvoiceDate, '%Y-%m') AS YearMonth,
         dayname(InvoiceDate) AS DayOfWeek,
         CAST(hour(InvoiceDate) AS INTEGER) AS Hour
  FROM typed
  WHERE Description IS NOT NULL AND trim(Description) <> ''
    AND CustomerID IS NOT NULL AND trim(CustomerID) <> ''
    AND Quantity IS NOT NULL AND Quantity > 0
    AND UnitPrice IS NOT NULL AND UnitPrice > 0
    AND NOT IsCancelled
)"""


def _cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def half_up(p: str, q: str, scale: int) -> str:
    """round(p / q, scale) HALF_UP for integer p >= 0, q >= 0; NULL when q = 0."""
    shift = 10**scale
    return (
        f"CASE WHEN ({q}) = 0 THEN NULL ELSE "
        f"CAST(((2 * {shift} * CAST({p} AS HUGEINT) + CAST({q} AS HUGEINT)) "
        f"// (2 * CAST({q} AS HUGEINT))) AS DOUBLE) / {shift} END"
    )


def money_ratio(money: str, count: str, scale: int = 2) -> str:
    return half_up(_cents(money), f"CAST({count} AS HUGEINT) * 100", scale)


def money_percent(part: str, whole: str, scale: int = 2) -> str:
    return half_up(f"{_cents(part)} * 100", _cents(whole), scale)


def count_percent(part: str, whole: str, scale: int = 2) -> str:
    return half_up(f"CAST({part} AS HUGEINT) * 100", whole, scale)


def avg_half_up(col: str, scale: int = 2) -> str:
    return half_up(f"sum({col})", f"count({col})", scale)


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


# ---------------------------------------------------------------- table CTEs
# Shared CTE bodies appended after BASE; they keep money as exact DECIMAL and
# each statement's final SELECT publishes doubles.

MONTHLY = """monthly AS (
  SELECT YearMonth, round(sum(Revenue), 2) AS MonthlyRevenue,
         count(DISTINCT InvoiceNo) AS MonthlyOrders, sum(Quantity) AS MonthlyQuantitySold
  FROM cleaned GROUP BY YearMonth)"""

WEEKDAY = """weekday AS (
  SELECT CAST(dayofweek(InvoiceDate) + 1 AS INTEGER) AS DayOfWeekNumber, DayOfWeek,
         round(sum(Revenue), 2) AS WeekdayRevenue,
         count(DISTINCT InvoiceNo) AS WeekdayOrders, sum(Quantity) AS WeekdayQuantitySold
  FROM cleaned GROUP BY 1, 2)"""

HOURLY = """hourly AS (
  SELECT Hour, round(sum(Revenue), 2) AS HourlyRevenue,
         count(DISTINCT InvoiceNo) AS HourlyOrders, sum(Quantity) AS HourlyQuantitySold
  FROM cleaned GROUP BY Hour)"""

PRODUCTS = """products AS (
  SELECT StockCode, Description, sum(Quantity) AS ProductQuantitySold,
         round(sum(Revenue), 2) AS ProductRevenue, count(DISTINCT InvoiceNo) AS ProductOrderCount
  FROM cleaned GROUP BY StockCode, Description)"""

CUSTOMERS = """customers AS (
  SELECT CustomerID, round(sum(Revenue), 2) AS CustomerRevenue,
         count(DISTINCT InvoiceNo) AS CustomerOrderCount,
         sum(Quantity) AS CustomerQuantityPurchased, max(InvoiceDateOnly) AS LastPurchaseDate
  FROM cleaned GROUP BY CustomerID)"""

RFM = """rfm0 AS (
  SELECT c.CustomerID, c.CustomerRevenue AS Monetary, c.CustomerOrderCount AS Frequency,
         c.CustomerQuantityPurchased, c.LastPurchaseDate,
         (SELECT CAST(max(InvoiceDateOnly) + INTERVAL 1 DAY AS DATE) FROM cleaned) AS AnalysisDate
  FROM customers c),
rfm1 AS (
  SELECT *, CAST(date_diff('day', LastPurchaseDate, AnalysisDate) AS INTEGER) AS RecencyDays
  FROM rfm0),
rfm AS (
  SELECT *, CASE
      WHEN Monetary >= 5000 AND Frequency >= 10 AND RecencyDays <= 60 THEN 'High Value'
      WHEN Frequency >= 5 AND RecencyDays <= 90 THEN 'Active'
      WHEN RecencyDays > 180 THEN 'At Risk'
      ELSE 'Regular' END AS CustomerSegment
  FROM rfm1)"""

SEGMENTS = f"""segments AS (
  SELECT CustomerSegment, count(DISTINCT CustomerID) AS CustomerCount,
         round(sum(Monetary), 2) AS SegmentRevenue,
         {avg_half_up('Frequency')} AS AverageFrequency,
         {avg_half_up('RecencyDays')} AS AverageRecencyDays
  FROM rfm GROUP BY CustomerSegment)"""

COUNTRIES = """countries AS (
  SELECT Country, round(sum(Revenue), 2) AS CountryRevenue,
         count(DISTINCT InvoiceNo) AS CountryOrderCount,
         count(DISTINCT CustomerID) AS CountryCustomerCount, sum(Quantity) AS CountryQuantitySold
  FROM cleaned GROUP BY Country)"""

MARKETS = f"""markets0 AS (
  SELECT CASE WHEN Country = '{FOCUS_COUNTRY}' THEN '{FOCUS_COUNTRY}' ELSE '{REST_LABEL}' END AS Market,
         round(sum(Revenue), 2) AS MarketRevenue,
         count(DISTINCT InvoiceNo) AS MarketOrderCount,
         count(DISTINCT CustomerID) AS MarketCustomerCount, sum(Quantity) AS MarketQuantitySold
  FROM cleaned GROUP BY 1),
markets AS (
  SELECT *, {money_percent('MarketRevenue', 'sum(MarketRevenue) OVER ()')} AS RevenueSharePercent
  FROM markets0)"""

KPIS = f"""sales_kpis AS (
  SELECT round(sum(Revenue), 2) AS TotalRevenue, count(DISTINCT InvoiceNo) AS TotalOrders,
         sum(Quantity) AS TotalQuantitySold, count(DISTINCT CustomerID) AS TotalCustomers,
         count(DISTINCT StockCode) AS TotalProducts, count(DISTINCT Country) AS TotalCountries
  FROM cleaned),
cancel_kpis AS (
  SELECT count(DISTINCT InvoiceNo) AS TotalRawInvoices,
         count(DISTINCT CASE WHEN IsCancelled THEN InvoiceNo END) AS CancelledOrders
  FROM typed),
kpis0 AS (
  SELECT s.*, (SELECT CancelledOrders FROM cancel_kpis) AS CancelledOrders,
         (SELECT TotalRawInvoices FROM cancel_kpis) AS TotalRawInvoices
  FROM sales_kpis s),
kpis AS (
  SELECT *, {money_ratio('TotalRevenue', 'TotalOrders')} AS AverageOrderValue,
         {money_ratio('TotalRevenue', 'TotalCustomers')} AS AverageRevenuePerCustomer,
         {count_percent('CancelledOrders', 'TotalRawInvoices')} AS CancellationRatePercent
  FROM kpis0)"""


def _with(*ctes: str) -> str:
    return BASE + "".join(",\n" + c for c in ctes) + "\n"


MONTHLY_SELECT = (
    f"SELECT YearMonth, {dbl('MonthlyRevenue')} AS MonthlyRevenue, MonthlyOrders, "
    f"{big('MonthlyQuantitySold')} AS MonthlyQuantitySold FROM monthly"
)
WEEKDAY_SELECT = (
    f"SELECT DayOfWeekNumber, DayOfWeek, {dbl('WeekdayRevenue')} AS WeekdayRevenue, WeekdayOrders, "
    f"{big('WeekdayQuantitySold')} AS WeekdayQuantitySold FROM weekday"
)
HOURLY_SELECT = (
    f"SELECT Hour, {dbl('HourlyRevenue')} AS HourlyRevenue, HourlyOrders, "
    f"{big('HourlyQuantitySold')} AS HourlyQuantitySold FROM hourly"
)
PRODUCT_SELECT = (
    f"SELECT StockCode, Description, {big('ProductQuantitySold')} AS ProductQuantitySold, "
    f"{dbl('ProductRevenue')} AS ProductRevenue, ProductOrderCount FROM products"
)
CUSTOMER_SELECT = (
    f"SELECT CustomerID, {dbl('CustomerRevenue')} AS CustomerRevenue, CustomerOrderCount, "
    f"{big('CustomerQuantityPurchased')} AS CustomerQuantityPurchased, LastPurchaseDate FROM customers"
)
RFM_SELECT = (
    f"SELECT CustomerID, {dbl('Monetary')} AS Monetary, Frequency, "
    f"{big('CustomerQuantityPurchased')} AS CustomerQuantityPurchased, LastPurchaseDate, "
    f"AnalysisDate, RecencyDays, CustomerSegment FROM rfm"
)
SEGMENT_SELECT = (
    f"SELECT CustomerSegment, CustomerCount, {dbl('SegmentRevenue')} AS SegmentRevenue, "
    f"AverageFrequency, AverageRecencyDays FROM segments"
)
COUNTRY_SELECT = (
    f"SELECT Country, {dbl('CountryRevenue')} AS CountryRevenue, CountryOrderCount, "
    f"CountryCustomerCount, {big('CountryQuantitySold')} AS CountryQuantitySold FROM countries"
)
MARKET_SELECT = (
    f"SELECT Market, {dbl('MarketRevenue')} AS MarketRevenue, MarketOrderCount, "
    f"MarketCustomerCount, {big('MarketQuantitySold')} AS MarketQuantitySold, "
    f"RevenueSharePercent FROM markets"
)
KPI_SELECT = (
    f"SELECT {dbl('TotalRevenue')} AS TotalRevenue, TotalOrders, "
    f"{big('TotalQuantitySold')} AS TotalQuantitySold, TotalCustomers, TotalProducts, "
    f"TotalCountries, AverageOrderValue, AverageRevenuePerCustomer, CancelledOrders, "
    f"TotalRawInvoices, CancellationRatePercent FROM kpis"
)


def _growth(min_customers: int, min_orders: int) -> str:
    return _with(COUNTRIES) + (
        f"SELECT Country, {dbl('CountryRevenue')} AS CountryRevenue, CountryOrderCount, "
        f"CountryCustomerCount, {big('CountryQuantitySold')} AS CountryQuantitySold, "
        f"{money_ratio('CountryRevenue', 'CountryCustomerCount')} AS RevenuePerCustomer, "
        f"{money_ratio('CountryRevenue', 'CountryOrderCount')} AS RevenuePerOrder "
        f"FROM countries WHERE Country <> '{FOCUS_COUNTRY}' "
        f"AND CountryCustomerCount >= {min_customers} AND CountryOrderCount >= {min_orders}"
    )


TYPED_SELECT = (
    "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, "
    "CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country, IsCancelled FROM typed"
)
CLEANED_SELECT = (
    "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, "
    "CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country, IsCancelled, "
    "CAST(Revenue AS DOUBLE) AS Revenue, InvoiceDateOnly, Year, Month, YearMonth, DayOfWeek, Hour "
    "FROM cleaned"
)
RAW_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
               "CustomerID", "Country")
CLEANED_COLUMNS = RAW_COLUMNS + ("IsCancelled", "Revenue", "InvoiceDateOnly", "Year", "Month",
                                 "YearMonth", "DayOfWeek", "Hour")


def _blank_profile(table: str, columns: tuple[str, ...]) -> str:
    parts = ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS {c}"
        for c in columns
    )
    return f"SELECT {parts} FROM {table}"


def _order_all(columns: tuple[str, ...]) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in columns)


def _top(select_from: str, order: str, n: int = 10) -> str:
    return f"{select_from} ORDER BY {order} LIMIT {n}"


PRODUCT_TIE = "StockCode ASC NULLS FIRST, Description ASC NULLS FIRST"

def _raw_select(extra: str, source: str = "raw") -> str:
    return f"SELECT {', '.join(RAW_COLUMNS)}, {extra} FROM {source}"


# Of each exported table: the columns that identify a row's values, and the doubles.
_PRODUCT = (("StockCode", "Description", "ProductQuantitySold", "ProductOrderCount"), ("ProductRevenue",))
_COUNTRY = ("Country", "CountryOrderCount", "CountryCustomerCount", "CountryQuantitySold")
_MONTH = ("YearMonth", "MonthlyOrders", "MonthlyQuantitySold")
_NULL = "'NULL'"
EXPORT_COLUMNS = {
    "overall_kpis": (
        ("TotalOrders", "TotalQuantitySold", "TotalCustomers", "TotalProducts", "TotalCountries",
         "CancelledOrders", "TotalRawInvoices"),
        ("TotalRevenue", "AverageOrderValue", "AverageRevenuePerCustomer", "CancellationRatePercent"),
    ),
    "monthly_sales_trend": (_MONTH, ("MonthlyRevenue",)),
    "weekday_sales": (("DayOfWeekNumber", "DayOfWeek", "WeekdayOrders", "WeekdayQuantitySold"), ("WeekdayRevenue",)),
    "hourly_sales": (("Hour", "HourlyOrders", "HourlyQuantitySold"), ("HourlyRevenue",)),
    "monthly_revenue_extremes": (("Metric", *_MONTH), ("MonthlyRevenue",)),
    "top_products_by_quantity": _PRODUCT,
    "top_products_by_revenue": _PRODUCT,
    "bottom_products_by_revenue": _PRODUCT,
    "top_customers": (
        ("CustomerID", "CustomerOrderCount", "CustomerQuantityPurchased", "LastPurchaseDate"), ("CustomerRevenue",),
    ),
    "customer_rfm_top": (
        ("CustomerID", "Frequency", "CustomerQuantityPurchased", "LastPurchaseDate", "AnalysisDate", "RecencyDays",
         "CustomerSegment"),
        ("Monetary",),
    ),
    "customer_segment_summary": (
        ("CustomerSegment", "CustomerCount"), ("SegmentRevenue", "AverageFrequency", "AverageRecencyDays"),
    ),
    "country_performance": (_COUNTRY, ("CountryRevenue",)),
    "top_countries_by_revenue": (_COUNTRY, ("CountryRevenue",)),
    "market_share_uk_vs_non_uk": (
        ("Market", "MarketOrderCount", "MarketCustomerCount", "MarketQuantitySold"),
        ("MarketRevenue", "RevenueSharePercent"),
    ),
    "potential_growth_markets": (_COUNTRY, ("CountryRevenue", "RevenuePerCustomer", "RevenuePerOrder")),
}


def oracle_statements() -> dict[str, str]:
    q: dict[str, str] = {}
    # sources and typed tables
    q["clean_column_names"] = _with() + f"SELECT {', '.join(RAW_COLUMNS)} FROM raw"
    q["csv_source_scan"] = _with() + f"SELECT {', '.join(RAW_COLUMNS)} FROM raw"
    q["typed_sales"] = _with() + TYPED_SELECT
    q["cleaned_sales"] = _with() + CLEANED_SELECT
    q["cancelled_lines"] = _with() + TYPED_SELECT + " WHERE IsCancelled"

    # profiling and data quality
    q["raw_row_count"] = _with() + "SELECT count(*) AS RowCount FROM raw"
    q["null_or_empty_profile_raw"] = _with() + _blank_profile("raw", RAW_COLUMNS)
    q["null_or_empty_profile_cleaned"] = _with() + _blank_profile("cleaned", CLEANED_COLUMNS)
    q["null_profile_strict"] = _with() + "SELECT " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in RAW_COLUMNS
    ) + " FROM raw"
    q["sample_rows_raw"] = _with() + (
        f"SELECT {', '.join(RAW_COLUMNS)} FROM raw ORDER BY {_order_all(RAW_COLUMNS)} LIMIT 30"
    )
    q["sample_rows_cleaned"] = _with() + (
        f"SELECT * FROM ({CLEANED_SELECT}) ORDER BY {_order_all(CLEANED_COLUMNS)} LIMIT 30"
    )
    q["cleaning_summary"] = _with() + """SELECT count(*) AS RawRows,
       count(*) FILTER (WHERE Description IS NOT NULL AND trim(Description) <> ''
                          AND CustomerID IS NOT NULL AND trim(CustomerID) <> ''
                          AND Quantity IS NOT NULL AND Quantity > 0
                          AND UnitPrice IS NOT NULL AND UnitPrice > 0 AND NOT IsCancelled) AS CleanedRows,
       count(*) - count(*) FILTER (WHERE Description IS NOT NULL AND trim(Description) <> ''
                          AND CustomerID IS NOT NULL AND trim(CustomerID) <> ''
                          AND Quantity IS NOT NULL AND Quantity > 0
                          AND UnitPrice IS NOT NULL AND UnitPrice > 0 AND NOT IsCancelled) AS RemovedRows,
       count(*) FILTER (WHERE IsCancelled) AS CancelledRows,
       count(*) FILTER (WHERE Description IS NULL OR trim(Description) = '') AS EmptyDescriptionRows,
       count(*) FILTER (WHERE CustomerID IS NULL OR trim(CustomerID) = '') AS EmptyCustomerIdRows,
       count(*) FILTER (WHERE Quantity IS NULL OR Quantity <= 0) AS InvalidQuantityRows,
       count(*) FILTER (WHERE UnitPrice IS NULL OR UnitPrice <= 0) AS InvalidUnitPriceRows
FROM typed"""

    # scalar function forms
    q["string_functions"] = _with() + _raw_select(
        "trim(Description) AS TrimmedDescription, "
        "replace(trim(UnitPrice), ',', '.') AS DottedUnitPrice, "
        "starts_with(trim(InvoiceNo), 'C') AS StartsWithC"
    )
    q["numeric_parse_functions"] = _with() + _raw_select(
        "TRY_CAST(trim(Quantity) AS INTEGER) AS ParsedQuantity, "
        "CAST(TRY_CAST(replace(trim(UnitPrice), ',', '.') AS DECIMAL(27,10)) AS DOUBLE) AS ParsedUnitPrice"
    )
    ts = "try_strptime(trim(InvoiceDate), '%d/%m/%Y %H:%M')"
    q["date_functions"] = _with() + _raw_select(
        f"{ts} AS ParsedInvoiceDate, CAST({ts} AS DATE) AS InvoiceDateOnly, "
        f"CAST(year({ts}) AS INTEGER) AS Year, CAST(month({ts}) AS INTEGER) AS Month, "
        f"CAST(hour({ts}) AS INTEGER) AS Hour, strftime({ts}, '%Y-%m') AS YearMonth, "
        f"dayname({ts}) AS DayOfWeek, CAST(dayofweek({ts}) + 1 AS INTEGER) AS DayOfWeekNumber, "
        f"CAST(CAST({ts} AS DATE) + INTERVAL 1 DAY AS DATE) AS NextDay, "
        f"CAST(date_diff('day', DATE '2000-01-01', CAST({ts} AS DATE)) AS INTEGER) AS DaysSince2000"
    )
    qty = "TRY_CAST(trim(Quantity) AS INTEGER)"
    price = "TRY_CAST(replace(trim(UnitPrice), ',', '.') AS DECIMAL(27,10))"
    rev = f"round(CAST({qty} AS DECIMAL(10,0)) * {price}, 2)"
    q["math_functions"] = _with() + _raw_select(
        f"CAST({rev} AS DOUBLE) AS LineRevenue, "
        f"CASE WHEN {rev} IS NULL OR {qty} IS NULL THEN NULL ELSE "
        f"(sign({rev}) * sign({qty})) * {half_up(f'abs({_cents(rev)})', f'abs(CAST({qty} AS HUGEINT)) * 100', 2)} END "
        f"AS RevenuePerUnit, "
        f"sign({rev}) * {half_up(f'abs({_cents(rev)})', '300', 2)} AS ThirdOfRevenue"
    )
    q["null_predicates"] = _with() + _raw_select(
        "(Description IS NULL OR trim(Description) = '') AS DescriptionBlank, "
        "(CustomerID IS NOT NULL AND trim(CustomerID) <> '') AS CustomerPresent, "
        f"CASE WHEN {qty} IS NULL THEN 'missing' WHEN {qty} <= 0 THEN 'non_positive' "
        "ELSE 'positive' END AS QuantityStatus, "
        f"CAST({qty} AS VARCHAR) AS QuantityText, "
        f"({price} IS NOT NULL AND {price} > 0) AS PriceValid"
    )

    # KPIs and time
    q["sales_kpis"] = _with(KPIS) + (
        f"SELECT {dbl('TotalRevenue')} AS TotalRevenue, TotalOrders, "
        f"{big('TotalQuantitySold')} AS TotalQuantitySold, TotalCustomers, TotalProducts, "
        f"TotalCountries FROM sales_kpis"
    )
    q["cancellation_kpis"] = _with(KPIS) + "SELECT TotalRawInvoices, CancelledOrders FROM cancel_kpis"
    q["overall_kpis"] = _with(KPIS) + KPI_SELECT
    q["monthly_sales_trend"] = _with(MONTHLY) + MONTHLY_SELECT
    q["weekday_sales"] = _with(WEEKDAY) + WEEKDAY_SELECT
    q["hourly_sales"] = _with(HOURLY) + HOURLY_SELECT
    q["monthly_revenue_extremes"] = _with(MONTHLY) + (
        f"(SELECT 'HighestRevenueMonth' AS Metric, YearMonth, {dbl('MonthlyRevenue')} AS MonthlyRevenue, "
        f"MonthlyOrders, {big('MonthlyQuantitySold')} AS MonthlyQuantitySold FROM monthly "
        f"ORDER BY MonthlyRevenue DESC NULLS LAST, YearMonth ASC NULLS FIRST LIMIT 1) UNION ALL "
        f"(SELECT 'LowestRevenueMonth' AS Metric, YearMonth, {dbl('MonthlyRevenue')} AS MonthlyRevenue, "
        f"MonthlyOrders, {big('MonthlyQuantitySold')} AS MonthlyQuantitySold FROM monthly "
        f"ORDER BY MonthlyRevenue ASC NULLS FIRST, YearMonth ASC NULLS FIRST LIMIT 1)"
    )

    # products
    q["product_performance"] = _with(PRODUCTS) + PRODUCT_SELECT
    q["top_products_by_quantity"] = _with(PRODUCTS) + _top(
        PRODUCT_SELECT,
        f"ProductQuantitySold DESC NULLS LAST, ProductRevenue DESC NULLS LAST, {PRODUCT_TIE}",
    )
    q["top_products_by_revenue"] = _with(PRODUCTS) + _top(
        PRODUCT_SELECT,
        f"ProductRevenue DESC NULLS LAST, ProductQuantitySold DESC NULLS LAST, {PRODUCT_TIE}",
    )
    q["bottom_products_by_revenue"] = _with(PRODUCTS) + _top(
        PRODUCT_SELECT,
        f"ProductRevenue ASC NULLS FIRST, ProductQuantitySold ASC NULLS FIRST, {PRODUCT_TIE}",
    )

    # customers
    q["customer_performance"] = _with(CUSTOMERS) + CUSTOMER_SELECT
    q["top_customers"] = _with(CUSTOMERS) + _top(
        CUSTOMER_SELECT,
        "CustomerRevenue DESC NULLS LAST, CustomerOrderCount DESC NULLS LAST, CustomerID ASC NULLS FIRST",
    )
    q["analysis_date"] = _with() + (
        "SELECT CAST(max(InvoiceDateOnly) + INTERVAL 1 DAY AS DATE) AS AnalysisDate FROM cleaned"
    )
    q["customer_rfm"] = _with(CUSTOMERS, RFM) + RFM_SELECT
    q["customer_rfm_top"] = _with(CUSTOMERS, RFM) + _top(
        RFM_SELECT,
        "Monetary DESC NULLS LAST, Frequency DESC NULLS LAST, RecencyDays ASC NULLS FIRST, "
        "CustomerID ASC NULLS FIRST",
    )
    q["customer_segment_summary"] = _with(CUSTOMERS, RFM, SEGMENTS) + SEGMENT_SELECT

    # countries and markets
    q["country_performance"] = _with(COUNTRIES) + COUNTRY_SELECT
    q["top_countries_by_revenue"] = _with(COUNTRIES) + _top(
        COUNTRY_SELECT,
        "CountryRevenue DESC NULLS LAST, CountryOrderCount DESC NULLS LAST, Country ASC NULLS FIRST",
    )
    q["market_share_uk_vs_non_uk"] = _with(MARKETS) + MARKET_SELECT
    q["potential_growth_markets"] = _growth(5, 10)
    q["potential_growth_markets_strict"] = _growth(60, 450)

    # viewer and chart feeds
    q["top_hours_by_revenue"] = _with(HOURLY) + _top(
        HOURLY_SELECT, "HourlyRevenue DESC NULLS LAST, Hour ASC NULLS FIRST"
    )
    q["market_share_chart"] = _with(MARKETS) + (
        f"SELECT Market, {dbl('MarketRevenue')} AS MarketRevenue, "
        f"{money_percent('MarketRevenue', 'sum(MarketRevenue) OVER ()', 1)} AS SharePercent FROM markets"
    )
    q["customer_segment_share_chart"] = _with(CUSTOMERS, RFM, SEGMENTS) + (
        f"SELECT CustomerSegment, CustomerCount, "
        f"{count_percent('CustomerCount', 'sum(CustomerCount) OVER ()', 1)} AS SharePercent FROM segments"
    )
    q["top_products_chart"] = _with(PRODUCTS) + (
        f"SELECT substring(Description, 1, 34) AS Label, ProductRevenue FROM ("
        + _top(
            PRODUCT_SELECT,
            f"ProductRevenue DESC NULLS LAST, ProductQuantitySold DESC NULLS LAST, {PRODUCT_TIE}",
        )
        + ")"
    )
    q["top_countries_chart"] = _with(COUNTRIES) + (
        "SELECT Country, CountryRevenue FROM ("
        + _top(
            COUNTRY_SELECT,
            "CountryRevenue DESC NULLS LAST, CountryOrderCount DESC NULLS LAST, Country ASC NULLS FIRST",
        )
        + ")"
    )
    q["monthly_revenue_chart"] = _with(MONTHLY) + (
        f"SELECT CAST(row_number() OVER (ORDER BY YearMonth ASC NULLS FIRST) - 1 AS INTEGER) AS Position, "
        f"YearMonth, {dbl('MonthlyRevenue')} AS MonthlyRevenue FROM monthly"
    )
    q["weekday_revenue_chart"] = _with(WEEKDAY) + (
        f"SELECT DayOfWeek, {dbl('WeekdayRevenue')} AS WeekdayRevenue FROM weekday"
    )
    q["hourly_orders_chart"] = _with(HOURLY) + "SELECT Hour, HourlyOrders FROM hourly"
    money_fmt = "format('{{:,.2f}}', {})"
    int_fmt = "format('{{:,}}', {})"
    lines = [
        ("Total Revenue", money_fmt.format("TotalRevenue")),
        ("Total Orders", int_fmt.format("TotalOrders")),
        ("Total Quantity Sold", int_fmt.format(big("TotalQuantitySold"))),
        ("Total Customers", int_fmt.format("TotalCustomers")),
        ("Total Products", int_fmt.format("TotalProducts")),
        ("Total Countries", int_fmt.format("TotalCountries")),
        ("Average Order Value", money_fmt.format("AverageOrderValue")),
        ("Average Revenue Per Customer", money_fmt.format("AverageRevenuePerCustomer")),
        ("Cancelled Orders", int_fmt.format("CancelledOrders")),
        ("Total Raw Invoices", int_fmt.format("TotalRawInvoices")),
        ("Cancellation Rate", "CAST(CancellationRatePercent AS VARCHAR) || '%'"),
    ]
    q["formatted_kpis"] = _with(KPIS) + " UNION ALL ".join(
        f"SELECT '{label}' AS Metric, {expr} AS DisplayValue FROM kpis" for label, expr in lines
    )
    q["scaled_revenue_labels"] = _with(MONTHLY) + (
        "SELECT YearMonth, '$' || CAST(CAST(("
        + half_up(_cents("MonthlyRevenue"), "100000000", 1)
        + ") AS DECIMAL(38,1)) AS VARCHAR) || 'M' AS RevenueLabel FROM monthly"
    )

    def label(money: str, unit: int, scale: int, suffix: str) -> str:
        rounded = half_up(_cents(money), str(unit * 100), scale)
        return f"'$' || CAST(CAST(({rounded}) AS DECIMAL(38,{scale})) AS VARCHAR) || '{suffix}'"

    q["scaled_chart_labels"] = " UNION ALL ".join(
        f"SELECT '{chart}' AS Chart, {name} AS Label, {text} AS RevenueLabel FROM ({q[table]})"
        for chart, table, name, text in (
            ("weekday", "weekday_sales", "DayOfWeek", label("WeekdayRevenue", 1_000_000, 1, "M")),
            ("product", "top_products_by_revenue", "Description", label("ProductRevenue", 1_000, 0, "K")),
            ("country", "top_countries_by_revenue", "Country", label("CountryRevenue", 1_000_000, 1, "M")),
        )
    )

    # sinks: read-back equals the written table; the manifest counts all fifteen
    q["export_csv_roundtrip"] = q["country_performance"]
    q["export_json_roundtrip"] = q["top_customers"]
    q["export_json_array_roundtrip"] = q["typed_sales"]
    # scan of uneven lines: what a short line lacks is NULL, a surplus field is cut, both are counted
    digit = "substring(StockCode, length(StockCode), 1)"
    fields = f"CASE {digit} WHEN '3' THEN 7 WHEN '5' THEN 6 WHEN '7' THEN 9 END"
    q["checked_source_scan"] = _with() + (
        f"SELECT {', '.join(RAW_COLUMNS[:-2])}, CASE WHEN {digit} <> '5' THEN CustomerID END AS CustomerID, "
        f"CASE WHEN {digit} NOT IN ('3', '5') THEN Country END AS Country, {fields} AS FieldCount FROM raw"
    )
    q["malformed_line_counts"] = _with() + (
        f"SELECT {fields} AS FieldCount, count(*) AS Lines, count(DISTINCT InvoiceNo) AS Invoices "
        f"FROM raw WHERE {digit} IN ('3', '5', '7') GROUP BY 1"
    )
    q["export_all_tables"] = " UNION ALL ".join(
        f"SELECT '{name}' AS TableName, CAST(count(*) AS BIGINT) AS RowCount FROM ({q[name]})"
        for name in EXPORTED_TABLES
    )
    q["export_all_values"] = " UNION ALL ".join(
        f"SELECT '{name}' AS TableName, f.Format AS Format, "
        f"concat_ws('|', {', '.join(f'coalesce(CAST({k} AS VARCHAR), {_NULL})' for k in keys)}) AS RowKey, "
        f"'{number}' AS ColumnName, {number} AS NumberValue "
        f"FROM ({q[name]}) CROSS JOIN (VALUES ('csv'), ('json')) AS f(Format)"
        for name, (keys, numbers) in EXPORT_COLUMNS.items()
        for number in numbers
    )
    return q
