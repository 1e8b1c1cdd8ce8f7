"""Independent SQL formulations of every registered query (DuckDB dialect).

These are the correctness oracle (brute force where that is simplest, e.g.
item pairs and triples per basket for the rules): each string rebuilds the raw fixture from
the driver tables, applies the cleaning rules step by step, and computes the
result the way the rules are stated (lag windows, row_number, ntile,
positional quantiles), not the way the Spark plans compute them (telescoped
sums, distributed ranks, scalar subqueries).
"""

from __future__ import annotations

# Raw fixture: same derivation as tillroll.sources.fixtures.raw_retail_lines.
RAW_CTE = """
lines AS (
  -- every line once; the lines of every 50th order twice (planted exact duplicates)
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, l_discount,
         unnest(CASE WHEN l_orderkey % 50 = 0 THEN [1, 2] ELSE [1] END) AS copy_no
  FROM lineitem
),
raw_retail AS (
SELECT
  CASE WHEN l.l_returnflag = 'R' AND l.l_orderkey % 5 = 0 THEN 'C' || CAST(l.l_orderkey AS VARCHAR) ELSE CAST(l.l_orderkey AS VARCHAR) END AS InvoiceNo,
  CAST(l.l_partkey AS VARCHAR) AS StockCode,
  CASE WHEN p.p_size = 1 THEN NULL WHEN p.p_size = 2 THEN '  '
       WHEN l.l_linenumber = 7 THEN p.p_name || ' ' ELSE p.p_name END AS Description,
  CASE WHEN l.l_returnflag = 'R' AND l.l_orderkey % 5 = 0 THEN -CAST(l.l_quantity AS BIGINT)
       WHEN l.l_orderkey % 41 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(l.l_quantity AS BIGINT) END AS Quantity,
  CASE l.l_orderkey % 5
    WHEN 0 THEN substr(d,1,4) || '/' || substr(d,6,2) || '/' || substr(d,9,2) || ' ' || lpad(h,2,'0') || ':30:00'
    WHEN 1 THEN substr(d,9,2) || '/' || substr(d,6,2) || '/' || substr(d,1,4) || ' ' || lpad(h,2,'0') || ':30'
    WHEN 2 THEN substr(d,9,2) || '/' || substr(d,6,2) || '/' || substr(d,1,4) || ' ' || h || ':30'
    WHEN 3 THEN CASE WHEN l.l_orderkey % 7 = 0 THEN 'not a date' ELSE substr(d,1,10) || ' ' || lpad(h,2,'0') || ':30:00' END
    ELSE substr(d,1,10) || ' ' || lpad(h,2,'0') || ':30:00' END AS InvoiceDate,
  CASE WHEN l.l_discount = 0.1 AND l.l_orderkey % 3 = 0 THEN CAST(0.0 AS DOUBLE) ELSE p.p_retailprice END AS UnitPrice,
  CASE WHEN o.o_custkey % 20 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS CustomerID,
  n.n_name AS Country
FROM lines l
JOIN (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS VARCHAR) AS d, CAST(6 + o_orderkey % 15 AS VARCHAR) AS h FROM orders) o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

# Cleaning rules as separate steps, in the contract order.
CLEAN_CTE = """
c1 AS (SELECT * FROM raw_retail WHERE NOT starts_with(trim(InvoiceNo), 'C')),
c2 AS (SELECT * FROM c1 WHERE TRY_CAST(Quantity AS DOUBLE) > 0 AND TRY_CAST(UnitPrice AS DOUBLE) > 0),
c3 AS (SELECT DISTINCT * FROM c2),
c4 AS (
  SELECT InvoiceNo, StockCode,
         CASE WHEN Description IS NULL OR trim(Description) = '' THEN 'Unknown Product' ELSE Description END AS Description,
         Quantity, InvoiceDate, UnitPrice, CAST(CustomerID AS VARCHAR) AS CustomerID, Country
  FROM c3 WHERE CustomerID IS NOT NULL),
c5 AS (
  SELECT *, try_strptime(trim(InvoiceDate), ['%Y-%m-%d %H:%M:%S', '%Y/%m/%d %H:%M:%S', '%d/%m/%Y %H:%M']) AS InvoiceDateTime
  FROM c4),
c6 AS (SELECT * FROM c5 WHERE InvoiceDateTime IS NOT NULL),
clean AS (
  SELECT InvoiceNo, StockCode, Description,
         CAST(trunc(TRY_CAST(Quantity AS DOUBLE)) AS BIGINT) AS Quantity,
         strftime(InvoiceDateTime, '%Y-%m-%d') AS InvoiceDate,
         TRY_CAST(UnitPrice AS DOUBLE) AS UnitPrice,
         CustomerID, Country, InvoiceDateTime,
         strftime(InvoiceDateTime, '%H') AS InvoiceHour,
         CAST(year(InvoiceDateTime) AS INTEGER) AS InvoiceYear,
         CAST(month(InvoiceDateTime) AS INTEGER) AS InvoiceMonth,
         CAST(day(InvoiceDateTime) AS INTEGER) AS InvoiceDay,
         CAST(dayofweek(InvoiceDateTime) + 1 AS INTEGER) AS InvoiceWeekday,
         CASE WHEN dayofweek(InvoiceDateTime) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend,
         trim(InvoiceNo) || '|' || CustomerID AS OrderKey,
         CAST(CAST(trunc(TRY_CAST(Quantity AS DOUBLE)) AS BIGINT) AS DOUBLE) * TRY_CAST(UnitPrice AS DOUBLE) AS TotalAmount
  FROM c6)"""


def _money(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(38,8))) AS DOUBLE)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def _on_raw(select: str) -> str:
    return f"{_with(RAW_CTE)}\n{select}"


def _on_clean(select: str, *extra: str) -> str:
    return f"{_with(RAW_CTE, CLEAN_CTE, *extra)}\n{select}"


def _growth(cur: str, prev: str) -> str:
    return (
        f"CASE WHEN {prev} IS NULL OR {prev} = 0 THEN NULL "
        f"ELSE ({cur} - {prev}) / {prev} * CAST(100.0 AS DOUBLE) END"
    )


RAW_COLS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"

_M = _money("TotalAmount")

DAILY_SALES = f"""
SELECT InvoiceDate, COUNT(DISTINCT InvoiceNo) AS DailyOrderCount, {_M} AS DailySalesAmount,
       CAST(SUM(Quantity) AS BIGINT) AS DailyTotalQuantity
FROM clean GROUP BY InvoiceDate ORDER BY InvoiceDate"""

TOP20_PRODUCTS = f"""
SELECT StockCode, Description, CAST(SUM(Quantity) AS BIGINT) AS TotalSalesQuantity, {_M} AS TotalSalesAmount
FROM clean GROUP BY StockCode, Description
ORDER BY TotalSalesQuantity DESC, StockCode, Description LIMIT 20"""

COUNTRY_SALES = f"""
SELECT Country, COUNT(DISTINCT InvoiceNo) AS OrderCount, {_M} AS SalesAmount,
       COUNT(DISTINCT CustomerID) AS CustomerCount
FROM clean GROUP BY Country ORDER BY SalesAmount DESC, Country"""

CUSTOMER_FREQUENCY = f"""
SELECT CustomerID, COUNT(DISTINCT InvoiceNo) AS PurchaseFrequency, {_M} AS TotalSpending,
       {_M} / CAST(COUNT(TotalAmount) AS DOUBLE) AS AvgOrderSpending
FROM clean GROUP BY CustomerID ORDER BY TotalSpending DESC, CustomerID"""

HOURLY_ORDERS = f"""
SELECT InvoiceHour, COUNT(DISTINCT InvoiceNo) AS HourlyOrderCount, {_M} AS HourlySalesAmount
FROM clean GROUP BY InvoiceHour ORDER BY CAST(InvoiceHour AS INTEGER)"""

MONTHLY_SALES_TREND = f"""
SELECT ym, sales, {_growth('sales', 'prev_sales')} AS mom_pct
FROM (SELECT ym, sales, lag(sales) OVER (ORDER BY ym) AS prev_sales
      FROM (SELECT strftime(InvoiceDateTime, '%Y-%m') AS ym, {_M} AS sales FROM clean GROUP BY 1) m) t
ORDER BY ym"""

PRODUCT_SEASONALITY = f"""
SELECT CAST(month(InvoiceDateTime) AS INTEGER) AS month_of_year, {_M} AS MonthlySalesAmount,
       CAST(SUM(Quantity) AS BIGINT) AS MonthlyQuantity
FROM clean GROUP BY 1 ORDER BY 1"""

COUNTRY_SALES_GROWTH = f"""
SELECT Country, yr, sales, prev_sales, {_growth('sales', 'prev_sales')} AS yoy_pct
FROM (SELECT Country, yr, sales, lag(sales) OVER (PARTITION BY Country ORDER BY yr) AS prev_sales
      FROM (SELECT Country, CAST(year(InvoiceDateTime) AS INTEGER) AS yr, {_M} AS sales
            FROM clean GROUP BY 1, 2) cy) t
ORDER BY Country, yr"""

FIRST_PURCHASE = """
SELECT strftime(InvoiceDateTime, '%Y-%m') AS first_month, COUNT(DISTINCT CustomerID) AS NewCustomers
FROM (SELECT CustomerID, InvoiceDateTime,
             row_number() OVER (PARTITION BY CustomerID ORDER BY InvoiceDateTime) AS rn FROM clean) f
WHERE rn = 1 GROUP BY 1 ORDER BY 1"""

RFM_SCORES_CTE = f"""
rfm AS (
  SELECT CustomerID,
         CAST(MIN(date_diff('day', CAST(InvoiceDateTime AS DATE),
                            CAST((SELECT max(InvoiceDateTime) FROM clean) AS DATE))) AS INTEGER) AS RecencyDays,
         COUNT(DISTINCT InvoiceNo) AS Frequency,
         {_M} AS Monetary
  FROM clean GROUP BY CustomerID)"""

RFM_SCORES = "SELECT CustomerID, RecencyDays, Frequency, Monetary FROM rfm"

RFM_SEGMENTS = """
SELECT CustomerID, RecencyDays, Frequency, Monetary, R_q, F_q, M_q,
  CASE WHEN R_q <= 2 AND F_q <= 2 AND M_q <= 2 THEN 'HIGH_VALUE'
       WHEN R_q <= 2 AND F_q <= 2 THEN 'HIGH_POTENTIAL'
       WHEN R_q >= 3 AND F_q <= 2 THEN 'WIN_BACK'
       WHEN F_q >= 3 AND M_q <= 2 THEN 'REGULAR'
       ELSE 'CHURN_RISK' END AS RFM_Segment
FROM (SELECT *,
        CAST(ntile(4) OVER (ORDER BY RecencyDays ASC, CustomerID ASC) AS INTEGER) AS R_q,
        CAST(ntile(4) OVER (ORDER BY Frequency DESC, CustomerID ASC) AS INTEGER) AS F_q,
        CAST(ntile(4) OVER (ORDER BY Monetary DESC, CustomerID ASC) AS INTEGER) AS M_q
      FROM rfm) s"""

REPURCHASE_CTE = """
rep AS (
  SELECT CAST(COUNT(*) AS DOUBLE) AS customer_cnt,
         CAST(SUM(CASE WHEN n_orders >= 2 THEN 1 ELSE 0 END) AS DOUBLE) AS repeat_customers
  FROM (SELECT CustomerID, COUNT(DISTINCT InvoiceNo) AS n_orders FROM clean GROUP BY CustomerID) pc)"""

REPURCHASE_SUMMARY = """
SELECT 'customer_cnt' AS metric, customer_cnt AS value FROM rep
UNION ALL SELECT 'repeat_customers', repeat_customers FROM rep
UNION ALL SELECT 'repurchase_rate', repeat_customers / customer_cnt FROM rep"""

QUANTILE_CTE = f"""
ov AS (SELECT InvoiceNo, {_M} AS order_value FROM clean GROUP BY InvoiceNo),
ranked AS (
  SELECT order_value, row_number() OVER (ORDER BY order_value, InvoiceNo) - 1 AS i,
         COUNT(*) OVER () AS n FROM ov)"""


def _quantile_select(metric: str, p: float) -> str:
    rn = f"(CAST(n - 1 AS DOUBLE) * CAST({p} AS DOUBLE))"
    return (
        f"SELECT '{metric}' AS metric, lo + (hi - lo) * fr AS value FROM ("
        f"SELECT MAX(CASE WHEN i = floor({rn}) THEN order_value END) AS lo, "
        f"MAX(CASE WHEN i = ceil({rn}) THEN order_value END) AS hi, "
        f"MAX({rn} - floor({rn})) AS fr FROM ranked) q"
    )


ORDER_VALUE_QUANTILES = "\nUNION ALL ".join(
    _quantile_select(m, p)
    for m, p in (("order_value_p25", 0.25), ("order_value_p50", 0.5), ("order_value_p75", 0.75))
)

# The approximate form allows a rank error of n / 10,000 invoices. At the sizes
# compared here that is below two rows, so the value at the rank itself is due.
ORDER_VALUE_QUANTILES_APPROX = "\nUNION ALL ".join(
    f"SELECT '{m}' AS metric, MAX(order_value) AS value FROM ranked WHERE i = greatest(ceil({p} * n), 1) - 1"
    for m, p in (("order_value_p25", 0.25), ("order_value_p50", 0.5), ("order_value_p75", 0.75))
)
ORDER_VALUE_RANK_ERROR = "\nUNION ALL ".join(
    f"SELECT 'order_value_{q}' AS metric, COUNT(*) AS invoices, TRUE AS within_bound FROM ov"
    for q in ("p25", "p50", "p75")
)

GAP_LINES = """
SELECT 'avg_repurchase_gap_days' AS metric, CAST(SUM(gap) AS DOUBLE) / CAST(COUNT(gap) AS DOUBLE) AS value
FROM (SELECT date_diff('day',
               CAST(lag(InvoiceDateTime) OVER (PARTITION BY CustomerID ORDER BY InvoiceDateTime) AS DATE),
               CAST(InvoiceDateTime AS DATE)) AS gap FROM clean) g"""

GAP_ORDERS = """
SELECT 'avg_repurchase_gap_days_orders' AS metric, CAST(SUM(gap) AS DOUBLE) / CAST(COUNT(gap) AS DOUBLE) AS value
FROM (SELECT date_diff('day',
               CAST(lag(ts) OVER (PARTITION BY CustomerID ORDER BY ts) AS DATE),
               CAST(ts AS DATE)) AS gap
      FROM (SELECT CustomerID, InvoiceNo, MIN(InvoiceDateTime) AS ts FROM clean GROUP BY 1, 2) o) g"""


def _baskets_cte(source: str, basket: str, item: str) -> str:
    return f"""
bi AS (SELECT DISTINCT {basket} AS basket, CAST({item} AS VARCHAR) AS item FROM {source}),
bsz AS (SELECT basket, COUNT(*) AS k FROM bi GROUP BY basket),
bb AS (SELECT bi.basket, bi.item FROM bi JOIN bsz ON bi.basket = bsz.basket WHERE bsz.k >= 2)"""


def _rules_cte(min_support: float, min_conf: float) -> str:
    """CTE ``rules``: rules from itemsets of size 2 and 3 over baskets ``bb``.

    Complete when no itemset of four or more items is frequent (checked for
    the fixtures that use it in tests/test_analyses.py).
    """
    return f"""
nb AS (SELECT COUNT(DISTINCT basket) AS n FROM bb),
minc AS (SELECT ceil(CAST({min_support} AS DOUBLE) * n) AS mc, n FROM nb),
f1 AS (SELECT item, COUNT(*) AS c FROM bb GROUP BY item HAVING COUNT(*) >= (SELECT mc FROM minc)),
b1 AS (SELECT bb.* FROM bb JOIN f1 ON bb.item = f1.item),
f2 AS (SELECT x.item AS a, y.item AS b, COUNT(*) AS c FROM b1 x JOIN b1 y
         ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2 HAVING COUNT(*) >= (SELECT mc FROM minc)),
f3 AS (SELECT x.item AS a, y.item AS b, z.item AS c3, COUNT(*) AS c FROM b1 x
         JOIN b1 y ON x.basket = y.basket AND x.item < y.item
         JOIN b1 z ON y.basket = z.basket AND y.item < z.item
         JOIN f2 ON f2.a = x.item AND f2.b = y.item
       GROUP BY 1, 2, 3 HAVING COUNT(*) >= (SELECT mc FROM minc)),
cand AS (
  SELECT a AS ant, b AS con, c AS cu FROM f2 UNION ALL
  SELECT b, a, c FROM f2 UNION ALL
  SELECT a || ',' || b, c3, c FROM f3 UNION ALL
  SELECT a || ',' || c3, b, c FROM f3 UNION ALL
  SELECT b || ',' || c3, a, c FROM f3),
fa AS (SELECT item AS s, c FROM f1 UNION ALL SELECT a || ',' || b, c FROM f2),
r AS (
  SELECT cand.ant, cand.con, cand.cu,
         CAST(cand.cu AS DOUBLE) / CAST(fa.c AS DOUBLE) AS conf, f1.c AS cc, (SELECT n FROM nb) AS n
  FROM cand JOIN fa ON fa.s = cand.ant JOIN f1 ON f1.item = cand.con),
rules AS (
  SELECT ant AS antecedent_str, con AS consequent_str,
         CAST(cu AS DOUBLE) / CAST(n AS DOUBLE) AS support,
         conf AS confidence,
         conf / (CAST(cc AS DOUBLE) / CAST(n AS DOUBLE)) AS lift
  FROM r WHERE conf >= CAST({min_conf} AS DOUBLE))"""


def _rules_by_masks_cte(min_support: float, min_conf: float) -> str:
    """CTE ``rules`` over baskets ``bb`` by full subset enumeration.

    Each basket becomes a bit mask over the distinct items and every
    non-empty item subset (2^k - 1 masks) is counted, so itemsets of any size
    are covered. Only for item sets of a handful of values (p_type has 6).
    """
    return f"""
items AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS bit
          FROM (SELECT DISTINCT item FROM bb) t),
masks AS (SELECT basket, bit_or(CAST(1 AS BIGINT) << bit) AS m FROM bb JOIN items USING (item) GROUP BY basket),
nb AS (SELECT COUNT(*) AS n FROM masks),
subsets AS (SELECT unnest(range(1, CAST((SELECT CAST(1 AS BIGINT) << COUNT(*) FROM items) AS BIGINT))) AS s),
freq AS (SELECT s, COUNT(*) AS c FROM masks JOIN subsets ON (masks.m & subsets.s) = subsets.s
         GROUP BY s HAVING COUNT(*) >= ceil(CAST({min_support} AS DOUBLE) * (SELECT n FROM nb))),
names AS (SELECT s, string_agg(item, ',' ORDER BY item) AS s_str
          FROM freq JOIN items ON (freq.s >> items.bit) & 1 = 1 GROUP BY s),
cand AS (SELECT f.s AS full_m, f.s & ~(CAST(1 AS BIGINT) << i.bit) AS ant_m, i.item AS con,
                CAST(1 AS BIGINT) << i.bit AS con_m, f.c AS cu
         FROM freq f JOIN items i ON (f.s >> i.bit) & 1 = 1 WHERE bit_count(f.s) >= 2),
r AS (SELECT na.s_str AS ant, cand.con, cand.cu,
             CAST(cand.cu AS DOUBLE) / CAST(fa.c AS DOUBLE) AS conf, fc.c AS cc, (SELECT n FROM nb) AS n
      FROM cand JOIN freq fa ON fa.s = cand.ant_m JOIN freq fc ON fc.s = cand.con_m
                JOIN names na ON na.s = cand.ant_m),
rules AS (
  SELECT ant AS antecedent_str, con AS consequent_str,
         CAST(cu AS DOUBLE) / CAST(n AS DOUBLE) AS support,
         conf AS confidence,
         conf / (CAST(cc AS DOUBLE) / CAST(n AS DOUBLE)) AS lift
  FROM r WHERE conf >= CAST({min_conf} AS DOUBLE))"""


RULES_SELECT = "SELECT * FROM rules ORDER BY lift DESC, antecedent_str, consequent_str"

ITEMSETS_SELECT = """
SELECT item AS items_str, CAST(1 AS INTEGER) AS size, CAST(c AS BIGINT) AS freq FROM f1
UNION ALL SELECT a || ',' || b, CAST(2 AS INTEGER), CAST(c AS BIGINT) FROM f2
UNION ALL SELECT a || ',' || b || ',' || c3, CAST(3 AS INTEGER), CAST(c AS BIGINT) FROM f3"""

BRAND_LINES_CTE = """
brand_lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo, p_brand, p_type
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

WATERFALL = """
SELECT 1 AS step, 'raw' AS stage, (SELECT COUNT(*) FROM raw_retail) AS rows
UNION ALL SELECT 2, 'not_cancelled', (SELECT COUNT(*) FROM c1)
UNION ALL SELECT 3, 'positive', (SELECT COUNT(*) FROM c2)
UNION ALL SELECT 4, 'deduplicated', (SELECT COUNT(*) FROM c3)
UNION ALL SELECT 5, 'customer_present', (SELECT COUNT(*) FROM c4)
UNION ALL SELECT 6, 'date_parsed', (SELECT COUNT(*) FROM c6)
UNION ALL SELECT 7, 'final', (SELECT COUNT(*) FROM clean)"""


def _bench(key: str) -> str:
    return _on_raw(
        f"""
SELECT {key}, {_money('TotalAmount')} AS s FROM (
  SELECT {key}, CAST(Quantity AS DOUBLE) * CAST(UnitPrice AS DOUBLE) AS TotalAmount FROM raw_retail
  WHERE NOT starts_with(CAST(InvoiceNo AS VARCHAR), 'C')
    AND TRY_CAST(Quantity AS DOUBLE) > 0 AND TRY_CAST(UnitPrice AS DOUBLE) > 0
    AND CustomerID IS NOT NULL) t
GROUP BY {key}"""
    )


# Result tables in run order, each as a SELECT over the CTEs above.
RESULT_SQL: dict[str, str] = {
    "daily_sales": DAILY_SALES,
    "top20_products": TOP20_PRODUCTS,
    "country_sales": COUNTRY_SALES,
    "customer_frequency": CUSTOMER_FREQUENCY,
    "hourly_orders": HOURLY_ORDERS,
    "rfm_segments": RFM_SEGMENTS,
    "association_rules": RULES_SELECT,
    "user_behavior_summary": f"{REPURCHASE_SUMMARY}\nUNION ALL {ORDER_VALUE_QUANTILES}\nUNION ALL {GAP_LINES.strip()}",
    "first_purchase_distribution": FIRST_PURCHASE,
    "monthly_sales_trend": MONTHLY_SALES_TREND,
    "product_seasonality": PRODUCT_SEASONALITY,
    "country_sales_growth": COUNTRY_SALES_GROWTH,
}


def _manifest(written: set[str]) -> str:
    """(name, row_count, ok, non_empty) for every result; unwritten ones are (0, false, false)."""
    parts = []
    for name, sql in RESULT_SQL.items():
        if name in written:
            parts.append(
                f"SELECT '{name}' AS name, CAST((SELECT COUNT(*) FROM ({sql.strip()}) t) AS BIGINT) "
                "AS row_count, TRUE AS ok"
            )
        else:
            parts.append(f"SELECT '{name}' AS name, CAST(0 AS BIGINT) AS row_count, FALSE AS ok")
    return "SELECT *, row_count > 0 AS non_empty FROM (" + "\nUNION ALL ".join(parts) + ") m"


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    # --- scans / sinks (read back what was written; equal to the source)
    q["scan_csv"] = _on_raw(f"SELECT {RAW_COLS} FROM raw_retail")
    q["scan_parquet"] = _on_raw(f"SELECT {RAW_COLS} FROM raw_retail")
    q["scan_csv_strings"] = _on_raw(
        "SELECT InvoiceNo, StockCode, Description, CAST(Quantity AS VARCHAR) AS Quantity, InvoiceDate, "
        "CAST(UnitPrice AS VARCHAR) AS UnitPrice, CustomerID, Country FROM raw_retail"
    )
    q["load_retail"] = _on_raw(f"SELECT {RAW_COLS} FROM raw_retail")
    q["ingest_raw"] = _on_raw(f"SELECT {RAW_COLS} FROM raw_retail")
    store = "'S-' || COALESCE(Country, '') AS Store"
    for name in ("scan_csv_reordered", "ingest_raw_extra_columns"):
        q[name] = _on_raw(f"SELECT {RAW_COLS}, {store} FROM raw_retail")
    # The extra column follows from Country, so it doesn't change what is a duplicate.
    q["clean_retail_extra_column"] = _on_clean(f"SELECT *, {store} FROM clean")
    # A derived column takes the place of an extra one of its name.
    clashing = '7 AS Lines, CAST(length(StockCode) AS INTEGER) AS _n, UnitPrice / 2 AS "Unit.Cost"'
    q["clean_retail_clashing_columns"] = _on_clean(f"SELECT *, {clashing} FROM clean")
    q["customer_frequency_clashing_columns"] = _on_clean(CUSTOMER_FREQUENCY)
    q["quality_waterfall_clashing_columns"] = _on_clean(WATERFALL)
    late = "COALESCE(InvoiceNo >= '3', TRUE)"
    q["scan_csv_mixed_headers"] = _on_raw(
        f"SELECT {RAW_COLS}, CASE WHEN {late} THEN 'S-' || COALESCE(Country, '') END AS Store FROM raw_retail"
    )
    q["ingest_checksums"] = _on_raw(
        "SELECT COUNT(*) AS lines, TRUE AS same_bytes, TRUE AS same_manifest FROM raw_retail"
    )
    text = "InvoiceNo, StockCode, Description, InvoiceDate, CustomerID, Country"
    q["sample_rows"] = _on_raw(
        f"SELECT {RAW_COLS} FROM raw_retail WHERE substr(md5(concat_ws('|', {text}, '42')), 1, 8) < '40000000'"
    )
    q["sample_rows_by_identity"] = _on_raw(
        "SELECT COUNT(*) AS lines, TRUE AS within_bounds, TRUE AS subset_and_repeatable, "
        "TRUE AS equal_rows_apart FROM raw_retail"
    )
    one = "CASE WHEN CAST(StockCode AS BIGINT) % 3 = 0 THEN '1' ELSE CustomerID END"
    q["repartition_heavy_customer"] = (
        _with(
            RAW_CTE.replace("raw_retail AS (", "raw_lines AS ("),
            f"raw_retail AS (SELECT * REPLACE ({one} AS CustomerID) FROM raw_lines)",
            CLEAN_CTE,
        )
        + "\nSELECT COUNT(*) AS lines, TRUE AS spread, TRUE AS same_lines FROM clean"
    )
    q["parquet_roundtrip"] = _on_clean("SELECT * FROM clean")
    q["csv_roundtrip"] = _on_clean(DAILY_SALES)
    q["export_single_csv"] = _on_clean(COUNTRY_SALES)
    # --- cleaning steps
    q["filter_cancelled"] = _on_clean(f"SELECT {RAW_COLS} FROM c1")
    q["filter_positive"] = _on_clean(f"SELECT {RAW_COLS} FROM c2")
    q["dedup_rows"] = _on_clean(f"SELECT {RAW_COLS} FROM c3")
    q["require_customer"] = _on_clean(f"SELECT {RAW_COLS} FROM c4")
    q["fill_description"] = _on_clean(
        "SELECT Description, COUNT(*) AS lines FROM c4 GROUP BY Description"
    )
    q["parse_invoice_ts"] = _on_clean(f"SELECT {RAW_COLS}, InvoiceDateTime FROM c6")
    q["time_dimensions"] = _on_clean(
        "SELECT InvoiceNo, StockCode, InvoiceDateTime, InvoiceDate, InvoiceHour, InvoiceYear, InvoiceMonth, "
        "InvoiceDay, InvoiceWeekday, IsWeekend FROM clean"
    )
    q["order_key"] = _on_clean("SELECT InvoiceNo, CustomerID, OrderKey FROM clean")
    q["total_amount"] = _on_clean(
        "SELECT InvoiceNo, StockCode, Quantity, UnitPrice, TotalAmount FROM clean"
    )
    q["clean_retail"] = _on_clean("SELECT * FROM clean")
    q["repartition_by_key"] = _on_clean("SELECT * FROM clean")
    q["quality_waterfall"] = _on_clean(WATERFALL)
    # --- analyses
    q["daily_sales"] = _on_clean(DAILY_SALES)
    q["top20_products"] = _on_clean(TOP20_PRODUCTS)
    q["country_sales"] = _on_clean(COUNTRY_SALES)
    q["customer_frequency"] = _on_clean(CUSTOMER_FREQUENCY)
    q["hourly_orders"] = _on_clean(HOURLY_ORDERS)
    q["rfm_scores"] = _on_clean(RFM_SCORES, RFM_SCORES_CTE)
    q["rfm_segments"] = _on_clean(RFM_SEGMENTS, RFM_SCORES_CTE)
    q["baskets"] = _on_clean(
        "SELECT basket AS InvoiceNo, CAST(COUNT(*) AS INTEGER) AS n_items, "
        "string_agg(item, ',' ORDER BY item) AS items_str FROM bb GROUP BY basket",
        _baskets_cte("clean", "InvoiceNo", "StockCode"),
    )
    q["association_rules"] = _on_clean(
        RULES_SELECT, _baskets_cte("clean", "InvoiceNo", "StockCode"), _rules_cte(0.01, 0.2)
    )
    q["association_rules_description"] = _on_clean(
        RULES_SELECT, _baskets_cte("clean", "InvoiceNo", "Description"), _rules_cte(0.005, 0.05)
    )
    q["association_rules_brand"] = (
        _with(
            BRAND_LINES_CTE,
            _baskets_cte("brand_lines", "InvoiceNo", "p_brand"),
            _rules_cte(0.01, 0.1),
        )
        + "\n"
        + RULES_SELECT
    )
    q["association_rules_type"] = (
        _with(
            BRAND_LINES_CTE,
            _baskets_cte("brand_lines", "InvoiceNo", "p_type"),
            _rules_by_masks_cte(0.01, 0.2),
        )
        + "\n"
        + RULES_SELECT
    )
    q["frequent_itemsets_brand"] = (
        _with(
            BRAND_LINES_CTE,
            _baskets_cte("brand_lines", "InvoiceNo", "p_brand"),
            _rules_cte(0.01, 0.1),
        )
        + "\n"
        + ITEMSETS_SELECT
    )
    q["run_all"] = _on_clean(
        _manifest(set(RESULT_SQL)),
        _baskets_cte("clean", "InvoiceNo", "StockCode"),
        _rules_cte(0.01, 0.2),
        RFM_SCORES_CTE,
        REPURCHASE_CTE,
        QUANTILE_CTE,
    )
    q["verify_outputs"] = _on_clean(
        _manifest({"daily_sales", "country_sales", "hourly_orders"}),
        _baskets_cte("clean", "InvoiceNo", "StockCode"),
        _rules_cte(0.01, 0.2),
        RFM_SCORES_CTE,
        REPURCHASE_CTE,
        QUANTILE_CTE,
    )
    q["repurchase_summary"] = _on_clean(REPURCHASE_SUMMARY, REPURCHASE_CTE)
    q["order_value_quantiles"] = _on_clean(ORDER_VALUE_QUANTILES, QUANTILE_CTE)
    q["order_value_quantiles_approx"] = _on_clean(ORDER_VALUE_QUANTILES_APPROX, QUANTILE_CTE)
    q["order_value_rank_error_by_day"] = _on_clean(ORDER_VALUE_RANK_ERROR, QUANTILE_CTE)
    q["order_value_rank_error"] = _on_clean(ORDER_VALUE_RANK_ERROR, QUANTILE_CTE)
    q["repurchase_gap_lines"] = _on_clean(GAP_LINES)
    q["repurchase_gap_orders"] = _on_clean(GAP_ORDERS)
    q["user_behavior_summary"] = _on_clean(
        f"{REPURCHASE_SUMMARY}\nUNION ALL {ORDER_VALUE_QUANTILES}\nUNION ALL {GAP_LINES.strip()}",
        REPURCHASE_CTE,
        QUANTILE_CTE,
    )
    q["first_purchase_distribution"] = _on_clean(FIRST_PURCHASE)
    q["monthly_sales_trend"] = _on_clean(MONTHLY_SALES_TREND)
    q["product_seasonality"] = _on_clean(PRODUCT_SEASONALITY)
    q["country_sales_growth"] = _on_clean(COUNTRY_SALES_GROWTH)
    # --- benchmark pipeline
    q["bench_sum_by_date"] = _bench("InvoiceDate")
    q["bench_sum_by_country"] = _bench("Country")
    q["bench_sum_by_customer"] = _bench("CustomerID")
    return q
