"""SQL twins of the registered queries, for DuckDB over the same Parquet tables.

from the Spark code: date ranges are correlated lookups, medians and tiles are plain SQL.
"""

AS_OF = "DATE '1999-02-28'"
TWO_MONTHS_BACK = "DATE '1998-12-01'"
LAST_MONTH = "DATE '1999-01-01'"

SALE_LINES = """
sale_lines AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS retailer_id, CAST(n_nationkey AS VARCHAR) AS store_id,
         p_brand AS sku_id,
         DATE '1998-11-02' + CAST(datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 119
                                  AS INTEGER) AS date,
         n_nationkey AS store_number,
         CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS sku_number,
         CAST(datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 119 AS INTEGER)
           AS day_number,
         l_orderkey AS order_number, l_linenumber AS line_number,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(12,2)) AS value,
         CAST(p_retailprice AS DECIMAL(10,2)) AS list_price,
         p_name AS item_name, p_type AS item_type
  FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey
)"""

FACT_ROWS = """
fact_sales AS (
  SELECT *, CAST(price * CAST(0.7 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS cost
  FROM (
    SELECT retailer_id, store_id, sku_id, date,
           CAST(sum(CASE WHEN (store_number * 7 + sku_number) % 41 = 0 THEN 0 ELSE quantity END)
                AS INTEGER) AS units_sold,
           CAST(sum(CASE WHEN (store_number * 7 + sku_number) % 41 = 0
                         THEN CAST(0 AS DECIMAL(12,2)) ELSE value END)
                AS DECIMAL(12,2)) AS sales_value,
           CAST(min((order_number * 31 + line_number * 17) % 12) AS INTEGER) AS stock_level,
           bool_or((day_number // 7 + sku_number + store_number) % 5 = 0) AS promo_active,
           max(list_price) AS price
    FROM sale_lines
    WHERE NOT (store_number % 9 = 4 AND sku_number > 12)
    GROUP BY retailer_id, store_id, sku_id, date
  )
)"""

FACT = f"{SALE_LINES}, {FACT_ROWS}"

DIMS = """
dim_store AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS store_id, CAST(n_regionkey AS VARCHAR) AS retailer_id,
         CASE WHEN n_nationkey % 7 = 3 THEN '' ELSE n_name END AS store_name, r_name AS location
  FROM nation JOIN region ON n_regionkey = r_regionkey
), dim_retailer AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS retailer_id, r_name AS retailer_name FROM region
), dim_sku AS (
  SELECT DISTINCT p_brand AS sku_id,
         'Product ' || CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS sku_name,
         'Category ' || (CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) % 5) AS category,
         'Department ' || (CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) % 3)
           AS department,
         p_brand AS brand
  FROM part
)"""


def calendar(source: str) -> str:
    return f"""
dim_time AS (
  SELECT date, CAST(isodow(date) AS INTEGER) AS day_of_week, dayname(date) AS day_name,
         CAST(week(date) AS INTEGER) AS week_number, CAST(month(date) AS INTEGER) AS month_number,
         monthname(date) AS month_name, CAST(quarter(date) AS INTEGER) AS quarter,
         CAST(year(date) AS INTEGER) AS year, isodow(date) >= 6 AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM {source})
)"""


def pct(part: str, whole: str) -> str:
    """part / whole in percent, rounded half away from zero at two decimals."""
    return (f"CAST(round(CAST(CAST(({part}) * 100 AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"
            f" AS DECIMAL(28,10)), 2) AS DOUBLE)")


FACT_ONLY = f"WITH {FACT}"
STAR = f"WITH {FACT}, {DIMS}"
PROMO_UNITS = "sum(CASE WHEN promo_active THEN units_sold ELSE 0 END)"
OTHER_UNITS = "sum(CASE WHEN NOT promo_active THEN units_sold ELSE 0 END)"

STOCKOUTS = """
  SELECT f.store_id, st.store_name, f.sku_id, k.sku_name, f.date, f.stock_level, f.units_sold,
         'Stockout' AS issue_type
  FROM fact_sales f JOIN dim_sku k USING (sku_id) JOIN dim_store st ON st.store_id = f.store_id
  WHERE f.stock_level = 0 AND f.date = (SELECT max(date) FROM fact_sales)"""

DEAD_STOCK = f"""
  SELECT f.store_id, st.store_name, f.sku_id, k.sku_name, f.stock AS stock_level,
         f.units AS units_sold_last_30_days, 'Dead Stock' AS issue_type
  FROM (SELECT store_id, sku_id, CAST(sum(units_sold) AS BIGINT) AS units,
               max(stock_level) AS stock
        FROM fact_sales WHERE date >= {AS_OF} - 30
        GROUP BY store_id, sku_id HAVING sum(units_sold) = 0) f
  JOIN dim_sku k USING (sku_id) JOIN dim_store st ON st.store_id = f.store_id
  WHERE f.stock > 0"""

PROMO_GAPS = f"""
  SELECT p.store_id, st.store_name, p.sku_id, k.sku_name, p.units AS promo_units,
         o.units AS non_promo_units, {pct('p.units - o.units', 'o.units')} AS uplift_pct,
         'Low Promo Uplift' AS issue_type
  FROM (SELECT store_id, sku_id, CAST(sum(units_sold) AS BIGINT) AS units FROM fact_sales
        WHERE date >= {AS_OF} - 90 AND promo_active GROUP BY store_id, sku_id) p
  JOIN (SELECT store_id, sku_id, CAST(sum(units_sold) AS BIGINT) AS units FROM fact_sales
        WHERE date >= {AS_OF} - 90 AND NOT promo_active GROUP BY store_id, sku_id) o
    ON o.store_id = p.store_id AND o.sku_id = p.sku_id
  JOIN dim_sku k ON k.sku_id = p.sku_id JOIN dim_store st ON st.store_id = p.store_id
  WHERE o.units > 0 AND p.units * 5 < o.units * 6"""

REPORTS = {
    "kpi_sales_summary": f"""{FACT_ONLY}
SELECT date, count(DISTINCT store_id) AS store_count, count(DISTINCT sku_id) AS sku_count,
       CAST(sum(units_sold) AS BIGINT) AS total_units_sold,
       CAST(sum(sales_value) AS DECIMAL(22,2)) AS total_sales_value,
       CAST({PROMO_UNITS} AS BIGINT) AS promo_units_sold,
       CAST(sum(CASE WHEN promo_active THEN sales_value ELSE CAST(0 AS DECIMAL(12,2)) END)
            AS DECIMAL(22,2)) AS promo_sales_value
FROM fact_sales WHERE date >= {TWO_MONTHS_BACK} GROUP BY date""",
    "kpi_sales_growth_mom": f"""{FACT_ONLY}, monthly AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month,
         CAST(sum(sales_value) AS DECIMAL(22,2)) AS total_sales
  FROM fact_sales WHERE date >= {TWO_MONTHS_BACK} GROUP BY 1
)
SELECT * FROM (
  SELECT month, total_sales, lag(total_sales) OVER (ORDER BY month) AS prev_month_sales,
         {pct('total_sales - lag(total_sales) OVER (ORDER BY month)',
              'lag(total_sales) OVER (ORDER BY month)')} AS mom_growth_pct
  FROM monthly) WHERE prev_month_sales IS NOT NULL""",
    "kpi_asp_analysis": f"""{FACT_ONLY}, per_sku AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month, sku_id,
         CAST(round(CAST(CAST(sum(sales_value) AS DOUBLE) / nullif(sum(units_sold), 0)
              AS DECIMAL(28,10)), 2) AS DECIMAL(12,2)) AS asp
  FROM fact_sales WHERE date >= {TWO_MONTHS_BACK} GROUP BY 1, 2
)
SELECT month, CAST(sum(asp) AS DOUBLE) / count(asp) AS avg_asp,
       quantile_cont(CAST(asp AS DOUBLE), 0.5) AS median_asp,
       min(asp) AS min_asp, max(asp) AS max_asp, count(DISTINCT sku_id) AS sku_count
FROM per_sku GROUP BY month""",
    "kpi_numeric_distribution": f"""{FACT_ONLY}, recent AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month, store_id, sku_id
  FROM fact_sales WHERE date >= {TWO_MONTHS_BACK}
), per_store AS (
  SELECT month, store_id, count(DISTINCT sku_id) AS skus FROM recent GROUP BY 1, 2
), totals AS (
  SELECT month, count(DISTINCT sku_id) AS total FROM recent GROUP BY 1
)
SELECT month, CAST(sum(skus) AS DOUBLE) / CAST(count(*) * any_value(total) AS DOUBLE) * 100
         AS avg_numeric_distribution_pct,
       CAST(min(skus) AS DOUBLE) / any_value(total) * 100 AS min_numeric_distribution_pct,
       CAST(max(skus) AS DOUBLE) / any_value(total) * 100 AS max_numeric_distribution_pct
FROM per_store JOIN totals USING (month) GROUP BY month""",
    "kpi_promo_uplift": f"""{FACT_ONLY}, weeks AS (
  SELECT sku_id, date_trunc('week', date) AS week, {PROMO_UNITS} AS pu, {OTHER_UNITS} AS nu,
         sum(CASE WHEN promo_active THEN sales_value ELSE CAST(0 AS DECIMAL(12,2)) END) AS ps,
         sum(CASE WHEN NOT promo_active THEN sales_value ELSE CAST(0 AS DECIMAL(12,2)) END) AS ns
  FROM fact_sales WHERE date >= {TWO_MONTHS_BACK} GROUP BY 1, 2
  HAVING count(*) FILTER (promo_active) > 0 AND count(*) FILTER (NOT promo_active) > 0
)
SELECT sku_id, count(*) AS promo_weeks, CAST(sum(pu) AS BIGINT) AS total_promo_units,
       CAST(sum(nu) AS BIGINT) AS total_non_promo_units,
       CAST(sum(ps) AS DECIMAL(32,2)) AS total_promo_sales,
       CAST(sum(ns) AS DECIMAL(32,2)) AS total_non_promo_sales,
       {pct('sum(pu) - sum(nu)', 'sum(nu)')} AS uplift_pct
FROM weeks GROUP BY sku_id HAVING sum(nu) > 0
ORDER BY uplift_pct DESC, sku_id LIMIT 50""",
    "kpi_sku_velocity": f"""{FACT_ONLY}, per_sku AS (
  SELECT sku_id, CAST(sum(units_sold) AS BIGINT) AS total_units,
         count(DISTINCT date) AS days_with_sales
  FROM fact_sales WHERE date >= {LAST_MONTH} GROUP BY sku_id HAVING count(DISTINCT date) >= 5
)
SELECT sku_id, total_units, days_with_sales,
       CAST(total_units // days_with_sales AS DOUBLE) AS avg_daily_units,
       CAST(ntile(4) OVER (ORDER BY total_units // days_with_sales, sku_id) AS INTEGER)
         AS velocity_quartile
FROM per_sku""",
    "kpi_problem_stores": f"""{STAR}, stores AS (
  SELECT store_id, count(DISTINCT sku_id) AS sku_count,
         CAST(sum(units_sold) AS BIGINT) AS total_units,
         CAST(sum(sales_value) AS DECIMAL(22,2)) AS total_sales,
         count(DISTINCT date) AS days_open,
         CAST(sum(CASE WHEN stock_level = 0 THEN 1 ELSE 0 END) AS BIGINT) AS out_of_stock_days
  FROM fact_sales WHERE date >= {LAST_MONTH} GROUP BY store_id
), average AS (
  SELECT avg(sku_count) AS skus, avg(total_units) AS units FROM stores
)
SELECT s.store_id, st.store_name, sku_count, total_units, total_sales, days_open,
       out_of_stock_days, {pct('out_of_stock_days', 'days_open')} AS oos_pct,
       CASE WHEN sku_count < 0.7 * a.skus THEN 'Low SKU Count'
            WHEN total_units < 0.5 * a.units THEN 'Low Volume'
            ELSE 'High OOS Rate' END AS performance_issue
FROM stores s CROSS JOIN average a JOIN dim_store st ON st.store_id = s.store_id
WHERE sku_count < 0.7 * a.skus OR total_units < 0.5 * a.units
      OR CAST(out_of_stock_days AS DOUBLE) / days_open > 0.2""",
    "flag_stockouts": f"{STAR} {STOCKOUTS}",
    "flag_dead_stock": f"{STAR} {DEAD_STOCK}",
    "flag_promo_gaps": f"{STAR} {PROMO_GAPS}",
    "flag_issue_summary": f"""{STAR}
SELECT 'Stockouts' AS issue_type, count(*) AS count FROM ({STOCKOUTS})
UNION ALL SELECT 'Dead Stock', count(*) FROM ({DEAD_STOCK})
UNION ALL SELECT 'Promo Gaps', count(*) FROM ({PROMO_GAPS})""",
}

VIEWS = {
    "view_sales_summary": f"""{STAR}, {calendar('fact_sales')}
SELECT f.date, f.store_id, coalesce(nullif(st.store_name, ''), st.store_id) AS store_name,
       st.retailer_id, r.retailer_name, f.sku_id, k.sku_name, k.category, k.department,
       f.units_sold, f.sales_value, f.price, f.stock_level, f.promo_active, f.cost,
       CAST(CAST(CAST(f.sales_value AS DOUBLE) / nullif(f.units_sold, 0) AS DECIMAL(28,10))
            AS DECIMAL(10,2)) AS avg_selling_price,
       CAST(f.price * f.units_sold AS DECIMAL(10,2)) AS gross_sales,
       CAST((f.price - f.cost) * f.units_sold AS DECIMAL(10,2)) AS gross_profit,
       CASE WHEN f.sales_value = 0 THEN CAST(0 AS DECIMAL(10,2))
            ELSE CAST({pct('f.price - f.cost', 'f.price')} AS DECIMAL(10,2)) END
         AS gross_margin_pct,
       t.day_name, t.month_name, t.quarter, t.year, t.is_weekend
FROM fact_sales f JOIN dim_store st ON st.store_id = f.store_id
     JOIN dim_retailer r ON r.retailer_id = f.retailer_id
     JOIN dim_sku k ON k.sku_id = f.sku_id JOIN dim_time t ON t.date = f.date""",
    "view_sku_store_matrix": f"""{STAR}
SELECT f.sku_id, k.sku_name, k.category, k.department, f.store_id, st.store_name, st.location,
       count(DISTINCT f.date) AS days_available,
       CAST(sum(f.units_sold) AS BIGINT) AS total_units_sold,
       CAST(sum(f.sales_value) AS DECIMAL(22,2)) AS total_sales_value,
       CAST(sum(f.stock_level) AS DOUBLE) / count(f.stock_level) AS avg_stock_level,
       CAST(sum(CASE WHEN f.stock_level = 0 THEN 1 ELSE 0 END) AS BIGINT) AS days_out_of_stock,
       {pct('count(DISTINCT f.date)', '(SELECT count(DISTINCT date) FROM fact_sales)')}
         AS numeric_distribution_pct,
       CAST(sum(f.units_sold * f.price) AS DECIMAL(31,2)) AS gross_sales,
       CAST(sum((f.price - f.cost) * f.units_sold) AS DECIMAL(32,2)) AS gross_profit,
       CASE WHEN sum(f.units_sold * f.price) = 0 THEN 0
            ELSE {pct('sum((f.price - f.cost) * f.units_sold)', 'sum(f.units_sold * f.price)')}
       END AS gross_margin_pct
FROM fact_sales f JOIN dim_sku k ON k.sku_id = f.sku_id
     JOIN dim_store st ON st.store_id = f.store_id
GROUP BY f.sku_id, k.sku_name, k.category, k.department, f.store_id, st.store_name,
         st.location""",
    "view_pricing_trends": f"""{STAR}, weeks AS (
  SELECT sku_id, store_id, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
         CAST(year(date) AS INTEGER) AS year, CAST(week(date) AS INTEGER) AS week_number,
         CAST(sum(price) AS DOUBLE) / count(price) AS avg_weekly_price,
         CAST(sum(cost) AS DOUBLE) / count(cost) AS avg_weekly_cost,
         CAST(sum(CASE WHEN promo_active THEN 1 ELSE 0 END) AS BIGINT) AS promo_days,
         count(DISTINCT date) AS total_days, CAST(sum(units_sold) AS BIGINT) AS units_sold,
         CAST(sum(sales_value) AS DECIMAL(22,2)) AS total_sales_value,
         CAST(sum((price - cost) * units_sold) AS DECIMAL(32,2)) AS gross_profit
  FROM fact_sales GROUP BY 1, 2, 3, 4, 5
), joined AS (
  SELECT w.*, k.sku_name, k.category, k.department, st.store_name, st.location,
         lag(avg_weekly_price) OVER (PARTITION BY w.sku_id, w.store_id
                                     ORDER BY week_start_date, year) AS prev_week_price
  FROM weeks w JOIN dim_sku k ON k.sku_id = w.sku_id
       JOIN dim_store st ON st.store_id = w.store_id
)
SELECT sku_id, sku_name, category, department, store_id, store_name, location, year,
       week_number, week_start_date, avg_weekly_price, avg_weekly_cost, promo_days, total_days,
       {pct('promo_days', 'total_days')} AS promo_discount_pct, units_sold, total_sales_value,
       gross_profit,
       CASE WHEN total_sales_value = 0 THEN 0
            ELSE {pct('gross_profit', 'total_sales_value')} END AS gross_margin_pct,
       prev_week_price, avg_weekly_price - prev_week_price AS price_change,
       {pct('avg_weekly_price - prev_week_price', 'prev_week_price')} AS price_change_pct
FROM joined""",
    "view_promo_analysis": f"""{STAR}, promo_rows AS (
  SELECT sku_id, store_id, date, price,
         lead(date) OVER (PARTITION BY sku_id, store_id ORDER BY date) AS next_date
  FROM fact_sales WHERE promo_active
), starts AS (
  SELECT * FROM promo_rows p
  WHERE NOT EXISTS (SELECT 1 FROM promo_rows q WHERE q.sku_id = p.sku_id
                    AND q.store_id = p.store_id AND q.date = p.date - 1)
), sums AS (
  SELECT s.sku_id, s.store_id, s.date, any_value(s.price) AS price,
         any_value(s.next_date) AS next_date,
         coalesce(sum(f.units_sold) FILTER (NOT f.promo_active AND f.date < s.date), 0)
           AS pre_units,
         coalesce(sum(f.units_sold) FILTER (f.promo_active
                  AND f.date BETWEEN s.date AND s.date + 6), 0) AS during_units,
         coalesce(sum(f.units_sold) FILTER (NOT f.promo_active
                  AND f.date BETWEEN s.date + 7 AND s.date + 13), 0) AS post_units,
         coalesce(sum(f.sales_value) FILTER (NOT f.promo_active AND f.date < s.date), 0)
           AS pre_value,
         coalesce(sum(f.sales_value) FILTER (f.promo_active
                  AND f.date BETWEEN s.date AND s.date + 6), 0) AS during_value
  FROM starts s JOIN fact_sales f ON f.sku_id = s.sku_id AND f.store_id = s.store_id
       AND f.date BETWEEN s.date - 7 AND s.date + 13
  GROUP BY s.sku_id, s.store_id, s.date
)
SELECT s.sku_id, k.sku_name, k.category, k.department, s.store_id, st.store_name, st.location,
       s.date AS promo_start_date,
       coalesce(s.next_date - 1, (SELECT max(date) FROM fact_sales)) AS promo_end_date,
       CAST(7 AS INTEGER) AS promo_duration_days, s.price AS promo_price,
       CAST(pre_units AS DOUBLE) / 7 AS avg_daily_units_pre_promo,
       CAST(during_units AS DOUBLE) / 7 AS avg_daily_units_during_promo,
       CAST(post_units AS DOUBLE) / 7 AS avg_daily_units_post_promo,
       CAST(pre_value AS DOUBLE) / 7 AS avg_daily_revenue_pre_promo,
       CAST(during_value AS DOUBLE) / 7 AS avg_daily_revenue_during_promo,
       CASE WHEN pre_units = 0 THEN 0 ELSE {pct('during_units - pre_units', 'pre_units')} END
         AS units_uplift_pct,
       CASE WHEN pre_value = 0 THEN 0 ELSE {pct('during_value - pre_value', 'pre_value')} END
         AS revenue_uplift_pct
FROM sums s JOIN dim_sku k ON k.sku_id = s.sku_id JOIN dim_store st ON st.store_id = s.store_id
WHERE during_units > 0""",
}

RAW = SALE_LINES + """,
picked AS (
  SELECT *, order_number * 7 + line_number * 3 + quantity AS pick,
         CAST(quantity AS VARCHAR) AS units, CAST(value AS VARCHAR) AS money FROM sale_lines
), raw_sales AS (
  SELECT CASE pick % 89 WHEN 0 THEN 'no such store' WHEN 1 THEN NULL ELSE store_id END
           AS STORE_NAME,
         CASE pick % 83 WHEN 0 THEN 'no such item' WHEN 1 THEN NULL ELSE sku_id END AS ITEM_CODE,
         CASE pick % 13 WHEN 0 THEN '  o''neil   100g ' || item_name || '-wine '
           WHEN 1 THEN item_name || ' 500ML' WHEN 2 THEN '1 lb ' || item_name
           WHEN 3 THEN item_name || ' 6 pack' WHEN 4 THEN 'x 5 large ' || item_name
           WHEN 5 THEN NULL ELSE item_name END AS ITEM_NAME,
         item_type AS CATEGORY,
         CASE pick % 23 WHEN 0 THEN '1,' || lpad(units, 3, '0') WHEN 1 THEN '-' || units
           WHEN 2 THEN '(' || units || ')' WHEN 3 THEN '1.2.3' WHEN 4 THEN '1e5' WHEN 5 THEN ''
           WHEN 6 THEN NULL WHEN 7 THEN units || '.9' ELSE units END AS QTY,
         CASE pick % 19 WHEN 0 THEN '' WHEN 1 THEN '$' || money WHEN 2 THEN '-' || money
           WHEN 3 THEN 'n/a' ELSE money END AS SALES_PRE_VAT,
         CASE pick % 17 WHEN 0 THEN strftime(date, '%d/%m/%Y') WHEN 1 THEN '1999-02-30'
           WHEN 2 THEN 'x' WHEN 3 THEN NULL ELSE strftime(date, '%Y-%m-%d') END AS "Date",
         CASE pick % 11 WHEN 0 THEN '1,234.50' WHEN 1 THEN '$9.99' WHEN 2 THEN ''
           WHEN 3 THEN NULL ELSE CAST(list_price AS VARCHAR) END AS RRP,
         CASE pick % 7 WHEN 0 THEN '' ELSE CAST(list_price AS VARCHAR) END AS PRICE,
         CASE pick % 5 WHEN 0 THEN '' ELSE '4.25' END AS COST,
         CASE pick % 29 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE CAST(pick % 12 AS VARCHAR) END
           AS STOCK,
         CASE pick % 6 WHEN 0 THEN 'Y' WHEN 1 THEN '1' WHEN 2 THEN 'true' WHEN 3 THEN ''
           WHEN 4 THEN NULL ELSE 'N' END AS PROMO_FLAG,
         order_number, line_number, store_id, sku_id, date, quantity, value
  FROM picked
)"""
RAW_ONLY = f"WITH {RAW}"
FEED_ORDER = ("order_number DESC, line_number DESC, f_store DESC, f_sku DESC, f_date DESC, "
              "quantity DESC, value DESC")


def number(column: str, kind: str = "DOUBLE", signed: bool = False) -> str:
    value = f"TRY_CAST(regexp_replace({column}, '[^0-9.]', '', 'g') AS {kind})"
    if not signed:
        return value
    return f"CASE WHEN regexp_matches({column}, '^\\s*[-(]') THEN -{value} ELSE {value} END"


def iso_date(column: str) -> str:
    return (f"CASE WHEN regexp_full_match({column}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') "
            f"THEN TRY_CAST({column} AS DATE) END")


def any_date(column: str) -> str:
    return f"coalesce({iso_date(column)}, CAST(try_strptime({column}, '%d/%m/%Y') AS DATE))"


def transformed(signed: bool = False, stock_default: int = 0) -> str:
    """The raw feed as fact rows with the reason of a reject."""
    n = lambda column, kind="DOUBLE": number(column, kind, signed)
    return f"""parsed AS (
  SELECT STORE_NAME AS store_id, ITEM_CODE AS sku_id, {any_date('"Date"')} AS date,
         CAST(trunc(coalesce({n('QTY')}, 0)) AS INTEGER) AS units_sold,
         coalesce({n('SALES_PRE_VAT', 'DECIMAL(12,2)')}, 0) AS sales_value,
         CAST(trunc(coalesce({n('STOCK')}, {stock_default})) AS INTEGER) AS stock_level,
         coalesce(lower(trim(PROMO_FLAG)) IN ('1', 't', 'true', 'y', 'yes'), false)
           AS promo_active,
         CAST(coalesce({n('RRP', 'DECIMAL(10,2)')}, {n('PRICE', 'DECIMAL(10,2)')},
              CAST(CAST(coalesce({n('SALES_PRE_VAT')}, 0)
                   / CASE WHEN coalesce({n('QTY')}, 0) = 0 THEN 1 ELSE {n('QTY')} END
                   AS DECIMAL(28,10)) AS DECIMAL(10,2))) AS DECIMAL(10,2)) AS price,
         {n('COST', 'DECIMAL(10,2)')} AS given_cost,
         order_number, line_number, store_id AS f_store, sku_id AS f_sku, date AS f_date,
         quantity, value
  FROM raw_sales
), transformed AS (
  SELECT '7' AS retailer_id, store_id, sku_id, date, units_sold,
         CAST(sales_value AS DECIMAL(12,2)) AS sales_value, stock_level, promo_active, price,
         CAST(coalesce(given_cost, CAST(price * CAST(0.7 AS DECIMAL(2,1)) AS DECIMAL(10,2)))
              AS DECIMAL(10,2)) AS cost,
         CASE WHEN store_id IS NULL OR trim(store_id) = '' OR sku_id IS NULL
                   OR trim(sku_id) = '' THEN 'missing_key'
              WHEN date IS NULL THEN 'invalid_date' END AS reject_reason,
         order_number, line_number, f_store, f_sku, f_date, quantity, value
  FROM parsed
), batch AS (
  SELECT * FROM transformed WHERE reject_reason IS NULL
)"""


FACT_COLUMNS = ("retailer_id, store_id, sku_id, date, units_sold, sales_value, stock_level, "
                "promo_active, price, cost")
BATCH = f"WITH {RAW}, {transformed()}"
BATCH_DIMS = f"{BATCH}, {DIMS}"

MASTER = """
master AS (
  SELECT CASE WHEN p_size <= 25 THEN p_brand ELSE 'P' || p_partkey END AS sku_id,
         trim('  ' || p_name || ' ') AS sku_name,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS category,
         'Dept ' || (p_partkey % 7) AS department, 'Sub ' || (p_partkey % 5) AS sub_department,
         'Micro ' || (p_partkey % 11) AS micro_department,
         CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS brand,
         CASE WHEN p_partkey % 2 = 0 THEN '20' ELSE '0' END AS vat_rate,
         'Supplier ' || (p_partkey % 13) AS supplier, p_partkey AS sheet_row
  FROM part
), first_rows AS (
  SELECT * FROM master QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY sheet_row) = 1
), last_rows AS (
  SELECT * FROM master QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY sheet_row DESC) = 1
)"""

STORE_SHEET = """
sheet AS (
  SELECT trim(CASE WHEN s_suppkey % 10 = 0 THEN '  ' WHEN s_suppkey % 10 = 1 THEN 'S' || s_suppkey
              ELSE ' ' || s_nationkey END) AS store_id,
         trim(s_name || '  ') AS store_name,
         CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Region ' || (s_suppkey % 4) END AS region,
         'kiosk' AS store_type, s_suppkey AS sheet_row
  FROM supplier
), taken AS (
  SELECT * FROM sheet WHERE store_id <> ''
  QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY sheet_row DESC) = 1
)"""

STAMPS = """CASE WHEN d.{key} IS NULL THEN DATE '1999-03-01' END AS created_at,
       CASE WHEN i.{key} IS NOT NULL THEN DATE '1999-03-01' END AS updated_at"""
_NULL_TEXT = "CAST(NULL AS VARCHAR)"

_MISSING = ("('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
            "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')")
_SCANNED = ["STORE_NAME", "ITEM_CODE", "ITEM_NAME", "CATEGORY", "QTY", "SALES_PRE_VAT", '"Date"',
            "RRP", "PRICE", "COST", "STOCK", "PROMO_FLAG"]


def loaded(known_only: bool) -> str:
    """The latest batch row per fact key."""
    known = ("AND store_id IN (SELECT store_id FROM dim_store) "
             "AND sku_id IN (SELECT sku_id FROM dim_sku)" if known_only else "")
    return f"""latest AS (
  SELECT * FROM batch WHERE true {known}
  QUALIFY row_number() OVER (PARTITION BY retailer_id, store_id, sku_id, date
                             ORDER BY {FEED_ORDER}) = 1
)"""


INGEST = {
    "sales_csv_scan": f"""{RAW_ONLY} SELECT {', '.join(
        f"CASE WHEN {c} NOT IN {_MISSING} THEN {c} END AS {c}" for c in _SCANNED)}
FROM raw_sales""",
    "clean_numeric": f"""{RAW_ONLY}
SELECT QTY AS qty_text, {number('QTY')} AS qty, {number('QTY', signed=True)} AS signed_qty,
       {number('SALES_PRE_VAT', 'DECIMAL(12,2)')} AS sales,
       CAST({number('SALES_PRE_VAT', 'DECIMAL(12,2)', True)} AS DECIMAL(12,2)) AS signed_sales,
       {number('RRP', 'DECIMAL(10,2)')} AS rrp
FROM raw_sales""",
    "parse_dates": f"""{RAW_ONLY}
SELECT "Date" AS date_text, {iso_date('"Date"')} AS iso_date, {any_date('"Date"')} AS any_date
FROM raw_sales""",
    "clean_text": f"""{RAW_ONLY}
SELECT ITEM_NAME, coalesce(array_to_string(list_transform(
         regexp_extract_all(lower(trim(regexp_replace(ITEM_NAME, '\\s+', ' ', 'g'))),
                            '[a-z]+|[^a-z]+'),
         lambda w: upper(w[1]) || w[2:]), ''), '') AS tidy_name
FROM raw_sales""",
    "extract_pack_size": f"""{RAW_ONLY}
SELECT ITEM_NAME, coalesce(regexp_extract(ITEM_NAME,
         '(?i)(\\d+\\s*(?:g|kg|ml|l|oz|lb|pcs?|pack|pk|ct))', 1), '') AS pack_size
FROM raw_sales""",
    "validate_sales": f"""{RAW_ONLY}, cleaned AS (
  SELECT STORE_NAME, ITEM_CODE, ITEM_NAME, CATEGORY, {number('QTY')} AS QTY,
         {number('SALES_PRE_VAT')} AS SALES_AMOUNT, {iso_date('"Date"')} AS DATE, RRP,
         {number('PRICE')} AS PRICE, {number('COST')} AS COST, STOCK, PROMO_FLAG,
         STORE_NAME IS NULL OR ITEM_CODE IS NULL OR QTY IS NULL OR SALES_PRE_VAT IS NULL
           OR "Date" IS NULL AS missing
  FROM raw_sales
), distinct_rows AS (
  SELECT DISTINCT COLUMNS(* EXCLUDE (missing)) FROM cleaned
)
SELECT count(*) AS total_records, CAST(sum(CAST(missing AS INTEGER)) AS BIGINT)
         AS missing_required_fields,
       CAST(count(*) FILTER (QTY IS NULL) + count(*) FILTER (SALES_AMOUNT IS NULL)
            + count(*) FILTER (PRICE IS NULL) + count(*) FILTER (COST IS NULL) AS BIGINT)
         AS invalid_numeric_values,
       CAST(0 AS BIGINT) AS negative_values,
       count(*) FILTER (DATE IS NULL) AS invalid_dates,
       count(*) - (SELECT count(*) FROM distinct_rows) AS duplicate_records,
       count(*) AS valid_records, CAST(100 AS DOUBLE) AS valid_pct
FROM cleaned""",
    "transform_fact": f"WITH {RAW}, {transformed()} SELECT {FACT_COLUMNS}, reject_reason "
                      "FROM transformed",
    "transform_fact_signed": f"WITH {RAW}, {transformed(True, 5)} "
                             f"SELECT {FACT_COLUMNS}, reject_reason FROM transformed",
    "dim_time": f"{FACT_ONLY}, {calendar('fact_sales')} SELECT * FROM dim_time",
    "dim_retailer_ensure": f"""WITH {DIMS}
SELECT retailer_id, retailer_name FROM dim_retailer
UNION ALL
SELECT DISTINCT CAST(s_nationkey AS VARCHAR), 'Retailer ' || s_nationkey FROM supplier
WHERE CAST(s_nationkey AS VARCHAR) NOT IN (SELECT retailer_id FROM dim_retailer)""",
    "dim_sku_merge": f"""WITH {DIMS}, {MASTER}
SELECT coalesce(d.sku_id, i.sku_id) AS sku_id, coalesce(i.sku_name, d.sku_name) AS sku_name,
       coalesce(i.category, d.category) AS category, {_NULL_TEXT} AS subcategory,
       coalesce(i.department, d.department) AS department, i.sub_department, i.micro_department,
       coalesce(i.brand, d.brand) AS brand, {_NULL_TEXT} AS pack_size, i.supplier, i.vat_rate,
       CAST(NULL AS DECIMAL(10,2)) AS rrp, CAST(NULL AS DECIMAL(10,2)) AS cost,
       {STAMPS.format(key='sku_id')}
FROM dim_sku d FULL JOIN first_rows i ON i.sku_id = d.sku_id""",
    "dim_sku_from_sales": f"""{BATCH_DIMS}, seen AS (
  SELECT sku_id, cost FROM batch
  QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY {FEED_ORDER}) = 1
)
SELECT coalesce(d.sku_id, i.sku_id) AS sku_id, coalesce(d.sku_name, 'Unknown SKU') AS sku_name,
       coalesce(d.category, 'Unknown') AS category,
       CASE WHEN i.sku_id IS NOT NULL THEN 'Unknown' END AS subcategory, d.department,
       {_NULL_TEXT} AS sub_department, {_NULL_TEXT} AS micro_department,
       coalesce(d.brand, 'Unknown') AS brand, {_NULL_TEXT} AS pack_size,
       CASE WHEN i.sku_id IS NOT NULL THEN 'Unknown' END AS supplier, {_NULL_TEXT} AS vat_rate,
       CASE WHEN i.sku_id IS NOT NULL THEN CAST(0 AS DECIMAL(10,2)) END AS rrp, i.cost,
       {STAMPS.format(key='sku_id')}
FROM dim_sku d FULL JOIN seen i ON i.sku_id = d.sku_id""",
    "dim_store_merge": f"""{BATCH_DIMS}, seen AS (SELECT DISTINCT store_id FROM batch)
SELECT coalesce(d.store_id, i.store_id) AS store_id, d.retailer_id,
       coalesce(d.store_name, i.store_id) AS store_name, d.location,
       CASE WHEN i.store_id IS NOT NULL THEN 'Unknown' END AS region,
       CASE WHEN i.store_id IS NOT NULL THEN 'Unknown' END AS area,
       CASE WHEN i.store_id IS NOT NULL THEN 'Unknown' END AS store_type,
       {STAMPS.format(key='store_id')}
FROM dim_store d FULL JOIN seen i ON i.store_id = d.store_id""",
    "dim_store_upsert": f"""WITH {DIMS}, {STORE_SHEET}
SELECT coalesce(d.store_id, i.store_id) AS store_id, d.retailer_id,
       coalesce(i.store_name, d.store_name) AS store_name, d.location, i.region,
       {_NULL_TEXT} AS area, i.store_type, {STAMPS.format(key='store_id')}
FROM dim_store d FULL JOIN taken i ON i.store_id = d.store_id""",
    "dim_store_upsert_counts": f"""WITH {STORE_SHEET}
SELECT count(*) FILTER (store_id <> '') AS upserted, count(*) FILTER (store_id = '') AS errors
FROM (SELECT DISTINCT store_id, store_name, region, store_type FROM sheet)""",
    "dim_sku_replace": f"WITH {MASTER} SELECT * EXCLUDE (sheet_row) FROM first_rows",
    "dim_sku_enrich": f"""WITH {DIMS}, {MASTER}
SELECT d.sku_id, coalesce(m.sku_name, d.sku_name) AS sku_name,
       coalesce(m.category, d.category) AS category,
       coalesce(m.department, d.department) AS department, d.brand
FROM dim_sku d LEFT JOIN last_rows m ON m.sku_id = d.sku_id""",
    "fk_filter": f"""{BATCH_DIMS} SELECT {FACT_COLUMNS} FROM batch
WHERE sku_id IN (SELECT sku_id FROM dim_sku) AND store_id IN (SELECT store_id FROM dim_store)""",
    "fk_quarantine": f"""{BATCH_DIMS} SELECT {FACT_COLUMNS},
       CASE WHEN sku_id NOT IN (SELECT sku_id FROM dim_sku) THEN 'unknown_sku'
            ELSE 'unknown_store' END AS reject_reason
FROM batch WHERE sku_id NOT IN (SELECT sku_id FROM dim_sku)
      OR store_id NOT IN (SELECT store_id FROM dim_store)""",
    "incremental_filter": f"{BATCH} SELECT {FACT_COLUMNS} FROM batch "
                          "WHERE date > DATE '1999-01-31'",
    "watermark": f"{BATCH} SELECT 'last_processed_date' AS key, "
                 "CAST(max(date) AS VARCHAR) AS value FROM batch",
    "load_summary": f"""{BATCH} SELECT count(*) AS total_records, min(date) AS first_date,
       max(date) AS last_date, count(DISTINCT store_id) AS unique_stores,
       count(DISTINCT sku_id) AS unique_skus,
       CAST(sum(sales_value) AS DECIMAL(22,2)) AS total_sales_value,
       CAST(sum(units_sold) AS BIGINT) AS total_units_sold FROM batch""",
    "schema_evolution": f"""{FACT_ONLY}
SELECT retailer_id, store_id, sku_id, date, units_sold, sales_value,
       CAST(NULL AS INTEGER) AS stock_level, promo_active, price,
       CAST(NULL AS DECIMAL(10,2)) AS cost, CAST(NULL AS VARCHAR) AS channel FROM fact_sales
UNION ALL SELECT {FACT_COLUMNS}, 'store' FROM fact_sales""",
    "upsert_fact": f"""WITH {RAW}, {FACT_ROWS}, {transformed()},
{loaded(False)}, incoming AS (
  SELECT * REPLACE ('1' AS retailer_id) FROM latest
)
SELECT {FACT_COLUMNS.replace('retailer_id', 'f.retailer_id', 1)}, CAST(NULL AS DATE) AS created_at
FROM fact_sales f ANTI JOIN incoming USING (retailer_id, store_id, sku_id, date)
UNION ALL
SELECT {FACT_COLUMNS},
       CASE WHEN (retailer_id, store_id, sku_id, date) IN
                 (SELECT (retailer_id, store_id, sku_id, date) FROM fact_sales)
            THEN NULL ELSE DATE '1999-03-01' END
FROM incoming""",
    "batch_load": f"""{BATCH_DIMS}, {loaded(True)}
SELECT {FACT_COLUMNS}, DATE '1999-03-01' AS created_at FROM latest""",
    "batch_load_rejects": f"""{BATCH_DIMS}
SELECT {FACT_COLUMNS}, reject_reason FROM transformed WHERE reject_reason IS NOT NULL
UNION ALL
SELECT {FACT_COLUMNS},
       CASE WHEN sku_id NOT IN (SELECT sku_id FROM dim_sku) THEN 'unknown_sku'
            ELSE 'unknown_store' END
FROM batch WHERE sku_id NOT IN (SELECT sku_id FROM dim_sku)
      OR store_id NOT IN (SELECT store_id FROM dim_store)""",
    "stream_landing": f"""{FACT_ONLY}, later AS (
  SELECT * REPLACE (date + 1 AS date, units_sold + 1 AS units_sold) FROM fact_sales
)
SELECT {FACT_COLUMNS}, DATE '1999-03-01' AS created_at
FROM fact_sales ANTI JOIN later USING (retailer_id, store_id, sku_id, date)
UNION ALL SELECT {FACT_COLUMNS}, DATE '1999-03-01' FROM later""",
    "check_freshness": f"""{FACT_ONLY}
SELECT max(date) AS last_load,
       datediff('hour', CAST(max(date) AS TIMESTAMP), TIMESTAMP '1999-03-05 09:00:00')
         * CAST(1 AS DOUBLE) AS hours_since_load,
       true AS check_due,
       datediff('hour', CAST(max(date) AS TIMESTAMP), TIMESTAMP '1999-03-05 09:00:00') > 24
         AS stale
FROM fact_sales""",
    "report_files": REPORTS["kpi_sales_summary"],
}

ORACLES = {**REPORTS, **VIEWS, **INGEST}


def part_grain(sql: str) -> str:
    """The same report with single parts as products."""
    return sql.replace("p_brand AS sku_id", "'P' || p_partkey AS sku_id").replace(
        "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS sku_number",
        "p_partkey % 25 AS sku_number")


ORACLES |= {f"{name}_part": part_grain(ORACLES[name])
            for name in ("kpi_asp_analysis", "kpi_promo_uplift", "kpi_sku_velocity")}
ORACLES["sales_csv_quoted"] = f"""WITH {SALE_LINES}
SELECT store_id AS STORE_NAME, sku_id AS ITEM_CODE,
       item_name || CASE line_number % 4 WHEN 0 THEN ' 12" pan' WHEN 1 THEN ' C:\\'
                         WHEN 2 THEN ', "large"' ELSE '' END AS ITEM_NAME
FROM sale_lines"""
ORACLES["sales_csv_headings"] = f"""WITH {SALE_LINES}
SELECT store_id AS STORE_NAME, sku_id AS ITEM_CODE, item_name AS ITEM_CODE_2 FROM sale_lines"""
ORACLES["saved_view"] = VIEWS["view_sales_summary"]
ORACLES["sales_csv_latin1"] = f"""WITH {SALE_LINES}
SELECT store_id AS STORE_NAME, sku_id AS ITEM_CODE,
       item_name || CASE line_number % 2 WHEN 1 THEN ' Café' ELSE ' Caf\ufffd é' END AS ITEM_NAME
FROM sale_lines"""
ORACLES["stream_landing_latin1"] = f"""{FACT_ONLY}
SELECT {FACT_COLUMNS.replace('store_id', "'Café ' || store_id AS store_id")},
       DATE '1999-03-01' AS created_at FROM fact_sales"""
ORACLES["dim_store_from_master"] = ORACLES["dim_store_upsert"].replace(
    "ORDER BY sheet_row DESC", "ORDER BY sheet_row")
ORACLES["evolved_upsert"] = f"""{FACT_ONLY}
SELECT * REPLACE (CASE WHEN promo_active OR stock_level = 0 THEN units_sold + 1
                       ELSE units_sold END AS units_sold),
       CASE WHEN NOT promo_active AND stock_level = 0 THEN 'web' ELSE 'store' END AS channel
FROM fact_sales"""
ORACLES["loaded_dimensions"] = f"""{BATCH_DIMS}, {MASTER}, {calendar('batch')}, skus AS (
  SELECT coalesce(d.sku_id, i.sku_id) AS sku_id, coalesce(i.sku_name, d.sku_name) AS sku_name
  FROM dim_sku d FULL JOIN first_rows i ON i.sku_id = d.sku_id
)
SELECT 'dim_retailer' AS table_name, 'DEFAULT' AS key, 'Default Retailer' AS label
UNION ALL SELECT 'dim_retailer', '7', 'Retailer 7'
UNION ALL SELECT 'dim_sku', sku_id, sku_name FROM skus
UNION ALL SELECT DISTINCT 'dim_sku', sku_id, 'Unknown SKU' FROM batch
WHERE sku_id NOT IN (SELECT sku_id FROM skus)
UNION ALL SELECT 'dim_store', store_id, store_name FROM dim_store
UNION ALL SELECT DISTINCT 'dim_store', store_id, store_id FROM batch
WHERE store_id NOT IN (SELECT store_id FROM dim_store)
UNION ALL SELECT 'dim_time', CAST(date AS VARCHAR), day_name FROM dim_time"""
ORACLES["report_counts"] = " UNION ALL ".join(
    f"SELECT '{name.split('_', 1)[1]}' AS report, count(*) AS rows FROM ({sql})"
    for name, sql in REPORTS.items())
ORACLES["watermark_state"] = ORACLES["watermark"]
ORACLES["load_counts"] = f"""{BATCH_DIMS}, mark AS (
  SELECT max(date) AS day FROM batch WHERE date <= DATE '1999-01-31'
), checked AS (
  SELECT date > (SELECT day FROM mark) AS fresh,
         sku_id IN (SELECT sku_id FROM dim_sku)
           AND store_id IN (SELECT store_id FROM dim_store) AS known
  FROM batch
)
SELECT count(*) FILTER (fresh AND known) AS loaded,
       count(*) FILTER (fresh AND NOT known)
         + (SELECT count(*) FROM transformed WHERE reject_reason IS NOT NULL) AS rejected,
       count(*) FILTER (NOT fresh) AS skipped
FROM checked"""

ORACLES["day_totals"] = f"""{FACT_ONLY}
SELECT date, count(*) AS fact_rows, count(DISTINCT store_id) AS store_count,
       count(DISTINCT sku_id) AS sku_count, CAST(sum(units_sold) AS BIGINT) AS total_units_sold,
       CAST(sum(sales_value) AS DECIMAL(22,2)) AS total_sales_value,
       CAST(coalesce(sum(units_sold) FILTER (promo_active), 0) AS BIGINT) AS promo_units_sold,
       CAST(coalesce(sum(sales_value) FILTER (promo_active), 0) AS DECIMAL(22,2))
         AS promo_sales_value
FROM fact_sales GROUP BY date"""
for _name in ("kpi_sales_summary", "kpi_sales_growth_mom", "kpi_numeric_distribution",
              "flag_stockouts"):
    ORACLES[f"{_name}_days"] = REPORTS[_name]
ORACLES["kpi_numeric_distribution_days_part"] = part_grain(REPORTS["kpi_numeric_distribution"])
ORACLES["evolved_dimension"] = f"""{BATCH_DIMS}, {MASTER}, late AS (
  SELECT * FROM master WHERE sheet_row % 2 = 0
  QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY sheet_row) = 1
), merged AS (
  SELECT coalesce(d.sku_id, i.sku_id) AS sku_id,
         coalesce(l.sku_name, i.sku_name, d.sku_name) AS sku_name,
         coalesce(CAST(l.sheet_row AS BIGINT) * 10000000000, i.sheet_row) AS shelf
  FROM dim_sku d FULL JOIN first_rows i ON i.sku_id = d.sku_id
       LEFT JOIN late l ON l.sku_id = i.sku_id
)
SELECT * FROM merged
UNION ALL SELECT DISTINCT sku_id, 'Unknown SKU', CAST(NULL AS BIGINT) FROM batch
WHERE sku_id NOT IN (SELECT sku_id FROM merged)"""
ORACLES["watermark_withdrawn"] = f"""{BATCH} SELECT 'last_processed_date' AS key,
       CAST(max(date) AS VARCHAR) AS value FROM batch WHERE date <= DATE '1999-01-31'"""
ORACLES["catalog_listing"] = """
SELECT 'dim_' || t AS table_name, CAST(n AS INTEGER) AS ordinal, c AS column_name, k AS data_type
FROM (VALUES ('retailer', 1, 'retailer_id', 'string'), ('retailer', 2, 'retailer_name', 'string'),
             ('retailer', 3, 'created_at', 'date'), ('time', 1, 'date', 'date'),
             ('time', 2, 'day_of_week', 'int'), ('time', 3, 'day_name', 'string'),
             ('time', 4, 'week_number', 'int'), ('time', 5, 'month_number', 'int'),
             ('time', 6, 'month_name', 'string'), ('time', 7, 'quarter', 'int'),
             ('time', 8, 'year', 'int'), ('time', 9, 'is_weekend', 'boolean')) AS v(t, n, c, k)"""
ORACLES["load_validation"] = ORACLES["validate_sales"]
_TIDY = """array_to_string(list_transform(
         regexp_extract_all(lower(trim(regexp_replace({}, '\\s+', ' ', 'g'))),
                            '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '')"""
ORACLES["loaded_products"] = f"""WITH {RAW}, {transformed()}, fed AS (
  SELECT t.sku_id, t.order_number, t.line_number, t.f_store, t.f_sku, t.f_date, t.quantity,
         t.value, r.ITEM_NAME, r.CATEGORY AS category
  FROM batch t JOIN (
    SELECT order_number AS o, line_number AS l, store_id AS s, sku_id AS k, date AS d,
           quantity AS q, value AS v, ITEM_NAME, CATEGORY FROM raw_sales) r
    ON o = t.order_number AND l = t.line_number AND s = t.f_store AND k = t.f_sku
       AND d = t.f_date AND q = t.quantity AND v = t.value
  QUALIFY row_number() OVER (PARTITION BY t.sku_id ORDER BY {FEED_ORDER}) = 1
)
SELECT sku_id, coalesce(nullif({_TIDY.format('ITEM_NAME')}, ''), 'Unknown SKU') AS sku_name,
       coalesce(nullif(trim(category), ''), 'Unknown') AS category,
       nullif(regexp_extract(ITEM_NAME,
         '(?i)(\\d+\\s*(?:g|kg|ml|l|oz|lb|pcs?|pack|pk|ct))', 1), '') AS pack_size,
       'Unknown' AS brand
FROM fed"""
ORACLES["required_columns"] = """
SELECT c AS column_name, c = 'QTY' AS missing, (SELECT count(*) FROM lineitem) AS rows
FROM (VALUES ('STORE_ID'), ('ITEM_CODE'), ('QTY'), ('SALES_AMOUNT'), ('DATE')) AS v(c)"""
ORACLES["column_population"] = f"WITH {RAW}, {transformed()} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS filled FROM transformed"
    for c in [*FACT_COLUMNS.split(", "), "reject_reason"])
ORACLES["calendar_gaps"] = f"""WITH {SALE_LINES}, near AS (
  SELECT date FROM sale_lines WHERE order_number % 1000 <> 0
), {calendar('near')}
SELECT date, day_name, false AS far FROM dim_time
UNION ALL SELECT DATE '9999-01-01', dayname(DATE '9999-01-01'), true
WHERE EXISTS (SELECT 1 FROM sale_lines WHERE order_number % 1000 = 0)"""
ORACLES["sales_csv_ragged"] = f"""{FACT_ONLY}, sheet AS (
  SELECT store_id, sku_id, CAST(units_sold AS VARCHAR) AS units,
         CAST(sales_value AS VARCHAR) AS value, CAST(date AS VARCHAR) AS date, day(date) AS d
  FROM fact_sales
)
SELECT store_id AS STORE_NAME, sku_id AS ITEM_CODE, units AS QTY,
       CASE WHEN d <> 5 THEN value END AS SALES_PRE_VAT, CASE WHEN d <> 5 THEN date END AS "Date",
       CASE d WHEN 3 THEN concat_ws(',', store_id, sku_id, units, value, date, 'x')
              WHEN 5 THEN concat_ws(',', store_id, sku_id, units) END AS ragged_line
FROM sheet"""
ORACLES["load_ragged_counts"] = f"""{FACT_ONLY}, sheet AS (
  SELECT day(date) IN (3, 5) AS ragged, length(CASE day(date)
           WHEN 3 THEN concat_ws(',', store_id, sku_id, units_sold, sales_value, date, 'x')
           WHEN 5 THEN concat_ws(',', store_id, sku_id, units_sold) END) AS size
  FROM fact_sales
)
SELECT count(*) FILTER (NOT ragged) AS loaded, count(*) FILTER (ragged) AS rejected,
       count(*) FILTER (ragged) AS ragged, CAST(max(size) AS INTEGER) AS longest
FROM sheet"""
ORACLES["discovered_files"] = f"""{FACT_ONLY}
SELECT CAST(0 AS INTEGER) AS run, count(*) FILTER (date <= DATE '1999-01-31') AS loaded
FROM fact_sales
UNION ALL SELECT 1, count(*) FILTER (date > DATE '1999-01-31') FROM fact_sales
UNION ALL SELECT 2, 0"""
