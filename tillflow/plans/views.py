"""The four BI views.

Each view is one SQL text over the star schema. ``view_frame`` runs it on DataFrames;
``create_views`` registers it in the catalog over saved tables. Facts are summed before
names are joined, so only the sales summary joins dimensions row by row. Which days there are
comes from the table of day totals, not from a second scan of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _over(part: str, whole: str) -> str:
    """A quotient settled on ten decimals, so that ties then round away from zero; null over zero."""
    return (f"CAST(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0D)"
            " AS DECIMAL(28,10))")


def _money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(10,2))"


def _percent(part: str, whole: str) -> str:
    return f"CAST(round({_over(f'({part}) * 100', whole)}, 2) AS DOUBLE)"


def _unless_zero(value: str, zero: str, otherwise: str) -> str:
    return f"CASE WHEN {value} = 0 THEN {zero} ELSE {otherwise} END"


# What a row earns, by columns of the fact.
_PROFIT = "(price - cost) * units_sold"
_SUMMED_PROFIT = f"CAST(sum({_PROFIT}) AS DECIMAL(32,2))"

# One row for each fact row; a blank store name gives way to the id. Money and margin are
# settled before the names are joined.
_SALES_SUMMARY = f"""
WITH earned AS (
  SELECT *,
         {_money(_over('sales_value', 'units_sold'))} AS avg_selling_price,
         {_money('price * units_sold')} AS gross_sales,
         {_money(_PROFIT)} AS gross_profit,
         {_unless_zero('sales_value', _money('0'),
                       _money(_over('(price - cost) * 100', 'price')))} AS gross_margin_pct
  FROM {{fact_sales}}
)
SELECT e.date, store_id, coalesce(nullif(s.store_name, ''), store_id) AS store_name,
       s.retailer_id, r.retailer_name, sku_id, p.sku_name, p.category, p.department,
       e.units_sold, e.sales_value, e.price, e.stock_level, e.promo_active, e.cost,
       e.avg_selling_price, e.gross_sales, e.gross_profit, e.gross_margin_pct,
       c.day_name, c.month_name, c.quarter, c.year, c.is_weekend
FROM earned e
JOIN {{dim_time}} c ON c.date = e.date
JOIN {{dim_retailer}} r ON r.retailer_id = e.retailer_id
JOIN {{dim_sku}} p USING (sku_id)
JOIN {{dim_store}} s USING (store_id)
"""

_SKU_STORE_MATRIX = f"""
WITH sums AS (
  SELECT sku_id, store_id,
         count(DISTINCT date) AS days_available,
         sum(units_sold) AS total_units_sold,
         sum(sales_value) AS total_sales_value,
         CAST(sum(stock_level) AS DOUBLE) / count(stock_level) AS avg_stock_level,
         sum(CASE WHEN stock_level = 0 THEN 1 ELSE 0 END) AS days_out_of_stock,
         CAST(sum(units_sold * price) AS DECIMAL(31,2)) AS gross_sales,
         {_SUMMED_PROFIT} AS gross_profit
  FROM {{fact_sales}}
  GROUP BY sku_id, store_id
)
SELECT s.sku_id, k.sku_name, k.category, k.department, s.store_id, st.store_name, st.location,
       s.days_available, s.total_units_sold, s.total_sales_value, s.avg_stock_level,
       s.days_out_of_stock,
       {_percent('s.days_available', '(SELECT count(date) FROM {fact_days})')}
         AS numeric_distribution_pct,
       s.gross_sales, s.gross_profit,
       {_unless_zero('s.gross_sales', '0D', _percent('s.gross_profit', 's.gross_sales'))}
         AS gross_margin_pct
FROM sums s
JOIN {{dim_sku}} k ON k.sku_id = s.sku_id
JOIN {{dim_store}} st ON st.store_id = s.store_id
"""

# An ISO week across New Year makes two rows, one per calendar year; the year breaks the
# tie between their equal week starts. The lag runs before the names are joined: a join
# keeps or drops all weeks of a pair, and the window then never inherits a partitioning by
# store or product alone, where one busy store would fill a task.
_PRICING_TRENDS = f"""
WITH weeks AS (
  SELECT sku_id, store_id,
         trunc(date, 'WEEK') AS week_start_date, year(date) AS year,
         CAST(sum(price) AS DOUBLE) / count(price) AS avg_weekly_price,
         CAST(sum(cost) AS DOUBLE) / count(cost) AS avg_weekly_cost,
         sum(CASE WHEN promo_active THEN 1 ELSE 0 END) AS promo_days,
         count(DISTINCT date) AS total_days,
         sum(units_sold) AS units_sold,
         sum(sales_value) AS total_sales_value,
         {_SUMMED_PROFIT} AS gross_profit
  FROM {{fact_sales}}
  GROUP BY sku_id, store_id, trunc(date, 'WEEK'), year(date)
), trends AS (
  SELECT *,
         lag(avg_weekly_price) OVER (
           PARTITION BY sku_id, store_id ORDER BY week_start_date, year
         ) AS prev_week_price
  FROM weeks
)
SELECT w.sku_id, k.sku_name, k.category, k.department, w.store_id, st.store_name, st.location,
       w.year, weekofyear(w.week_start_date) AS week_number, w.week_start_date,
       w.avg_weekly_price, w.avg_weekly_cost, w.promo_days, w.total_days,
       {_percent('w.promo_days', 'w.total_days')} AS promo_discount_pct,
       w.units_sold, w.total_sales_value, w.gross_profit,
       {_unless_zero('w.total_sales_value', '0D',
                     _percent('w.gross_profit', 'w.total_sales_value'))} AS gross_margin_pct,
       w.prev_week_price,
       w.avg_weekly_price - w.prev_week_price AS price_change,
       {_percent('w.avg_weekly_price - w.prev_week_price', 'w.prev_week_price')}
         AS price_change_pct
FROM trends w
JOIN {{dim_sku}} k ON k.sku_id = w.sku_id
JOIN {{dim_store}} st ON st.store_id = w.store_id
"""

# All periods are range frames over one ordering, so one shuffle and one sort serve every
# sum. A store and product pair holds at most one row per retailer and day, which bounds
# the window partition by the calendar. The end date is the day before the next promotion
# row, or the last day on record.
_PROMO_ANALYSIS = f"""
WITH days AS (
  SELECT store_id, sku_id, date, unix_date(date) AS day_number, promo_active, price,
         CASE WHEN promo_active THEN units_sold END AS promo_units,
         CASE WHEN NOT promo_active THEN units_sold END AS other_units,
         CASE WHEN promo_active THEN sales_value END AS promo_value,
         CASE WHEN NOT promo_active THEN sales_value END AS other_value
  FROM {{fact_sales}}
), periods AS (
  SELECT store_id, sku_id, date, promo_active, price,
         lead(CASE WHEN promo_active THEN date END) IGNORE NULLS OVER (
           PARTITION BY store_id, sku_id ORDER BY day_number) AS next_promo_date,
         max(CASE WHEN promo_active THEN 1 END) OVER (
           PARTITION BY store_id, sku_id ORDER BY day_number
           RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS promo_day_before,
         coalesce(sum(other_units) OVER (
           PARTITION BY store_id, sku_id ORDER BY day_number
           RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS pre_units,
         coalesce(sum(promo_units) OVER (
           PARTITION BY store_id, sku_id ORDER BY day_number
           RANGE BETWEEN CURRENT ROW AND 6 FOLLOWING), 0) AS during_units,
         coalesce(sum(other_units) OVER (
           PARTITION BY store_id, sku_id ORDER BY day_number
           RANGE BETWEEN 7 FOLLOWING AND 13 FOLLOWING), 0) AS post_units,
         coalesce(sum(other_value) OVER (
           PARTITION BY store_id, sku_id ORDER BY day_number
           RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS pre_value,
         coalesce(sum(promo_value) OVER (
           PARTITION BY store_id, sku_id ORDER BY day_number
           RANGE BETWEEN CURRENT ROW AND 6 FOLLOWING), 0) AS during_value
  FROM days
), starts AS (
  SELECT * FROM periods
  WHERE promo_active AND promo_day_before IS NULL AND during_units > 0
)
SELECT p.sku_id, k.sku_name, k.category, k.department, p.store_id, st.store_name, st.location,
       p.date AS promo_start_date,
       coalesce(date_sub(p.next_promo_date, 1), (SELECT max(date) FROM {{fact_days}}))
         AS promo_end_date,
       7 AS promo_duration_days,
       p.price AS promo_price,
       p.pre_units / 7D AS avg_daily_units_pre_promo,
       p.during_units / 7D AS avg_daily_units_during_promo,
       p.post_units / 7D AS avg_daily_units_post_promo,
       CAST(p.pre_value AS DOUBLE) / 7D AS avg_daily_revenue_pre_promo,
       CAST(p.during_value AS DOUBLE) / 7D AS avg_daily_revenue_during_promo,
       {_unless_zero('p.pre_units', '0D', _percent('p.during_units - p.pre_units', 'p.pre_units'))}
         AS units_uplift_pct,
       {_unless_zero('p.pre_value', '0D', _percent('p.during_value - p.pre_value', 'p.pre_value'))}
         AS revenue_uplift_pct
FROM starts p
JOIN {{dim_sku}} k ON k.sku_id = p.sku_id
JOIN {{dim_store}} st ON st.store_id = p.store_id
ORDER BY promo_start_date DESC, units_uplift_pct DESC, p.store_id, p.sku_id
"""

VIEW_SQL = {
    "sales_summary_view": _SALES_SUMMARY,
    "sku_store_matrix_view": _SKU_STORE_MATRIX,
    "pricing_trends_view": _PRICING_TRENDS,
    "promo_analysis_view": _PROMO_ANALYSIS,
}
STAR_TABLES = ("fact_sales", "fact_days", "dim_store", "dim_retailer", "dim_sku", "dim_time")


def view_frame(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The view over given DataFrames; without ``fact_days`` the days are found in the fact."""
    text = VIEW_SQL[name]
    if "fact_days" not in tables:
        tables = {**tables, "fact_days": tables["fact_sales"].select("date").distinct()}
    used = {t: tables[t] for t in STAR_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def create_views(spark: SparkSession, database: str = "default") -> list[str]:
    """Drop and create the four views over the saved star tables of ``database``."""
    names = {t: f"{database}.{t}" for t in STAR_TABLES}
    for view in VIEW_SQL:
        spark.sql(f"DROP VIEW IF EXISTS {database}.{view}")
    for view, text in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS {text.format(**names)}")
    return list(VIEW_SQL)
