"""Sales reports and issue flags.

Every report is a function of the fact, the dimensions it names and the report date
``as_of``. Most are lazy; ``asp_analysis``, ``sku_velocity`` and ``problem_stores`` run jobs
and write checkpoints when they are built. Date bounds are literals on the fact's partition column, so a saved
fact is pruned to the months in question. No join carries a broadcast hint: the
planner and AQE broadcast a side only when its measured size allows it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillflow.functions.dates import month_start, previous_month, two_months_back, week_start
from tillflow.functions.numbers import percent, round2
from tillflow.operators.day_totals import distinct_skus
from tillflow.operators.ranking import ntile, percentile, value_counts
from tillflow.session import shared_folder

# Report thresholds.
TOP_UPLIFTS = 50
MIN_SELLING_DAYS = 5
DEAD_STOCK_DAYS = 30
PROMO_GAP_DAYS = 90
LOW_UPLIFT_PCT = 20


def _since(fact: DataFrame, first_day: dt.date) -> DataFrame:
    return fact.filter(F.col("date") >= F.lit(first_day))


def _sum_where(condition: Column, column: str, kind: str = "int") -> Column:
    return F.sum(F.when(condition, F.col(column)).otherwise(F.lit(0).cast(kind)))


def _rows_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def sales_summary(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Per day: stores, products, units and value, in all and on promotion."""
    promo = F.col("promo_active")
    return (
        _since(fact, two_months_back(as_of))
        .groupBy("date")
        .agg(
            F.count_distinct("store_id").alias("store_count"),
            F.count_distinct("sku_id").alias("sku_count"),
            F.sum("units_sold").alias("total_units_sold"),
            F.sum("sales_value").alias("total_sales_value"),
            _sum_where(promo, "units_sold").alias("promo_units_sold"),
            _sum_where(promo, "sales_value", "decimal(12,2)").alias("promo_sales_value"),
        )
        .orderBy(F.desc("date"))
    )


def sales_summary_of_days(fact_days: DataFrame, as_of: dt.date) -> DataFrame:
    """``sales_summary`` from the day totals, without the fact."""
    return _since(fact_days, two_months_back(as_of)).drop("fact_rows").select(
        "date", "store_count", "sku_count", "total_units_sold", "total_sales_value",
        "promo_units_sold", "promo_sales_value").orderBy(F.desc("date"))


def sales_growth_mom(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Monthly value against the month before; the first month has nothing to compare.

    ``fact`` may be the day totals as well: their column of sums is then added up.
    """
    value = "total_sales_value" if "total_sales_value" in fact.columns else "sales_value"
    monthly = (
        _since(fact, two_months_back(as_of))
        .groupBy(month_start(F.col("date")).alias("month"))
        .agg(F.sum(value).cast("decimal(22,2)").alias("total_sales"))
    )
    # A handful of months: this window never sees more rows than the calendar has months.
    previous = F.lag("total_sales").over(Window.orderBy("month"))
    growth = F.col("total_sales") - F.col("prev_month_sales")
    return (
        monthly.withColumn("prev_month_sales", previous)
        .filter(F.col("prev_month_sales").isNotNull())
        .withColumn("mom_growth_pct", percent(growth, F.col("prev_month_sales")))
        .orderBy(F.desc("month"))
    )


def asp_analysis(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Spread of the products' average selling prices, per month."""
    price = F.col("sales_value").cast("double") / F.nullif(F.col("units_sold"), F.lit(0))
    per_sku = (
        _since(fact, two_months_back(as_of))
        .groupBy("sku_id", month_start(F.col("date")).alias("month"))
        .agg(F.sum("sales_value").alias("sales_value"), F.sum("units_sold").alias("units_sold"))
        .select("month", round2(price).cast("decimal(12,2)").alias("asp"))
    )
    counts = value_counts(per_sku, ["month"], "asp")
    known = F.when(F.col("asp").isNotNull(), F.col("_count"))
    spread = counts.groupBy("month").agg(
        (F.sum(F.col("asp") * F.col("_count")).cast("double") / F.sum(known)).alias("avg_asp"),
        F.min("asp").alias("min_asp"),
        F.max("asp").alias("max_asp"),
        F.sum("_count").alias("sku_count"),
    )
    median = percentile(counts, ["month"], "asp", 0.5, "median_asp")
    return (
        spread.join(median, "month", "left")
        .select("month", "avg_asp", "median_asp", "min_asp", "max_asp", "sku_count")
        .orderBy(F.desc("month"))
    )


def numeric_distribution(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Share of the month's assortment that the stores carry.

    Products per store and month and per month are counted as two grouping sets of one
    scan, so the month's total needs neither a second scan nor a join.
    """
    recent = _since(fact, two_months_back(as_of)).select(
        month_start(F.col("date")).alias("month"), "store_id", "sku_id"
    )
    counts = recent.groupingSets([["month", "store_id"], ["month"]], "month", "store_id").agg(
        F.count_distinct("sku_id").alias("skus"), F.grouping("store_id").alias("all_stores")
    )
    return _distribution(counts)


def _distribution(counts: DataFrame) -> DataFrame:
    """Of (month, skus, all_stores): per store with 0, and of the whole month with 1."""
    of_store = F.when(F.col("all_stores") == 0, F.col("skus"))
    monthly = counts.groupBy("month").agg(
        F.sum(of_store).alias("sum_skus"), F.count(of_store).alias("stores"),
        F.min(of_store).alias("min_skus"), F.max(of_store).alias("max_skus"),
        F.max(F.when(F.col("all_stores") == 1, F.col("skus"))).alias("total_skus"),
    )
    total = F.nullif(F.col("total_skus"), F.lit(0)).cast("double")
    share = lambda skus, divisor: F.col(skus).cast("double") / divisor * 100
    return monthly.select(
        "month",
        share("sum_skus", F.col("stores") * total).alias("avg_numeric_distribution_pct"),
        share("min_skus", total).alias("min_numeric_distribution_pct"),
        share("max_skus", total).alias("max_numeric_distribution_pct"),
    ).orderBy(F.desc("month"))


def numeric_distribution_of_days(day_stores: DataFrame, as_of: dt.date) -> DataFrame:
    """``numeric_distribution`` from the bitmaps of days and stores, without the fact.

    The sets of a month's days are or-ed once per store; those of the stores give the month's.
    """
    months = _since(day_stores, two_months_back(as_of)).groupBy(
        month_start(F.col("date")).alias("month"), "store_id", "bucket").agg(
        F.bitmap_or_agg("skus").alias("skus"))
    by_store = distinct_skus(months, "month", "store_id").withColumn("all_stores", F.lit(0))
    of_month = distinct_skus(months, "month").withColumn("all_stores", F.lit(1))
    return _distribution(by_store.drop("store_id").unionByName(of_month))


def promo_uplift(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """The products with the strongest uplift over weeks that had both kinds of days."""
    promo = F.col("promo_active")
    weeks = (
        _since(fact, two_months_back(as_of))
        .groupBy("sku_id", week_start(F.col("date")).alias("week"))
        .agg(
            _sum_where(promo, "units_sold").alias("promo_units"),
            _sum_where(~promo, "units_sold").alias("other_units"),
            _sum_where(promo, "sales_value", "decimal(12,2)").alias("promo_sales"),
            _sum_where(~promo, "sales_value", "decimal(12,2)").alias("other_sales"),
            _rows_where(promo).alias("promo_rows"),
            _rows_where(~promo).alias("other_rows"),
        )
        .filter((F.col("promo_rows") > 0) & (F.col("other_rows") > 0))
    )
    gain = F.col("total_promo_units") - F.col("total_non_promo_units")
    return (
        weeks.groupBy("sku_id")
        .agg(
            F.count(F.lit(1)).alias("promo_weeks"),
            F.sum("promo_units").alias("total_promo_units"),
            F.sum("other_units").alias("total_non_promo_units"),
            F.sum("promo_sales").alias("total_promo_sales"),
            F.sum("other_sales").alias("total_non_promo_sales"),
        )
        .filter(F.col("total_non_promo_units") > 0)
        .withColumn("uplift_pct", percent(gain, F.col("total_non_promo_units")))
        .orderBy(F.desc_nulls_first("uplift_pct"), "sku_id")
        .limit(TOP_UPLIFTS)
    )


def sku_velocity(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Whole units a day per product, in four tiles from slow to fast."""
    per_sku = (
        _since(fact, previous_month(as_of))
        .groupBy("sku_id")
        .agg(
            F.sum("units_sold").alias("total_units"),
            F.count_distinct("date").alias("days_with_sales"),
        )
        .filter(F.col("days_with_sales") >= MIN_SELLING_DAYS)
        .withColumn("avg_daily_units", F.expr("total_units div days_with_sales"))
    )
    return (
        ntile(per_sku, ["avg_daily_units", "sku_id"], 4, "velocity_quartile")
        .withColumn("avg_daily_units", F.col("avg_daily_units").cast("double"))
        .orderBy(F.desc_nulls_first("avg_daily_units"), "sku_id")
    )


def problem_stores(fact: DataFrame, dim_store: DataFrame, as_of: dt.date) -> DataFrame:
    """Stores with a thin range, little volume or many stock-outs against the average store.

    Ratios are compared as products of whole numbers, so no rounding decides a case. The
    row per store is checkpointed: its sums and its averages would each scan the fact.
    """
    shared_folder(fact.sparkSession)
    stores = (
        _since(fact, previous_month(as_of))
        .groupBy("store_id")
        .agg(
            F.count_distinct("sku_id").alias("sku_count"),
            F.sum("units_sold").alias("total_units"),
            F.sum("sales_value").alias("total_sales"),
            F.count_distinct("date").alias("days_open"),
            _rows_where(F.col("stock_level") == 0).alias("out_of_stock_days"),
        )
        .checkpoint()
    )
    exact = lambda name: F.col(name).cast("decimal(30,0)")
    totals = stores.agg(F.struct(
        F.count("sku_count").alias("n"),
        F.sum("sku_count").cast("decimal(30,0)").alias("skus"),
        F.count("total_units").alias("n_units"),
        F.sum("total_units").cast("decimal(30,0)").alias("units"),
    )).scalar()
    few_skus = exact("sku_count") * F.col("_all.n") * 10 < F.col("_all.skus") * 7
    low_volume = exact("total_units") * F.col("_all.n_units") * 2 < F.col("_all.units")
    often_out = F.col("out_of_stock_days") * 5 > F.col("days_open")
    order = F.when(few_skus, 1).when(low_volume, 2).when(often_out, 3)
    return (
        stores.withColumn("_all", totals)
        .withColumn("_order", order)
        .filter(F.col("_order").isNotNull())
        .join(dim_store.select("store_id", "store_name"), "store_id")
        .orderBy("_order", "total_units", "store_id")
        .select(
            "store_id", "store_name", "sku_count", "total_units", "total_sales", "days_open",
            "out_of_stock_days",
            percent(F.col("out_of_stock_days"), F.col("days_open")).alias("oos_pct"),
            F.when(F.col("_order") == 1, "Low SKU Count")
            .when(F.col("_order") == 2, "Low Volume")
            .otherwise("High OOS Rate").alias("performance_issue"),
        )
    )


def _with_names(rows: DataFrame, dim_sku: DataFrame, dim_store: DataFrame) -> DataFrame:
    return rows.join(dim_store.select("store_id", "store_name"), "store_id").join(
        dim_sku.select("sku_id", "sku_name"), "sku_id"
    )


def stockouts(fact: DataFrame, dim_sku: DataFrame, dim_store: DataFrame,
              fact_days: DataFrame | None = None) -> DataFrame:
    """Rows without stock on the latest day, which the day totals tell if they are given."""
    latest = (fact if fact_days is None else fact_days).agg(F.max("date")).scalar()
    out = fact.filter((F.col("date") == latest) & (F.col("stock_level") == 0))
    return (
        _with_names(out, dim_sku, dim_store)
        .select("store_id", "store_name", "sku_id", "sku_name", "date", "stock_level",
                "units_sold", F.lit("Stockout").alias("issue_type"))
        .orderBy("store_id", "sku_id")
    )


def dead_stock(fact: DataFrame, dim_sku: DataFrame, dim_store: DataFrame,
               as_of: dt.date) -> DataFrame:
    """Products in stock that sold nothing for 30 days; the stock is the highest seen."""
    idle = (
        _since(fact, as_of - dt.timedelta(days=DEAD_STOCK_DAYS))
        .groupBy("store_id", "sku_id")
        .agg(F.sum("units_sold").alias("units_sold_last_30_days"),
             F.max("stock_level").alias("stock_level"))
        .filter((F.col("units_sold_last_30_days") == 0) & (F.col("stock_level") > 0))
    )
    return (
        _with_names(idle, dim_sku, dim_store)
        .select("store_id", "store_name", "sku_id", "sku_name", "stock_level",
                "units_sold_last_30_days", F.lit("Dead Stock").alias("issue_type"))
        .orderBy("store_id", "sku_id")
    )


def promo_gaps(fact: DataFrame, dim_sku: DataFrame, dim_store: DataFrame,
               as_of: dt.date) -> DataFrame:
    """Store products whose promotion days lift units by less than 20 percent.

    One pass with conditional sums; the threshold applies before rounding.
    """
    promo = F.col("promo_active")
    sums = (
        _since(fact, as_of - dt.timedelta(days=PROMO_GAP_DAYS))
        .groupBy("store_id", "sku_id")
        .agg(
            F.coalesce(_sum_where(promo, "units_sold"), F.lit(0)).alias("promo_units"),
            F.coalesce(_sum_where(~promo, "units_sold"), F.lit(0)).alias("non_promo_units"),
            _rows_where(promo).alias("promo_rows"),
        )
        .filter((F.col("promo_rows") > 0) & (F.col("non_promo_units") > 0))
        .filter(F.col("promo_units") * 100 < F.col("non_promo_units") * (100 + LOW_UPLIFT_PCT))
    )
    gain = F.col("promo_units") - F.col("non_promo_units")
    return (
        _with_names(sums, dim_sku, dim_store)
        .select("store_id", "store_name", "sku_id", "sku_name", "promo_units", "non_promo_units",
                percent(gain, F.col("non_promo_units")).alias("uplift_pct"),
                F.lit("Low Promo Uplift").alias("issue_type"))
        .orderBy("uplift_pct", "store_id", "sku_id")
    )


def issue_summary(stockout_rows: DataFrame, dead_stock_rows: DataFrame,
                  promo_gap_rows: DataFrame) -> DataFrame:
    """How many issues of each kind there are."""
    kinds = {"Stockouts": stockout_rows, "Dead Stock": dead_stock_rows,
             "Promo Gaps": promo_gap_rows}
    counts = [
        rows.agg(F.count(F.lit(1)).alias("count")).select(F.lit(kind).alias("issue_type"), "count")
        for kind, rows in kinds.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def all_reports(tables: dict[str, DataFrame], as_of: dt.date) -> dict[str, DataFrame]:
    """Every report by name. A failing report fails: an empty one means "no issues".

    What the day totals and bitmaps hold is taken from them, if ``tables`` has them.
    """
    fact, sku, store = tables["fact_sales"], tables["dim_sku"], tables["dim_store"]
    days, day_stores = tables.get("fact_days"), tables.get("fact_day_stores")
    flags = {
        "stockouts": stockouts(fact, sku, store, days),
        "dead_stock": dead_stock(fact, sku, store, as_of),
        "promo_gaps": promo_gaps(fact, sku, store, as_of),
    }
    return {
        "sales_summary": (sales_summary(fact, as_of) if days is None
                          else sales_summary_of_days(days, as_of)),
        "sales_growth_mom": sales_growth_mom(fact if days is None else days, as_of),
        "asp_analysis": asp_analysis(fact, as_of),
        "numeric_distribution": (numeric_distribution(fact, as_of) if day_stores is None
                                 else numeric_distribution_of_days(day_stores, as_of)),
        "promo_uplift": promo_uplift(fact, as_of),
        "sku_velocity": sku_velocity(fact, as_of),
        "problem_stores": problem_stores(fact, store, as_of),
        **flags,
        "issue_summary": issue_summary(*flags.values()),
    }
