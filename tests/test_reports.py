"""Reports, views and ranks: hand-made traps, brute force, and the plans they run as."""

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.operators.ranking import ntile, percentile, value_counts
from tillflow.plans import reports
from tillflow.plans.views import VIEW_SQL, view_frame
from tillflow.schemas import FACT_SALES, TABLES, conform
from tillflow.sources.order_lines import AS_OF

COLUMNS = "store_id string, sku_id string, date date, units_sold int, promo_active boolean, " \
          "sales_value decimal(12,2), stock_level int, price decimal(10,2), cost decimal(10,2)"


def fact(spark, *rows):
    """Rows of (store, sku, day, units, promo) with optional value, stock and price."""
    full = []
    for st, sk, d, u, promo, *rest in rows:
        value, stock, price = (list(rest) + [None] * 3)[:3]
        price = Decimal(price or "2.00")
        full.append((st, sk, d, u, promo, Decimal(value or u), 1 if stock is None else stock,
                     price, Decimal("1.00")))
    return conform(spark.createDataFrame(full, COLUMNS).withColumn("retailer_id", F.lit("r")),
                   FACT_SALES)


def dims(spark, stores, skus):
    store = spark.createDataFrame([(s, s.upper(), "r") for s in stores],
                                  "store_id string, store_name string, retailer_id string")
    sku = spark.createDataFrame([(s, s.upper()) for s in skus], "sku_id string, sku_name string")
    return {"dim_store": conform(store, TABLES["dim_store"]),
            "dim_sku": conform(sku, TABLES["dim_sku"])}


def day(n, month=1, year=1999):
    return dt.date(year, month, n)


def test_unknown_promotion_counts_for_neither_side(spark):
    rows = fact(spark, ("s", "a", day(4), 6, True), ("s", "a", day(5), 4, False),
                ("s", "a", day(6), 100, None))
    row = reports.promo_uplift(rows, AS_OF).first()
    assert (row.total_promo_units, row.total_non_promo_units, row.uplift_pct) == (6, 4, 50.0)
    summary = {r.date: r for r in reports.sales_summary(rows, AS_OF).collect()}
    assert (summary[day(6)].total_units_sold, summary[day(6)].promo_units_sold) == (100, 0)


def test_uplift_keeps_the_top_fifty(spark):
    rows = []
    for i in range(60):
        rows += [("s", f"k{i:02d}", day(4), 5 if i < 55 else 9, True),
                 ("s", f"k{i:02d}", day(5), 5, False)]
    top = [r.sku_id for r in reports.promo_uplift(fact(spark, *rows), AS_OF).collect()]
    assert top == [f"k{i}" for i in range(55, 60)] + [f"k{i:02d}" for i in range(45)]


def test_velocity_divides_whole_units(spark):
    rows = [("s", "a", day(d), 7 if d == 1 else 1, False) for d in range(1, 6)]
    rows += [("s", "b", day(d), 9, False) for d in range(1, 5)]
    only = reports.sku_velocity(fact(spark, *rows), AS_OF).collect()
    assert [(r.sku_id, r.avg_daily_units, r.velocity_quartile) for r in only] == [("a", 2.0, 1)]


def test_asp_ignores_products_without_units(spark):
    rows = fact(spark, ("s", "a", day(1), 2, False, "5.00"), ("s", "b", day(1), 0, False, "0"),
                ("s", "c", day(1), 4, False, "4.00"))
    row = reports.asp_analysis(rows, AS_OF).first()
    assert (row.avg_asp, row.median_asp, row.min_asp, row.max_asp, row.sku_count) \
        == (1.75, 1.75, Decimal("1.00"), Decimal("2.50"), 3)


def test_growth_from_nothing(spark):
    rows = fact(spark, ("s", "a", day(1, 12, 1998), 0, False), ("s", "a", day(1), 5, False),
                ("s", "a", day(1, 2), 10, False))
    got = [(r.month, r.mom_growth_pct) for r in reports.sales_growth_mom(rows, AS_OF).collect()]
    assert got == [(day(1, 2), 100.0), (day(1), None)]


def test_problem_store_boundaries(spark):
    # 7 of an average of 10 products is not thin; a fifth of days out of stock is not often.
    rows = [("big", f"k{i}", day(1), 10, False) for i in range(13)]
    rows += [("edge", f"k{i}", day(1), 20, False) for i in range(7)]
    rows += [("out", f"k{i}", day(1 + i % 5), 10, False, None, int(i > 0)) for i in range(10)]
    rows += [("bad", f"k{i}", day(1 + i % 5), 10, False, None, int(i > 1)) for i in range(10)]
    f = fact(spark, *rows)
    store = dims(spark, ["big", "edge", "out", "bad"], [])["dim_store"]
    got = {r.store_id: (r.performance_issue, r.oos_pct)
           for r in reports.problem_stores(f, store, AS_OF).collect()}
    assert got == {"bad": ("High OOS Rate", 40.0)}


def test_promo_gap_threshold_is_unrounded(spark):
    rows = fact(spark, ("s", "a", day(4), 119_999, True), ("s", "a", day(5), 100_000, False),
                ("s", "b", day(4), 120_000, True), ("s", "b", day(5), 100_000, False),
                ("s", "c", day(4), 1, True), ("s", "c", day(5), 0, False))
    d = dims(spark, ["s"], ["a", "b", "c"])
    got = reports.promo_gaps(rows, d["dim_sku"], d["dim_store"], AS_OF).collect()
    assert [(r.sku_id, r.uplift_pct) for r in got] == [("a", 20.0)]


def test_issue_reports_and_summary(spark):
    rows = fact(spark, ("s", "a", day(20, 2), 0, False, None, 0), ("s", "a", day(1, 2), 0, False, None, 9),
                ("s", "b", day(19, 2), 0, False, None, 0))
    d = dims(spark, ["s"], ["a", "b"])
    tables = {"fact_sales": rows, **d}
    out = reports.stockouts(rows, d["dim_sku"], d["dim_store"]).collect()
    assert [(r.sku_id, r.date) for r in out] == [("a", day(20, 2))]
    dead = reports.dead_stock(rows, d["dim_sku"], d["dim_store"], AS_OF).collect()
    assert [(r.sku_id, r.stock_level) for r in dead] == [("a", 9)]
    every = reports.all_reports(tables, AS_OF)
    assert [tuple(r) for r in every["issue_summary"].collect()] == [
        ("Stockouts", 1), ("Dead Stock", 1), ("Promo Gaps", 0)]
    assert len(every) == 11


def test_week_across_new_year(spark):
    rows = fact(spark, ("s", "a", day(31, 12, 1998), 1, False, None, 1, "2.00"),
                ("s", "a", day(2), 1, False, None, 1, "3.00"))
    tables = {"fact_sales": rows, **dims(spark, ["s"], ["a"])}
    got = view_frame(spark, "pricing_trends_view", tables).orderBy("year").collect()
    assert [(r.year, r.week_number, r.prev_week_price, r.price_change_pct) for r in got] \
        == [(1998, 53, None, None), (1999, 53, 2.0, 50.0)]
    assert len({r.week_start_date for r in got}) == 1


def test_promo_periods(spark):
    rows = [("s", "a", day(d), 10, False) for d in range(1, 8)]
    rows += [("s", "a", day(d), 20, True) for d in (8, 9, 14)]
    rows += [("s", "a", day(d), 30, False) for d in (15, 21, 22)]
    rows += [("s", "b", day(8), 0, True)]
    tables = {"fact_sales": fact(spark, *rows), **dims(spark, ["s"], ["a", "b"])}
    got = {r.promo_start_date: r for r in
           view_frame(spark, "promo_analysis_view", tables).collect()}
    assert set(got) == {day(8), day(14)}   # day 9 follows day 8; product b sold nothing
    first, last = got[day(8)], got[day(14)]
    assert first.promo_end_date == day(8) and last.promo_end_date == day(22)
    assert (first.avg_daily_units_pre_promo, first.avg_daily_units_during_promo,
            first.avg_daily_units_post_promo) == (10.0, 60 / 7, 60 / 7)   # days 15 and 21 are 7 and 13 days on
    assert (last.avg_daily_units_pre_promo, last.avg_daily_units_post_promo) == (10 / 7, 60 / 7)
    assert (first.units_uplift_pct, last.units_uplift_pct) == (-14.29, 100.0)


def test_summary_view_edges(spark, star):
    rows = conform(fact(spark, ("s", "a", day(4), 0, False, "0")), FACT_SALES)
    tables = {"fact_sales": rows, **dims(spark, ["s"], ["a"]),
              "dim_retailer": spark.createDataFrame([("r", "R")],
                                                    "retailer_id string, retailer_name string"),
              "dim_time": star.read("dim_time")}
    tables["dim_store"] = tables["dim_store"].withColumn("store_name", F.lit(""))
    row = view_frame(spark, "sales_summary_view", tables).first()
    assert (row.store_name, row.avg_selling_price, row.gross_margin_pct) == ("s", None, 0)


@pytest.mark.parametrize("size", [0, 1, 3, 4, 10, 333])
def test_ntile_is_exact(spark, size):
    rng = random.Random(size)
    values = [(rng.randint(0, 5), f"k{i:04d}") for i in range(size)]
    df = spark.createDataFrame(values, "v int, k string").repartition(5)
    got = {r.k: r.tile for r in ntile(df, ["v", "k"], 4, "tile").collect()}
    expected, start = {}, 0
    ordered = sorted(values)
    for tile in range(4):
        rows = size // 4 + (tile < size % 4)
        expected |= {k: tile + 1 for _, k in ordered[start:start + rows]}
        start += rows
    assert got == expected


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_percentile_is_exact(spark, share):
    rng = random.Random(7)
    rows = [(g, rng.randint(0, 40) if g != "hot" else rng.choice([3, 3, 3, 8]))
            for g in ["a"] * 100 + ["hot"] * 201 + ["one"]] + [("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(6)
    got = {r.g: r.p for r in percentile(value_counts(df, ["g"], "v"), ["g"], "v", share, "p")
           .collect()}
    for group in ("a", "hot", "one"):
        values = sorted(v for g, v in rows if g == group and v is not None)
        at = share * (len(values) - 1)
        low = int(at)
        high = min(low + 1, len(values) - 1)
        assert got[group] == pytest.approx(values[low] + (values[high] - values[low]) * (at - low))
    assert got["hot"] if share != 0.5 else got["hot"] == statistics.median(
        v for g, v in rows if g == "hot")
    assert "none" not in got


# Plans

def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


def every_plan(spark, star):
    tables = star.star()
    plans = {n: formatted(d) for n, d in reports.all_reports(tables, AS_OF).items()}
    return plans | {n: formatted(view_frame(spark, n, tables)) for n in VIEW_SQL}


def test_no_plan_multiplies_rows_or_leaves_the_jvm(spark, star):
    for name, plan in every_plan(spark, star).items():
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
            assert word not in plan, (name, word)


def test_reports_prune_partitions_and_columns(spark, star):
    plan = formatted(reports.sales_growth_mom(star.read("fact_sales"), AS_OF))
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "ReadSchema: struct<sales_value:decimal(12,2)>" in plan


def test_promo_view_shuffles_the_fact_once(spark, star):
    tables = star.star()
    body = VIEW_SQL["promo_analysis_view"].rsplit("ORDER BY", 1)[0]
    plan = formatted(spark.sql(body, **{t: tables[t] for t in
                                        ("fact_sales", "dim_sku", "dim_store")}))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 1


def test_ranks_never_gather_rows_in_one_task(spark, star):
    ranked = ntile(star.read("dim_sku").select("sku_id"), ["sku_id"], 4, "tile")
    plan = formatted(ranked)
    # The one single-partition window adds up slice sizes, not rows.
    single = plan.count("Exchange SinglePartition")
    assert single == 1 and "HashAggregate(keys=[_slice" in plan
