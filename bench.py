"""Times the reports, the views and the load; prints one JSON line.

The star schema is derived at part grain and saved once, partitioned by day, as it would
stand in production; the reports and views then read the saved tables. Every timing takes
the whole result (no-op sink). Reports are warmed up once and the median of three counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tillflow.operators.facts import latest_per_key
from tillflow.operators.transform import accepted, transform_sales
from tillflow.operators.validate import validation_stats
from tillflow.plans import reports
from tillflow.plans.load import load_sales
from tillflow.plans.views import VIEW_SQL, view_frame
from tillflow.schemas import TABLES, conform
from tillflow.session import build_session, scratch_path
from tillflow.sources import order_lines as lines
from tillflow.sources.sales_files import read_sales_csv
from tillflow.sources.tables import SavedTables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("tillflow-bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    tables = SavedTables(spark, scratch_path(spark, "bench-star"))
    tables.create()
    star = lines.star_tables(spark, SF_DIR, "part")

    def build() -> None:
        tables.write_days(star.fact_sales)
        for name in ("dim_store", "dim_retailer", "dim_sku"):
            tables.replace(name, conform(getattr(star, name), TABLES[name]))
        tables.replace("dim_time", lines.dim_time(tables.read("fact_sales")))

    seconds["build_star"] = timed(build)

    saved = tables.star_with_totals()
    fact, sku, store = saved["fact_sales"], saved["dim_sku"], saved["dim_store"]
    days, day_stores = saved["fact_days"], saved["fact_day_stores"]
    as_of = lines.AS_OF
    queries = {
        "kpi_sales_summary": lambda: reports.sales_summary_of_days(days, as_of),
        "kpi_sales_growth_mom": lambda: reports.sales_growth_mom(days, as_of),
        "kpi_asp_analysis": lambda: reports.asp_analysis(fact, as_of),
        "kpi_numeric_distribution": lambda: reports.numeric_distribution_of_days(
            day_stores, as_of),
        "kpi_promo_uplift": lambda: reports.promo_uplift(fact, as_of),
        "kpi_sku_velocity": lambda: reports.sku_velocity(fact, as_of),
        "kpi_problem_stores": lambda: reports.problem_stores(fact, store, as_of),
        "flag_stockouts": lambda: reports.stockouts(fact, sku, store, days),
        "flag_dead_stock": lambda: reports.dead_stock(fact, sku, store, as_of),
        "flag_promo_gaps": lambda: reports.promo_gaps(fact, sku, store, as_of),
    }
    for view in VIEW_SQL:
        queries[view] = lambda view=view: view_frame(spark, view, saved)
    for name, query in queries.items():
        consume(query())
        seconds[name] = statistics.median(
            timed(lambda: consume(query())) for _ in range(REPEATS))

    folder = scratch_path(spark, "bench-csv")
    lines.raw_sales(spark, SF_DIR, "part").drop("feed_position").repartition(int(CPUS)).write.csv(
        folder, header=True)
    raw = read_sales_csv(spark, folder, "UTF-8")
    rows = raw.count()
    for name, query in {
        "clean_transform": lambda: transform_sales(raw, "7"),
        "validate": lambda: validation_stats(raw),
        "dedup_batch": lambda: latest_per_key(
            accepted(transform_sales(raw, "7", carry=["file_position"])), "file_position"),
    }.items():
        consume(query())
        seconds[name] = statistics.median(
            timed(lambda: consume(query())) for _ in range(REPEATS))
    seconds["load_into_saved_fact"] = timed(
        lambda: load_sales(tables, raw, "7", process_type="full"))

    headline = [name for name in queries]
    print(json.dumps({
        "metric": "reports and views, sum of medians",
        "value": round(sum(seconds[name] for name in headline), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "load_rows_per_sec": round(rows / seconds["load_into_saved_fact"]),
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
