"""Every query by name, over tables derived from a folder of order-line Parquet files."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillflow.functions.dates import ISO_DATE, parse_date
from tillflow.functions.numbers import clean_number
from tillflow.functions.text import pack_size, tidy_text
from tillflow.operators import dimensions, facts
from tillflow.operators.calendar import missing_days, wide_gaps
from tillflow.operators.freshness import freshness
from tillflow.operators.transform import accepted, column_values, transform_sales
from tillflow.operators.validate import missing_columns, standard_columns, validation_stats
from tillflow.plans import reports
from tillflow.plans.load import load_new_files, load_sales
from tillflow.plans.views import create_views, view_frame
from tillflow.schemas import DIM_SKU, DIM_STORE, RAGGED, REQUIRED_COLUMNS, conform, union_evolved
from tillflow.session import scratch_path
from tillflow.sources import order_lines as lines
from tillflow.sources.report_files import save_reports
from tillflow.sources.sales_files import map_master_columns, read_master_csv, read_sales_csv
from tillflow.sources.tables import SavedTables, describe_catalog
from tillflow.streaming.landing import land_sales

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = lines.AS_OF
LOADED_AT = dt.datetime(1999, 3, 1, 6, 0)
FRIDAY = dt.datetime(1999, 3, 5, 9, 0)
SINCE = dt.date(1999, 1, 31)
ORDER = "feed_position"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Reports and flags

def _report(build: Callable[[lines.StarTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(lines.star_tables(spark, sf_dir))


QUERIES |= {
    "kpi_sales_summary": _report(lambda t: reports.sales_summary(t.fact_sales, AS_OF)),
    "kpi_sales_growth_mom": _report(lambda t: reports.sales_growth_mom(t.fact_sales, AS_OF)),
    "kpi_asp_analysis": _report(lambda t: reports.asp_analysis(t.fact_sales, AS_OF)),
    "kpi_numeric_distribution": _report(
        lambda t: reports.numeric_distribution(t.fact_sales, AS_OF)),
    "kpi_promo_uplift": _report(lambda t: reports.promo_uplift(t.fact_sales, AS_OF)),
    "kpi_sku_velocity": _report(lambda t: reports.sku_velocity(t.fact_sales, AS_OF)),
    "kpi_problem_stores": _report(
        lambda t: reports.problem_stores(t.fact_sales, t.dim_store, AS_OF)),
    "flag_stockouts": _report(lambda t: reports.stockouts(t.fact_sales, t.dim_sku, t.dim_store)),
    "flag_dead_stock": _report(
        lambda t: reports.dead_stock(t.fact_sales, t.dim_sku, t.dim_store, AS_OF)),
    "flag_promo_gaps": _report(
        lambda t: reports.promo_gaps(t.fact_sales, t.dim_sku, t.dim_store, AS_OF)),
    "flag_issue_summary": _report(lambda t: reports.issue_summary(
        reports.stockouts(t.fact_sales, t.dim_sku, t.dim_store),
        reports.dead_stock(t.fact_sales, t.dim_sku, t.dim_store, AS_OF),
        reports.promo_gaps(t.fact_sales, t.dim_sku, t.dim_store, AS_OF))),
}


# At the grain of single parts: limits, ties and medians over thousands of products.
QUERIES |= {
    f"{name}_part": lambda spark, sf_dir, build=build: build(
        lines.star_tables(spark, sf_dir, "part").fact_sales, AS_OF)
    for name, build in (("kpi_asp_analysis", reports.asp_analysis),
                        ("kpi_promo_uplift", reports.promo_uplift),
                        ("kpi_sku_velocity", reports.sku_velocity))
}


def _view(name: str) -> Query:
    return lambda spark, sf_dir: view_frame(
        spark, name, lines.star_tables(spark, sf_dir).as_dict())


QUERIES |= {
    "view_sales_summary": _view("sales_summary_view"),
    "view_sku_store_matrix": _view("sku_store_matrix_view"),
    "view_pricing_trends": _view("pricing_trends_view"),
    "view_promo_analysis": _view("promo_analysis_view"),
}


@query
def saved_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view read by name from a catalog in which a saved star was declared."""
    tables, star = SavedTables(spark, scratch_path(spark, "star")), lines.star_tables(spark, sf_dir)
    tables.create()
    tables.write_days(star.fact_sales)
    for name in ("dim_store", "dim_sku", "dim_retailer", "dim_time"):
        tables.replace(name, getattr(star, name))
    database = f"retail_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    tables.register(database)
    create_views(spark, database)
    return spark.table(f"{database}.sales_summary_view")


# Raw sales: reading, cleaning, validating

@query
def sales_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed written as CSV files and read back."""
    folder = scratch_path(spark, "sales-csv")
    lines.raw_sales(spark, sf_dir).drop(ORDER).write.csv(
        folder, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read_sales_csv(spark, folder).drop("file_position")


def _text_rows(spark: SparkSession, sf_dir: str, name: Column) -> DataFrame:
    return lines.sale_lines(spark, sf_dir).select(
        F.col("store_id").alias("STORE_NAME"), F.col("sku_id").alias("ITEM_CODE"),
        name.alias("ITEM_NAME"), F.col("line_number"),
        F.floor(F.col("order_number") / 20000).alias("file"))


@query
def sales_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written as plain text: doubled quotes, backslashes and commas in quoted fields."""
    folder = scratch_path(spark, "sales-quoted")
    kind, item = F.col("line_number") % 4, F.col("item_name")
    rows = _text_rows(spark, sf_dir, F.when(kind == 0, F.concat(item, F.lit(' 12" pan')))
                      .when(kind == 1, F.concat(item, F.lit(" C:\\")))
                      .when(kind == 2, F.concat(item, F.lit(', "large"'))).otherwise(item))
    _write_text(rows, "STORE_NAME,ITEM_CODE,ITEM_NAME", folder)
    return read_sales_csv(spark, folder, recursiveFileLookup=True).drop("file_position")


def _write_text(rows: DataFrame, heading: str, folder: str) -> None:
    """Quoted lines under a heading, written as plain text, one folder for each ``file``."""
    fields = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
              for c in ("STORE_NAME", "ITEM_CODE", "ITEM_NAME")]
    heads = rows.select("file").distinct().select(
        "file", F.lit(0).alias("place"), F.lit(heading).alias("line"))
    body = rows.select("file", F.lit(1).alias("place"), F.concat_ws(",", *fields).alias("line"))
    heads.unionByName(body).repartition(8, "file").sortWithinPartitions("file", "place").select(
        "file", "line").write.partitionBy("file").text(folder)


@query
def sales_csv_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings with a byte-order mark and blanks around them, and one that occurs twice."""
    folder = scratch_path(spark, "sales-headings")
    _write_text(_text_rows(spark, sf_dir, F.col("item_name")),
                "\ufeffSTORE_NAME , ITEM_CODE,\tITEM_CODE ", folder)
    return read_sales_csv(spark, folder, recursiveFileLookup=True).drop("file_position")


@query
def sales_csv_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latin-1 files beside UTF-8 files that hold a replacement character."""
    folder = scratch_path(spark, "sales-latin1")
    odd = F.col("line_number") % 2 == 1
    rows = _text_rows(spark, sf_dir, F.concat("item_name", F.when(odd, " Café").otherwise(
        " Caf\ufffd é")))
    for encoding, part in (("ISO-8859-1", rows.where(odd)), ("UTF-8", rows.where(~odd))):
        part.drop("line_number", "file").write.csv(f"{folder}/{encoding}", header=True,
                                                   encoding=encoding)
    return read_sales_csv(spark, [f"{folder}/ISO-8859-1", f"{folder}/UTF-8"]).drop(
        "file_position")


@query
def clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lines.raw_sales(spark, sf_dir)
    return raw.select(
        F.col("QTY").alias("qty_text"),
        clean_number(F.col("QTY")).alias("qty"),
        clean_number(F.col("QTY"), keep_sign=True).alias("signed_qty"),
        clean_number(F.col("SALES_PRE_VAT"), data_type="decimal(12,2)").alias("sales"),
        clean_number(F.col("SALES_PRE_VAT"), True, "decimal(12,2)").alias("signed_sales"),
        clean_number(F.col("RRP"), data_type="decimal(10,2)").alias("rrp"),
    )


@query
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lines.raw_sales(spark, sf_dir)
    return raw.select(
        F.col("Date").alias("date_text"),
        parse_date(F.col("Date"), (ISO_DATE,)).alias("iso_date"),
        parse_date(F.col("Date")).alias("any_date"),
    )


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lines.raw_sales(spark, sf_dir)
    return raw.select("ITEM_NAME", tidy_text(F.col("ITEM_NAME")).alias("tidy_name"))


@query
def extract_pack_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lines.raw_sales(spark, sf_dir)
    return raw.select("ITEM_NAME", pack_size(F.col("ITEM_NAME")).alias("pack_size"))


@query
def validate_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation_stats(lines.raw_sales(spark, sf_dir).drop(ORDER))


@query
def transform_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_sales(lines.raw_sales(spark, sf_dir), "7")


@query
def transform_fact_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_sales(lines.raw_sales(spark, sf_dir), "7", keep_sign=True, stock_default=5)


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows of the raw feed, with their order."""
    return accepted(transform_sales(lines.raw_sales(spark, sf_dir), "7", carry=[ORDER]))


def _staged_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch written once, for steps that read it more than once."""
    staged = scratch_path(spark, "batch")
    _batch(spark, sf_dir).write.parquet(staged)
    return spark.read.parquet(staged)


# Dimensions

@query
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.star_tables(spark, sf_dir).dim_time


@query
def dim_retailer_ensure(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    wanted = dimensions.retailers_of(
        suppliers.select(F.col("s_nationkey").cast("string").alias("retailer_id")))
    return dimensions.add_retailers(lines.dim_retailer(spark, sf_dir), wanted).drop("created_at")


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("date") for c in ("created_at", "updated_at")})


@query
def dim_sku_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = map_master_columns(lines.raw_master(spark, sf_dir))
    return _stamped(dimensions.merge_skus_from_master(
        lines.dim_sku(spark, sf_dir), master, "sheet_row", LOADED_AT))


@query
def dim_sku_from_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(dimensions.merge_skus_from_sales(
        lines.dim_sku(spark, sf_dir), _staged_batch(spark, sf_dir), ORDER, LOADED_AT))


@query
def dim_store_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(dimensions.merge_stores_from_sales(
        lines.dim_store(spark, sf_dir), _batch(spark, sf_dir), LOADED_AT))


@query
def dim_store_from_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = map_master_columns(lines.store_sheet(spark, sf_dir)).where("store_id <> ''")
    return _stamped(dimensions.merge_stores_from_master(
        lines.dim_store(spark, sf_dir), sheet, "sheet_row", LOADED_AT))


@query
def dim_store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged, _ = dimensions.upsert_dimension(
        lines.dim_store(spark, sf_dir), lines.store_sheet(spark, sf_dir), DIM_STORE, "store_id",
        ["store_name", "region", "store_type"], "sheet_row", LOADED_AT)
    return _stamped(merged)


@query
def dim_store_upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.upsert_dimension(
        lines.dim_store(spark, sf_dir), lines.store_sheet(spark, sf_dir), DIM_STORE, "store_id",
        ["store_name", "region", "store_type"], "sheet_row", LOADED_AT)[1]


@query
def dim_sku_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.replace_skus(map_master_columns(lines.raw_master(spark, sf_dir)), "sheet_row")


@query
def dim_sku_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = map_master_columns(lines.raw_master(spark, sf_dir))
    return dimensions.enrich_skus(lines.dim_sku(spark, sf_dir), master, "sheet_row")


# Loading the fact

@query
def fk_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.known_references(
        _staged_batch(spark, sf_dir).drop(ORDER), lines.dim_sku(spark, sf_dir),
        lines.dim_store(spark, sf_dir))


@query
def fk_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.split_references(
        _staged_batch(spark, sf_dir).drop(ORDER), lines.dim_sku(spark, sf_dir),
        lines.dim_store(spark, sf_dir))[1]


@query
def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.newer_than(_batch(spark, sf_dir).drop(ORDER), SINCE)


@query
def watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.watermark_row(_batch(spark, sf_dir)).select("key", "value")


@query
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.load_summary(_batch(spark, sf_dir))


@query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old layout without stock and cost, widened and joined by a newer one."""
    fact = lines.fact_sales(spark, sf_dir)
    older = fact.drop("stock_level", "cost")
    newer = fact.withColumn("channel", F.lit("store"))
    return union_evolved(conform(older, lines.FACT_LAYOUT), newer)


@query
def upsert_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved fact after the raw feed was merged into it."""
    tables = SavedTables(spark, scratch_path(spark, "upsert"))
    tables.create()
    tables.write_days(lines.fact_sales(spark, sf_dir))
    staged = scratch_path(spark, "batch")
    _batch(spark, sf_dir).withColumn("retailer_id", F.lit("1")).write.parquet(staged)
    tables.upsert_fact(spark.read.parquet(staged), ORDER, LOADED_AT.date())
    return tables.read("fact_sales")


@query
def evolved_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved fact with one more column, after a batch without it and a batch with it."""
    tables = SavedTables(spark, scratch_path(spark, "evolved"))
    tables.create()
    fact = lines.fact_sales(spark, sf_dir)
    tables.write_days(fact.withColumn("channel", F.lit("store")))
    more = fact.withColumns({"seq": F.lit(1), "units_sold": F.col("units_sold") + 1})
    for batch in (more.where("promo_active"),
                  more.where("not promo_active and stock_level = 0").withColumn(
                      "channel", F.lit("web"))):
        staged = scratch_path(spark, "batch")
        batch.write.parquet(staged)
        tables.upsert_fact(spark.read.parquet(staged), "seq", LOADED_AT.date())
    return tables.read("fact_sales").drop("created_at")


def _prepared(spark: SparkSession, sf_dir: str):
    tables = SavedTables(spark, scratch_path(spark, "load"))
    tables.create()
    tables.replace("dim_sku", conform(lines.dim_sku(spark, sf_dir), DIM_SKU))
    tables.replace("dim_store", conform(lines.dim_store(spark, sf_dir), DIM_STORE))
    return tables, lines.raw_sales(spark, sf_dir)


def _load(spark: SparkSession, sf_dir: str):
    tables, raw = _prepared(spark, sf_dir)
    return tables, load_sales(tables, raw, "7", order=ORDER, loaded_at=LOADED_AT,
                              add_unknown=False)


@query
def batch_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after a whole load: transform, filter, upsert."""
    tables, _ = _load(spark, sf_dir)
    return tables.read("fact_sales")


@query
def batch_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the load kept back, with their reason."""
    _, result = _load(spark, sf_dir)
    return result.rejects.drop(ORDER, "raw_row")


@query
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incremental load above a stored watermark: every row is loaded, kept back or skipped."""
    tables, raw = _prepared(spark, sf_dir)
    tables.set_watermark(facts.watermark_row(
        _batch(spark, sf_dir).where(F.col("date") <= F.lit(SINCE))))
    result = load_sales(tables, raw, "7", order=ORDER, loaded_at=LOADED_AT, add_unknown=False,
                        process_type="incremental")
    return spark.createDataFrame([(result.loaded, result.rejected, result.skipped)],
                                 "loaded long, rejected long, skipped long")


@query
def loaded_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and names of all dimensions after a load with a master sheet read from a file."""
    tables, raw = _prepared(spark, sf_dir)
    folder = scratch_path(spark, "master")
    lines.raw_master(spark, sf_dir).write.csv(folder, header=True)
    master = read_master_csv(spark, folder).withColumn(ORDER, F.col("sheet_row").cast("int"))
    load_sales(tables, raw, "7", master=master, order=ORDER, loaded_at=LOADED_AT,
               name_products=False)
    names = {"dim_retailer": ("retailer_id", "retailer_name"), "dim_sku": ("sku_id", "sku_name"),
             "dim_store": ("store_id", "store_name"), "dim_time": ("date", "day_name")}
    parts = [tables.read(table).select(F.lit(table).alias("table_name"),
                                       F.col(key).cast("string").alias("key"),
                                       F.col(label).alias("label"))
             for table, (key, label) in names.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored watermark after a batch and then an older one."""
    tables = SavedTables(spark, scratch_path(spark, "state"))
    tables.create()
    batch = _batch(spark, sf_dir)
    for part in (batch, batch.where(F.col("date") <= F.lit(SINCE))):
        tables.set_watermark(facts.watermark_row(part, LOADED_AT))
    return tables.read("etl_metadata").select("key", "value")


@query
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two file drops, landed by two runs of the stream; the second corrects the first."""
    root = scratch_path(spark, "stream")
    tables = SavedTables(spark, f"{root}/tables")
    tables.create()
    fact = lines.fact_sales(spark, sf_dir)
    later = fact.withColumns({"date": F.date_add("date", 1), "units_sold": F.col("units_sold") + 1})
    for drop in (fact, later):
        lines.as_sales_file(drop).write.mode("append").csv(f"{root}/landing", header=True)
        land_sales(tables, f"{root}/landing", f"{root}/progress",
                   loaded_at=LOADED_AT).awaitTermination()
    return tables.read("fact_sales")


@query
def stream_landing_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Latin-1 file drop with accented store names, landed by the stream."""
    root = scratch_path(spark, "stream")
    tables = SavedTables(spark, f"{root}/tables")
    tables.create()
    sheet = lines.as_sales_file(lines.fact_sales(spark, sf_dir))
    sheet.withColumn("STORE_NAME", F.concat(F.lit("Café "), "STORE_NAME")).write.csv(
        f"{root}/landing", header=True, encoding="ISO-8859-1")
    land_sales(tables, f"{root}/landing", f"{root}/progress",
               loaded_at=LOADED_AT).awaitTermination()
    return tables.read("fact_sales")


@query
def check_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness(lines.fact_sales(spark, sf_dir), FRIDAY)


@query
def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every report, all saved in one go over a saved star."""
    tables = SavedTables(spark, scratch_path(spark, "star"))
    tables.create()
    star = lines.star_tables(spark, sf_dir)
    tables.write_days(star.fact_sales)
    tables.replace("dim_sku", star.dim_sku)
    tables.replace("dim_store", star.dim_store)
    counts = save_reports(reports.all_reports(tables.star_with_totals(), AS_OF),
                          scratch_path(spark, "reports"))
    return spark.createDataFrame(list(counts.items()), "report string, rows long")


@query
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report saved as CSV and read back."""
    folder = scratch_path(spark, "reports")
    report = reports.sales_summary(lines.fact_sales(spark, sf_dir), AS_OF)
    save_reports({"sales_summary": report}, folder)
    return spark.read.schema(report.schema).csv(f"{folder}/sales_summary", header=True)


# Day totals and bitmaps

def _saved_fact(spark: SparkSession, sf_dir: str, grain: str = "brand") -> SavedTables:
    """A saved fact written in two goes, the second over days of the first."""
    tables = SavedTables(spark, scratch_path(spark, "days"))
    tables.create()
    fact = lines.fact_sales(spark, sf_dir, grain)
    early = fact.where(F.col("date") <= F.lit(SINCE))
    tables.write_days(early)
    staged = scratch_path(spark, "batch")
    fact.where(F.col("date") >= F.lit(SINCE)).withColumn("seq", F.lit(1)).write.parquet(staged)
    tables.upsert_fact(spark.read.parquet(staged), "seq", LOADED_AT.date())
    return tables


@query
def day_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day totals that the upserts have kept."""
    return _saved_fact(spark, sf_dir).read("fact_days")


QUERIES |= {
    "kpi_sales_summary_days": lambda spark, sf_dir: reports.sales_summary_of_days(
        _saved_fact(spark, sf_dir).read("fact_days"), AS_OF),
    "kpi_sales_growth_mom_days": lambda spark, sf_dir: reports.sales_growth_mom(
        _saved_fact(spark, sf_dir).read("fact_days"), AS_OF),
    "kpi_numeric_distribution_days": lambda spark, sf_dir: reports.numeric_distribution_of_days(
        _saved_fact(spark, sf_dir).read("fact_day_stores"), AS_OF),
    "kpi_numeric_distribution_days_part": lambda spark, sf_dir:
        reports.numeric_distribution_of_days(
            _saved_fact(spark, sf_dir, "part").read("fact_day_stores"), AS_OF),
}


@query
def flag_stockouts_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock-outs of the latest day, which the day totals tell: the saved fact is read once."""
    tables = _saved_fact(spark, sf_dir)
    return reports.stockouts(tables.read("fact_sales"), lines.dim_sku(spark, sf_dir),
                             lines.dim_store(spark, sf_dir), tables.read("fact_days"))


# Versions, evolution and state

@query
def evolved_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products after a column was added, filled and widened, through two more merges."""
    tables = SavedTables(spark, scratch_path(spark, "dims"))
    tables.create()
    tables.replace("dim_sku", conform(lines.dim_sku(spark, sf_dir), DIM_SKU))
    tables.add_columns("dim_sku", "shelf int")
    master = map_master_columns(lines.raw_master(spark, sf_dir)).withColumn(
        "shelf", F.col("sheet_row").cast("int"))
    tables.replace("dim_sku", dimensions.merge_skus_from_master(
        tables.read("dim_sku"), master, "sheet_row", LOADED_AT))
    late = master.where(F.col("sheet_row") % 2 == 0).withColumn(
        "shelf", F.col("sheet_row").cast("long") * 10_000_000_000)
    tables.replace("dim_sku", dimensions.merge_skus_from_master(
        tables.read("dim_sku"), late, "sheet_row", LOADED_AT))
    tables.replace("dim_sku", dimensions.merge_skus_from_sales(
        tables.read("dim_sku"), _staged_batch(spark, sf_dir), ORDER, LOADED_AT))
    return tables.read("dim_sku").select("sku_id", "sku_name", "shelf")


@query
def watermark_withdrawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark after two batches, the later of which is withdrawn."""
    tables = SavedTables(spark, scratch_path(spark, "state"))
    tables.create()
    batch = _batch(spark, sf_dir)
    for part in (batch.where(F.col("date") <= F.lit(SINCE)), batch):
        tables.set_watermark(facts.watermark_row(part, LOADED_AT))
    tables.withdraw_watermark()
    return tables.read("etl_metadata").select("key", "value")


@query
def catalog_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and columns of a database in which a saved star was declared."""
    tables, star = SavedTables(spark, scratch_path(spark, "star")), lines.star_tables(spark, sf_dir)
    tables.create()
    for name in ("dim_store", "dim_sku", "dim_retailer", "dim_time"):
        tables.replace(name, getattr(star, name))
    database = f"retail_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    tables.register(database)
    listed = describe_catalog(spark, database)
    return listed.where(F.col("table_name").isin("dim_retailer", "dim_time")).select(
        "table_name", "ordinal", "column_name", "data_type")


# Checks of a raw feed

@query
def load_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that a load takes in the pass that stages its batch."""
    tables, raw = _prepared(spark, sf_dir)
    return load_sales(tables, raw, "7", order=ORDER, loaded_at=LOADED_AT).validation


@query
def loaded_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that a load found in its file, with what the file says of them."""
    tables = SavedTables(spark, scratch_path(spark, "load"))
    tables.create()
    load_sales(tables, lines.raw_sales(spark, sf_dir), "7", order=ORDER, loaded_at=LOADED_AT)
    return tables.read("dim_sku").select("sku_id", "sku_name", "category", "pack_size", "brand")


@query
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which required columns a feed without its quantities has."""
    raw = standard_columns(lines.raw_sales(spark, sf_dir)).drop("QTY")
    absent = missing_columns(raw)
    return raw.agg(F.count(F.lit(1)).alias("rows")).select(
        F.explode(F.array(*map(F.lit, REQUIRED_COLUMNS))).alias("column_name"), "rows").select(
        "column_name", F.col("column_name").isin(absent).alias("missing"), "rows")


@query
def column_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a value, by column of the transformed feed: what the all-null guard looks at."""
    return column_values(transform_sales(lines.raw_sales(spark, sf_dir), "7"))


@query
def calendar_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar rows of a feed in which one line in a thousand is dated far ahead."""
    feed = lines.sale_lines(spark, sf_dir).select(F.when(
        F.col("order_number") % 1000 == 0, F.lit(dt.date(9999, 1, 1))).otherwise(
        F.col("date")).alias("date"))
    none = lines.dim_time(feed).limit(0)
    wide = wide_gaps(feed).select(F.col("before").alias("date"), F.lit(True).alias("far"))
    return missing_days(feed, none).join(wide, "date", "left").select(
        "date", "day_name", F.coalesce("far", F.lit(False)).alias("far"))


def _ragged_file(spark: SparkSession, sf_dir: str) -> str:
    """Sales files in which some lines have a field too many or too few."""
    folder = scratch_path(spark, "sales-ragged")
    sheet = lines.as_sales_file(lines.fact_sales(spark, sf_dir)).select(
        "STORE_NAME", "ITEM_CODE", "QTY", "SALES_PRE_VAT", "Date")
    line = F.concat_ws(",", "STORE_NAME", "ITEM_CODE", "QTY", "SALES_PRE_VAT", "Date")
    kind = F.dayofmonth(F.col("Date").cast("date"))
    rows = sheet.select(
        F.month(F.col("Date").cast("date")).alias("file"), F.lit(1).alias("place"),
        F.when(kind == 3, F.concat(line, F.lit(",x"))).when(
            kind == 5, F.concat_ws(",", "STORE_NAME", "ITEM_CODE", "QTY")).otherwise(
            line).alias("line"))
    heads = rows.select("file").distinct().select(
        "file", F.lit(0).alias("place"),
        F.lit("STORE_NAME,ITEM_CODE,QTY,SALES_PRE_VAT,Date").alias("line"))
    heads.unionByName(rows).repartition(8, "file").sortWithinPartitions("file", "place").select(
        "file", "line").write.partitionBy("file").text(folder)
    return folder


@query
def sales_csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a field too many or too few, with their whole text."""
    return read_sales_csv(spark, _ragged_file(spark, sf_dir), ragged=RAGGED,
                          recursiveFileLookup=True).drop("file_position")


@query
def load_ragged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of ragged files is loaded or kept back with its text."""
    tables = SavedTables(spark, scratch_path(spark, "load"))
    tables.create()
    raw = read_sales_csv(spark, _ragged_file(spark, sf_dir), ragged=RAGGED,
                         recursiveFileLookup=True)
    result = load_sales(tables, raw, "7", loaded_at=LOADED_AT)
    kept = result.rejects.agg(F.count_if(F.col("reject_reason") == "ragged_row").alias("ragged"),
                              F.max(F.length("raw_row")).alias("longest"))
    return kept.select(F.lit(result.loaded).cast("long").alias("loaded"),
                       F.lit(result.rejected).cast("long").alias("rejected"), "ragged", "longest")


@query
def discovered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a folder: the second takes only what came after the first."""
    root = scratch_path(spark, "folder")
    tables = SavedTables(spark, f"{root}/tables")
    tables.create()
    sheet = lines.as_sales_file(lines.fact_sales(spark, sf_dir))
    day = F.col("Date").cast("date")
    runs = []
    for number, part in enumerate((day <= F.lit(SINCE), day > F.lit(SINCE), None)):
        if part is not None:
            sheet.where(part).write.mode("append").csv(f"{root}/files", header=True)
        result = load_new_files(tables, f"{root}/files", loaded_at=LOADED_AT)
        runs.append((number, result.loaded if result else 0))
    return spark.createDataFrame(runs, "run int, loaded long")
