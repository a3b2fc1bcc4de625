"""The star schema and a raw sales feed, derived from order-line tables.

Stores are nations, retailers are regions, products are brands or parts, and ship
dates are folded onto 119 trading days that cross a New Year week.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillflow.operators.calendar import calendar_between
from tillflow.schemas import FACT_SALES

FIRST_DAY = dt.date(1998, 11, 2)
TRADING_DAYS = 119
AS_OF = dt.date(1999, 2, 28)
GRAINS = ("brand", "part")
# The fact's columns as derived here, without the load date.
FACT_LAYOUT = T.StructType([f for f in FACT_SALES.fields if f.name != "created_at"])


@dataclass(frozen=True)
class StarTables:
    fact_sales: DataFrame
    dim_sku: DataFrame
    dim_store: DataFrame
    dim_retailer: DataFrame
    dim_time: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _brand_number(brand: Column) -> Column:
    return F.regexp_extract(brand, r"(\d+)", 1).cast("int")


def _sku_columns(grain: str) -> tuple[Column, Column]:
    if grain == "brand":
        return F.col("p_brand"), _brand_number(F.col("p_brand"))
    if grain == "part":
        return F.concat(F.lit("P"), F.col("p_partkey")), (F.col("p_partkey") % 25).cast("int")
    raise ValueError(f"grain must be one of {GRAINS}")


def sale_lines(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    """One row per order line with its store, product, day and typed measures."""
    sku_id, number = _sku_columns(grain)
    # What a product or a store tells is worked out once for each, not for each line.
    list_price = F.col("p_retailprice").cast("decimal(10,2)")
    products = _table(spark, sf_dir, "part").select(
        "p_partkey", sku_id.alias("sku_id"), number.alias("sku_number"),
        list_price.alias("list_price"), list_price.cast("string").alias("list_price_text"),
        F.col("p_name").alias("item_name"), F.col("p_type").alias("item_type"))
    stores = _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("store_number"),
        F.col("n_regionkey").cast("string").alias("retailer_id"),
        F.col("n_nationkey").cast("string").alias("store_id"))
    joined = (
        _table(spark, sf_dir, "lineitem")
        .join(products, F.col("l_partkey") == F.col("p_partkey"))
        .join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(stores, F.col("s_nationkey") == F.col("store_number"))
    )
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit(dt.date(1995, 1, 1))) % TRADING_DAYS
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    return joined.select(
        "retailer_id", "store_id", "sku_id",
        F.date_add(F.lit(FIRST_DAY), day).alias("date"),
        "store_number", "sku_number",
        day.alias("day_number"),
        F.col("l_orderkey").alias("order_number"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (price * (1 - discount)).cast("decimal(12,2)").alias("value"),
        "list_price", "list_price_text", "item_name", "item_type",
    )


def fact_sales(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    """The daily fact: one row per retailer, store, product and day."""
    lines = sale_lines(spark, sf_dir, grain).filter(
        ~((F.col("store_number") % 9 == 4) & (F.col("sku_number") > 12))
    )
    dead = (F.col("store_number") * 7 + F.col("sku_number")) % 41 == 0
    promo = (
        F.floor(F.col("day_number") / 7).cast("int") + F.col("sku_number") + F.col("store_number")
    ) % 5 == 0
    stock = (F.col("order_number") * 31 + F.col("line_number") * 17) % 12
    no_money = F.lit(0).cast("decimal(12,2)")
    return (
        lines.groupBy("retailer_id", "store_id", "sku_id", "date")
        .agg(
            F.sum(F.when(dead, 0).otherwise(F.col("quantity"))).cast("int").alias("units_sold"),
            F.sum(F.when(dead, no_money).otherwise(F.col("value")))
            .cast("decimal(12,2)").alias("sales_value"),
            F.min(stock).cast("int").alias("stock_level"),
            F.bool_or(promo).alias("promo_active"),
            F.max("list_price").alias("price"),
        )
        .withColumn(
            "cost", (F.col("price") * F.lit("0.7").cast("decimal(2,1)")).cast("decimal(10,2)")
        )
    )


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return (
        _table(spark, sf_dir, "nation")
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.cast("string").alias("store_id"),
            F.col("n_regionkey").cast("string").alias("retailer_id"),
            F.when(key % 7 == 3, "").otherwise(F.col("n_name")).alias("store_name"),
            F.col("r_name").alias("location"),
        )
    )


def dim_retailer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("retailer_id"),
        F.col("r_name").alias("retailer_name"),
    )


def dim_sku(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    """Products; at brand grain the attributes follow from the brand number."""
    part = _table(spark, sf_dir, "part")
    sku_id, _ = _sku_columns(grain)
    if grain == "part":
        return part.select(
            sku_id.alias("sku_id"), F.col("p_name").alias("sku_name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("department"),
            F.col("p_brand").alias("brand"),
        )
    number = _brand_number(F.col("sku_id"))
    return part.select(sku_id.alias("sku_id")).distinct().select(
        "sku_id",
        F.concat(F.lit("Product "), number).alias("sku_name"),
        F.concat(F.lit("Category "), number % 5).alias("category"),
        F.concat(F.lit("Department "), number % 3).alias("department"),
        F.col("sku_id").alias("brand"),
    )


def dim_time(fact: DataFrame) -> DataFrame:
    return calendar_between(fact.agg(F.min("date").alias("first"), F.max("date").alias("last")))


def star_tables(spark: SparkSession, sf_dir: str, grain: str = "brand") -> StarTables:
    fact = fact_sales(spark, sf_dir, grain)
    return StarTables(
        fact_sales=fact,
        dim_sku=dim_sku(spark, sf_dir, grain),
        dim_store=dim_store(spark, sf_dir),
        dim_retailer=dim_retailer(spark, sf_dir),
        dim_time=dim_time(fact),
    )


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _variant(modulus: int, cases: dict[int, Column], default: Column) -> Column:
    picked = default
    for number, value in cases.items():
        picked = F.when(F.col(f"_pick_{modulus}") == number, value).otherwise(picked)
    return picked


_MODULI = (5, 6, 7, 11, 12, 13, 17, 19, 23, 29, 83, 89)


def raw_sales(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    """An untidy text feed, one row per order line, in the raw file's own columns.

    ``feed_position`` orders the rows the way a file would.
    """
    pick = F.col("order_number") * 7 + F.col("line_number") * 3 + F.col("quantity")
    lines = sale_lines(spark, sf_dir, grain).withColumns(
        {f"_pick_{m}": (pick % m).cast("int") for m in _MODULI}
    )
    units = F.col("quantity").cast("string")
    value = F.col("value").cast("string")
    null = F.lit(None).cast("string")
    item = F.col("item_name")
    list_price = F.col("list_price_text")
    return lines.select(
        _variant(89, {0: F.lit("no such store"), 1: null}, F.col("store_id")).alias("STORE_NAME"),
        _variant(83, {0: F.lit("no such item"), 1: null}, F.col("sku_id")).alias("ITEM_CODE"),
        _variant(13, {
            0: text("  o'neil   100g ", item, "-wine "), 1: text(item, " 500ML"),
            2: text("1 lb ", item), 3: text(item, " 6 pack"), 4: text("x 5 large ", item), 5: null,
        }, item).alias("ITEM_NAME"),
        F.col("item_type").alias("CATEGORY"),
        _variant(23, {
            0: text("1,", F.lpad(units, 3, "0")), 1: text("-", units), 2: text("(", units, ")"),
            3: F.lit("1.2.3"), 4: F.lit("1e5"), 5: F.lit(""), 6: null, 7: text(units, ".9"),
        }, units).alias("QTY"),
        _variant(19, {0: F.lit(""), 1: text("$", value), 2: text("-", value), 3: F.lit("n/a")},
                 value).alias("SALES_PRE_VAT"),
        _variant(17, {
            0: F.date_format("date", "dd/MM/yyyy"), 1: F.lit("1999-02-30"), 2: F.lit("x"), 3: null,
        }, F.col("date").cast("string")).alias("Date"),
        _variant(11, {0: F.lit("1,234.50"), 1: F.lit("$9.99"), 2: F.lit(""), 3: null}, list_price)
        .alias("RRP"),
        _variant(7, {0: F.lit("")}, list_price).alias("PRICE"),
        _variant(5, {0: F.lit("")}, F.lit("4.25")).alias("COST"),
        _variant(29, {0: F.lit(""), 1: null}, F.col("_pick_12").cast("string")).alias("STOCK"),
        _variant(6, {0: F.lit("Y"), 1: F.lit("1"), 2: F.lit("true"), 3: F.lit(""), 4: null},
                 F.lit("N")).alias("PROMO_FLAG"),
        F.struct("order_number", "line_number", "store_id", "sku_id", "date", "quantity", "value")
        .alias("feed_position"),
    )


def as_sales_file(fact: DataFrame) -> DataFrame:
    """Fact rows as the text columns of a sales file."""
    columns = {
        "RETAILER_ID": "retailer_id", "STORE_NAME": "store_id", "ITEM_CODE": "sku_id",
        "Date": "date", "QTY": "units_sold", "SALES_PRE_VAT": "sales_value", "RRP": "price",
        "COST": "cost", "STOCK": "stock_level", "PROMO_FLAG": "promo_active",
    }
    return fact.select(*[F.col(c).cast("string").alias(name) for name, c in columns.items()])


def raw_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A master sheet, one row per part: repeated brands, new products, gaps and blanks."""
    key = F.col("p_partkey")
    null = F.lit(None).cast("string")
    return _table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") <= 25, F.col("p_brand")).otherwise(text("P", key)).alias("CODE"),
        text("  ", F.col("p_name"), " ").alias("NAME"),
        F.when(key % 3 == 0, null).otherwise(F.col("p_type")).alias("CATEGORY"),
        text("Dept ", key % 7).alias("DEPARTMENT"),
        text("Sub ", key % 5).alias("SUB DEPARTMENT"),
        text(" Micro ", key % 11).alias("MICRO DEPARTMENT"),
        F.when(key % 4 == 0, null).otherwise(F.col("p_brand")).alias("Brand"),
        F.when(key % 2 == 0, "20").otherwise("0").alias("VAT"),
        text("Supplier ", key % 13).alias("SUPPLIER"),
        key.alias("sheet_row"),
    )


def store_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untrimmed store rows, one per supplier, some without a key."""
    row = F.col("s_suppkey")
    return _table(spark, sf_dir, "supplier").select(
        F.when(row % 10 == 0, F.lit("  ")).when(row % 10 == 1, text("S", row))
        .otherwise(text(" ", F.col("s_nationkey"))).alias("store_id"),
        text(F.col("s_name"), "  ").alias("store_name"),
        F.when(row % 3 == 0, F.lit(None).cast("string")).otherwise(text("Region ", row % 4))
        .alias("region"),
        F.lit(" kiosk ").alias("store_type"),
        row.alias("sheet_row"),
    )
