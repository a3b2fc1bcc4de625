"""Partial aggregates of the fact by day, kept beside it and mergeable to longer periods.

``fact_days`` has one row a day. ``fact_day_stores`` has, for each day and store, the set of its
products as bitmaps over product codes, 32,768 codes to a bitmap. Bitmaps of several days or
stores are or-ed, so distinct products of a month are exact and cost no scan of the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillflow.operators.ranking import row_numbers
from tillflow.schemas import FACT_DAYS, FACT_DAY_STORES, SKU_CODES, conform


def day_rows(fact: DataFrame) -> DataFrame:
    """One row a day: rows, distinct stores and products, units and value in all and on promotion."""
    promo = F.col("promo_active")
    no_money = F.lit(0).cast("decimal(12,2)")
    return conform(fact.groupBy("date").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_distinct("store_id").alias("store_count"),
        F.count_distinct("sku_id").alias("sku_count"),
        F.sum("units_sold").alias("total_units_sold"),
        F.sum("sales_value").alias("total_sales_value"),
        F.sum(F.when(promo, F.col("units_sold")).otherwise(0)).alias("promo_units_sold"),
        F.sum(F.when(promo, F.col("sales_value")).otherwise(no_money)).alias("promo_sales_value"),
    ), FACT_DAYS)


def with_codes(codes: DataFrame, skus: DataFrame) -> DataFrame:
    """The codes with those of new products: the next numbers, in order of the ids.

    Numbers of present products never change, so bitmaps of earlier days stay valid. Without
    new products the given frame comes back.
    """
    new = skus.select("sku_id").where(F.col("sku_id").isNotNull()).distinct().join(
        codes.select("sku_id"), "sku_id", "left_anti")
    if new.isEmpty():
        return codes
    held = codes.agg(F.coalesce(F.max("code"), F.lit(0))).first()[0]
    numbered = row_numbers(new, ["sku_id"], "code").withColumn("code", F.col("code") + held)
    return conform(codes.unionByName(numbered.select("sku_id", "code")), SKU_CODES)


def store_bitmaps(fact: DataFrame, codes: DataFrame) -> DataFrame:
    """Per day, store and bucket of codes: the bitmap of the products with a row."""
    coded = fact.select("date", "store_id", "sku_id").join(codes, "sku_id")
    return conform(coded.groupBy(
        "date", "store_id", F.bitmap_bucket_number("code").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("skus")), FACT_DAY_STORES)


def distinct_skus(bitmaps: DataFrame, *by: Column | str) -> DataFrame:
    """(by.., skus): exact distinct products of all days and stores of a group."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("skus").alias("skus"))
    names = [c for c in merged.columns if c not in ("bucket", "skus")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("skus")).alias("skus"))
