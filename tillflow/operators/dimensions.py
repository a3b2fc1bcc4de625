"""Dimension upserts.

Precedence of attributes: master data, then what the dimension holds, then values seen
in the sales, then defaults.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillflow.functions.text import strip
from tillflow.operators.merge import full_merge, keep_one
from tillflow.schemas import (DIM_RETAILER, DIM_SKU, DIM_STORE, MASTER_NAMES, SEED_RETAILER,
                              conform, evolved)

# Attributes of products and stores known from sales only.
SKU_DEFAULTS = {"sku_name": "Unknown SKU", "category": "Unknown", "subcategory": "Unknown",
                "brand": "Unknown", "supplier": "Unknown", "rrp": 0.0, "cost": 0.0}
STORE_DEFAULTS = {"region": "Unknown", "area": "Unknown", "store_type": "Unknown"}
_STAMPS = ("created_at", "updated_at")


def ensure_retailer(dim_retailer: DataFrame, retailer_id: str, name: str | None = None,
                    created_at: dt.date | None = None) -> DataFrame:
    """The dimension with one more retailer, unless it is there."""
    spark = dim_retailer.sparkSession
    wanted = spark.createDataFrame(
        [(retailer_id, name or f"Retailer {retailer_id}", created_at)], DIM_RETAILER
    )
    return add_retailers(dim_retailer, wanted)


def add_retailers(dim_retailer: DataFrame, wanted: DataFrame) -> DataFrame:
    """Insert retailers that are absent; present ones stay as they are."""
    layout = evolved(DIM_RETAILER, dim_retailer)
    current = conform(dim_retailer, layout)
    absent = conform(wanted, layout).join(
        current.select("retailer_id"), "retailer_id", "left_anti"
    )
    return current.unionByName(absent.dropDuplicates(["retailer_id"]))


def retailers_of(sales: DataFrame) -> DataFrame:
    """Retailers named in the sales, with their generic names."""
    return sales.select("retailer_id").filter(F.col("retailer_id").isNotNull()).distinct().select(
        "retailer_id", F.concat(F.lit("Retailer "), F.col("retailer_id")).alias("retailer_name")
    )


def seed_retailer(dim_retailer: DataFrame, created_at: dt.date | None = None) -> DataFrame:
    return ensure_retailer(dim_retailer, *SEED_RETAILER, created_at=created_at)


def _stamps(loaded_at: Column, touched: Column) -> dict[str, Column]:
    return {
        "created_at": F.when(F.col("cur._here"), F.col("cur.created_at")).otherwise(loaded_at),
        "updated_at": F.when(touched, loaded_at).otherwise(F.col("cur.updated_at")),
    }


def _instant(loaded_at) -> Column:
    return F.lit(loaded_at).cast("timestamp")


def merge_dimension(current: DataFrame, incoming: DataFrame, schema: T.StructType, key: str,
                    loaded_at: dt.datetime | None = None) -> DataFrame:
    """Upsert in which incoming attributes win where they are present.

    ``incoming`` holds one row per key. Attributes it lacks keep their present value, also
    those that were added to the dimension beyond ``schema``. An added column takes the wider
    type of both sides.
    """
    shared = [f for f in incoming.schema.fields if f.name in current.columns]
    schema = evolved(schema, current, T.StructType(shared))
    given = [c for c in incoming.columns if c != key and c in schema.names and c not in _STAMPS]
    held = conform(current, schema)
    new = conform(incoming.select(key, *given), schema).filter(F.col(key).isNotNull())
    values = {
        c: F.coalesce(f"inc.{c}", f"cur.{c}") if c in given else F.col(f"cur.{c}")
        for c in schema.names if c != key and c not in _STAMPS
    }
    values |= _stamps(_instant(loaded_at), F.col("inc._here"))
    return full_merge(held, new, [key], values).select(*schema.names)


def fill_dimension(current: DataFrame, seen: DataFrame, schema: T.StructType, key: str,
                   defaults: dict, loaded_at: dt.datetime | None = None) -> DataFrame:
    """Add keys seen in sales and fill gaps; nothing the dimension knows is replaced."""
    schema = evolved(schema, current)
    held = conform(current, schema)
    new = conform(seen, schema).filter(F.col(key).isNotNull())
    values = {}
    for field in schema.fields:
        if field.name == key or field.name in _STAMPS:
            continue
        sources = [F.col(f"cur.{field.name}"), F.col(f"inc.{field.name}")]
        if field.name in defaults:
            fallback = F.lit(defaults[field.name]).cast(field.dataType)
            sources.append(F.when(F.col("inc._here"), fallback))
        values[field.name] = F.coalesce(*sources)
    values |= _stamps(_instant(loaded_at), F.col("inc._here"))
    return full_merge(held, new, [key], values).select(*schema.names)


def merge_skus_from_master(dim_sku: DataFrame, master: DataFrame, order: str,
                           loaded_at: dt.datetime | None = None) -> DataFrame:
    """Upsert products from a master frame; of repeated products the first row counts."""
    rows = keep_one(_known(master, dim_sku, DIM_SKU, order), ["sku_id"], order, "first")
    return merge_dimension(dim_sku, rows, DIM_SKU, "sku_id", loaded_at)


def merge_stores_from_master(dim_store: DataFrame, master: DataFrame, order: str,
                             loaded_at: dt.datetime | None = None) -> DataFrame:
    rows = keep_one(_known(master, dim_store, DIM_STORE, order), ["store_id"], order, "first")
    return merge_dimension(dim_store, rows, DIM_STORE, "store_id", loaded_at)


def merge_skus_from_sales(dim_sku: DataFrame, sales: DataFrame, order: str,
                          loaded_at: dt.datetime | None = None,
                          cleaned: dict[str, Column] | None = None) -> DataFrame:
    """Add the products of a sales frame; of repeated products the last row counts.

    ``cleaned`` says how attributes are made from the columns of that row: texts are then
    cleaned once for each product, not for each sale.

    Attributes are looked up in the sales only for products that are new or have a gap:
    once the dimension is filled, that leaves few rows to order by position.
    """
    attributes = [c for c in (*SKU_DEFAULTS, "department", "pack_size") if c in sales.columns]
    seen = sales.select("sku_id").distinct()
    if attributes:
        current = conform(dim_sku, DIM_SKU)
        gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in attributes])
        complete = current.filter(~gap).select("sku_id")
        wanted = seen.join(complete, "sku_id", "left_anti")
        rows = sales.select("sku_id", *attributes, order).join(wanted, "sku_id", "left_semi")
        last = keep_one(rows, ["sku_id"], order, "last").withColumns(cleaned or {})
        seen = seen.join(last, "sku_id", "left")
    return fill_dimension(dim_sku, seen, DIM_SKU, "sku_id", SKU_DEFAULTS, loaded_at)


def merge_stores_from_sales(dim_store: DataFrame, sales: DataFrame,
                            loaded_at: dt.datetime | None = None) -> DataFrame:
    """Add the stores of a sales frame, named by their id."""
    stores = sales.select("store_id").distinct().withColumn("store_name", F.col("store_id"))
    return fill_dimension(dim_store, stores, DIM_STORE, "store_id", STORE_DEFAULTS, loaded_at)


def upsert_dimension(current: DataFrame, incoming: DataFrame, schema: T.StructType, key: str,
                     columns: list[str], order: str,
                     loaded_at: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Generic upsert of trimmed values, and a row of counts: rows taken, rows without key.

    Of repeated keys the last row counts.
    """
    present = [c for c in columns if c in incoming.columns]
    trimmed = incoming.select(
        strip(F.col(key).cast("string")).alias(key),
        *[strip(F.col(c)).alias(c) if isinstance(schema[c].dataType, T.StringType) else F.col(c)
          for c in present],
        order,
    )
    good = trimmed.filter(F.col(key) != "")
    counts = trimmed.select(key, *present).distinct().agg(
        F.count_if(F.coalesce(F.col(key) != "", F.lit(False))).alias("upserted"),
        F.count_if(F.coalesce(F.col(key) == "", F.lit(True))).alias("errors"),
    )
    merged = merge_dimension(current, keep_one(good, [key], order, "last"), schema, key, loaded_at)
    return merged, counts


def replace_skus(master: DataFrame, order: str) -> DataFrame:
    """A product dimension made of the master sheet alone; the first of repeats counts."""
    columns = list(MASTER_NAMES.values())
    return keep_one(master.select(*columns, order), ["sku_id"], order, "first").select(*columns)


def enrich_skus(dim_sku: DataFrame, master: DataFrame, order: str) -> DataFrame:
    """Names, categories and departments of present products; no product is added."""
    given = ["sku_name", "category", "department"]
    latest = keep_one(master.select("sku_id", *given, order), ["sku_id"], order, "last")
    new = latest.withColumnsRenamed({c: f"_{c}" for c in given})
    joined = dim_sku.join(new, "sku_id", "left")
    return joined.select(
        *[F.coalesce(f"_{c}", c).alias(c) if c in given else F.col(c) for c in dim_sku.columns]
    )


def _known(df: DataFrame, held: DataFrame, schema: T.StructType, order: str) -> DataFrame:
    """The columns that the dimension has, and the order."""
    known = evolved(schema, held).names
    return df.select(*[c for c in df.columns if c in known and c not in _STAMPS], order)
