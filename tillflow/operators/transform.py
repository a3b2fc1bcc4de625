"""Raw sales to fact rows, and the split into good and rejected rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tillflow.functions.dates import parse_date
from tillflow.functions.numbers import number_text, parse_money, whole
from tillflow.functions.text import is_blank, promo_flag
from tillflow.operators.validate import standard_columns
from tillflow.schemas import DEFAULT_RETAILER_ID, FACT_KEY

# Fixed value: the cost assumed as a share of the price.
COST_SHARE = "0.7"
REASON = "reject_reason"
_FACT_COLUMNS = ["retailer_id", "store_id", "sku_id", "date", "units_sold", "sales_value",
                 "stock_level", "promo_active", "price", "cost"]
_NUMBERS = ["QTY", "SALES_AMOUNT", "STOCK", "STOCK_LEVEL", "RRP", "PRICE", "COST"]


def counted_rows(df: DataFrame, step: str) -> DataFrame:
    """The rows, counted on the way.

    A count ends the code that Spark generates for the steps before it. All steps in one make
    a method of over 8,000 bytes, which the JVM does not compile but interprets.
    """
    return df.observe(f"{step}-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def transform_sales(raw: DataFrame, retailer_id: str = DEFAULT_RETAILER_ID,
                    keep_sign: bool = False, stock_default: int = 0,
                    carry: list[str] | None = None,
                    observation: Observation | None = None) -> DataFrame:
    """Map, parse and default the raw columns.

    Price is the list price, else the price, else value per unit; cost defaults to a
    share of the price. Unreadable numbers become zero, but a number that does not fit
    its column is left null and named in ``reject_reason``, as is a missing key or date.
    ``carry`` keeps further columns, such as the file position.

    The rows are counted on the way, in ``observation`` if given. The counting also keeps
    a filter on the reason above the parsing: pushed below, it would parse all texts twice.
    """
    df = counted_rows(standard_columns(raw), "sales")
    null = F.lit(None).cast("string")
    source = lambda name: F.col(name) if name in df.columns else null
    # Steps build on one another, so that each text is cleaned and parsed once. The patterns
    # of all numbers would pass the size of a compiled method: they are cleaned in two steps.
    dated = df.select(
        F.coalesce(
            *[source(c) for c in ("RETAILER_ID", "retailer_id") if c in df.columns],
            F.lit(retailer_id),
        ).alias("retailer_id"),
        source("STORE_ID").alias("store_id"),
        source("ITEM_CODE").alias("sku_id"),
        parse_date(source("DATE")).alias("date"),
        promo_flag(source("PROMO_FLAG")).alias("promo_active"),
        *[number_text(source(name), keep_sign).alias(name) for name in _NUMBERS[:3]],
        *[source(name).alias(name) for name in _NUMBERS[3:]],
        *[F.col(c) for c in carry or []],
    )
    cleaned = counted_rows(dated, "dated").withColumns(
        {name: number_text(F.col(name), keep_sign) for name in _NUMBERS[3:]})
    parsed = counted_rows(cleaned, "cleaned").withColumns({
        "_units": F.coalesce(F.col("QTY").try_cast("double"), F.lit(0.0)),
        "_stock": F.coalesce(F.col("STOCK").try_cast("double"),
                             F.col("STOCK_LEVEL").try_cast("double"),
                             F.lit(float(stock_default))),
        "sales_value": parse_money(F.col("SALES_AMOUNT"), "decimal(12,2)",
                                   F.lit(0).cast("decimal(12,2)")),
    })
    units = F.when(F.col("_units") == 0, 1.0).otherwise(F.col("_units"))
    # Settled on ten decimals first, so that ties round away from zero.
    per_unit = (F.col("SALES_AMOUNT").try_cast("double") / units).try_cast("decimal(38,10)")
    per_unit = F.coalesce(per_unit, F.lit(0)).try_cast("decimal(10,2)")
    list_price = parse_money(F.col("PRICE"), "decimal(10,2)", per_unit)
    assumed_cost = F.col("price") * F.lit(COST_SHARE).cast("decimal(2,1)")
    typed = parsed.withColumns({
        "units_sold": whole(F.col("_units")),
        "stock_level": whole(F.col("_stock")),
        "price": parse_money(F.col("RRP"), "decimal(10,2)", list_price),
    }).withColumn(
        "cost", parse_money(F.col("COST"), "decimal(10,2)", assumed_cost.cast("decimal(10,2)"))
    )
    judged = typed.withColumn(REASON, row_fault()).select(*_FACT_COLUMNS, REASON, *(carry or []))
    return judged.observe(
        observation or f"transform-{uuid.uuid4().hex}",
        F.count(F.lit(1)).alias("rows"), F.count(REASON).alias("rejected"),
    )


def row_fault() -> Column:
    """What keeps a transformed row out of the fact, or null."""
    blank_key = F.lit(False)
    for key in FACT_KEY:
        if key != "date":
            blank_key = blank_key | F.col(key).isNull() | is_blank(F.col(key))
    too_large = F.lit(False)
    for measure in ("units_sold", "sales_value", "stock_level", "price", "cost"):
        too_large = too_large | F.col(measure).isNull()
    return (
        F.when(blank_key, "missing_key")
        .when(F.col("date").isNull(), "invalid_date")
        .when(too_large, "number_out_of_range")
    )


def accepted(transformed: DataFrame) -> DataFrame:
    return transformed.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(transformed: DataFrame) -> DataFrame:
    return transformed.filter(F.col(REASON).isNotNull())


def require_populated(df: DataFrame, columns: list[str]) -> None:
    """Raise when a column is absent or null in every row: one aggregate, one row back."""
    absent = [c for c in columns if c not in df.columns]
    if not absent:
        counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
        absent = [c for c in columns if counts[c] == 0]
    if absent:
        raise ValueError(f"columns without any value: {', '.join(absent)}")


def column_values(df: DataFrame) -> DataFrame:
    """(column_name, filled): rows with a value in each column, in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    pairs = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`"))])
    return counts.select(F.explode(pairs).alias("column_name", "filled"))
