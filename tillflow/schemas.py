"""Column layouts of the star schema and of the raw files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
    "decimal(12,2)": T.DecimalType(12, 2), "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(22,2)": T.DecimalType(22, 2), "long": T.LongType(), "binary": T.BinaryType(),
}


def _fields(text: str) -> T.StructType:
    """A schema from ``name type`` pairs; works without a session."""
    pairs = (column.split() for column in text.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The columns of the star schema and of the state table.
DIM_RETAILER = _fields("retailer_id string, retailer_name string, created_at date")
DIM_STORE = _fields(
    "store_id string, retailer_id string, store_name string, location string, "
    "region string, area string, store_type string, created_at timestamp, updated_at timestamp"
)
DIM_SKU = _fields(
    "sku_id string, sku_name string, category string, subcategory string, department string, "
    "sub_department string, micro_department string, brand string, pack_size string, "
    "supplier string, vat_rate string, rrp decimal(10,2), cost decimal(10,2), "
    "created_at timestamp, updated_at timestamp"
)
DIM_TIME = _fields(
    "date date, day_of_week int, day_name string, week_number int, month_number int, "
    "month_name string, quarter int, year int, is_weekend boolean"
)
FACT_SALES = _fields(
    "retailer_id string, store_id string, sku_id string, date date, units_sold int, "
    "sales_value decimal(12,2), stock_level int, promo_active boolean, "
    "price decimal(10,2), cost decimal(10,2), created_at date"
)
ETL_METADATA = _fields("key string, value string, updated_at timestamp")

# Partial aggregates of the fact, kept by its upserts, and the files that were taken.
FACT_DAYS = _fields(
    "date date, fact_rows long, store_count long, sku_count long, total_units_sold long, "
    "total_sales_value decimal(22,2), promo_units_sold long, promo_sales_value decimal(22,2)"
)
FACT_DAY_STORES = _fields("date date, store_id string, bucket long, skus binary")
SKU_CODES = _fields("sku_id string, code long")
SEEN_FILES = _fields("path string, length long, modified timestamp")

TABLES = {
    "dim_retailer": DIM_RETAILER,
    "dim_store": DIM_STORE,
    "dim_sku": DIM_SKU,
    "dim_time": DIM_TIME,
    "fact_sales": FACT_SALES,
    "etl_metadata": ETL_METADATA,
}

# Tables kept beside the star schema.
SIDE_TABLES = {
    "fact_days": FACT_DAYS,
    "fact_day_stores": FACT_DAY_STORES,
    "sku_codes": SKU_CODES,
    "seen_files": SEEN_FILES,
}

# Where a row came from in its file; orders "first" and "last" rows of one key.
POSITION = "file_position"
# The text of a line with more or fewer fields than the heading; null for all others.
RAGGED = "ragged_line"

FACT_KEY = ["retailer_id", "store_id", "sku_id", "date"]
FACT_MEASURES = ["units_sold", "sales_value", "stock_level", "promo_active", "price", "cost"]

# Columns of the raw sales file that describe the product, and what they fill.
ITEM_COLUMNS = {"ITEM_NAME": "sku_name", "CATEGORY": "category", "DEPARTMENT": "department",
                "SUPPLIER_NAME": "supplier"}
# Raw names and the standard names they are known by.
STANDARD_NAMES = {"STORE_NAME": "STORE_ID", "SALES_PRE_VAT": "SALES_AMOUNT", "Date": "DATE"}
# Columns a sales file should carry, and those cleaned to numbers.
REQUIRED_COLUMNS = ["STORE_ID", "ITEM_CODE", "QTY", "SALES_AMOUNT", "DATE"]
NUMERIC_COLUMNS = ["QTY", "SALES_AMOUNT", "PRICE", "COST", "STOCK_LEVEL"]
# Master product sheet headings and the dimension columns they fill.
MASTER_NAMES = {
    "CODE": "sku_id",
    "NAME": "sku_name",
    "CATEGORY": "category",
    "DEPARTMENT": "department",
    "SUB DEPARTMENT": "sub_department",
    "MICRO DEPARTMENT": "micro_department",
    "Brand": "brand",
    "VAT": "vat_rate",
    "SUPPLIER": "supplier",
}
# The retailer every new schema starts with, and the ingest default.
SEED_RETAILER = ("DEFAULT", "Default Retailer")
DEFAULT_RETAILER_ID = "DEFAULT_RETAILER"


# Whole numbers by how many digits they need.
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both.

    Whole numbers widen to longer ones, then to decimals with room for both, then, where 38
    digits do not do or a side is a float, to double; a date widens to a timestamp. All
    else, such as a number and a text, meets in string.
    """
    if a == b:
        return a
    kinds = {a.simpleString(), b.simpleString()}
    if kinds <= set(_WHOLE):
        return max((a, b), key=lambda t: _WHOLE[t.simpleString()])
    if kinds <= {"date", "timestamp"}:
        return T.TimestampType()

    def digits(kind: T.DataType) -> tuple[int, int] | None:
        if isinstance(kind, T.DecimalType):
            return kind.precision - kind.scale, kind.scale
        return (_WHOLE[kind.simpleString()], 0) if kind.simpleString() in _WHOLE else None

    sides = [digits(a), digits(b)]
    if all(sides):
        before, after = (max(s[k] for s in sides) for k in (0, 1))
        return T.DecimalType(before + after, after) if before + after <= 38 else T.DoubleType()
    numbers = [s is not None or t.simpleString() in ("float", "double")
               for s, t in zip(sides, (a, b))]
    return T.DoubleType() if all(numbers) else T.StringType()


def evolved(base: T.StructType, *frames: DataFrame | T.StructType) -> T.StructType:
    """``base`` and after it the columns that the frames add; added ones take the wider type."""
    added: dict[str, T.DataType] = {}
    for frame in frames:
        for f in (frame if isinstance(frame, T.StructType) else frame.schema).fields:
            if f.name not in base.names:
                added[f.name] = wider(added.get(f.name, f.dataType), f.dataType)
    return T.StructType([*base.fields, *[T.StructField(n, t) for n, t in added.items()]])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Additive schema evolution: cast known columns, add absent ones as null.

    Columns the schema does not know stay at the end, so a newer writer is not cut.
    """
    present = set(df.columns)
    known: list[Column] = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    extra = [F.col(c) for c in df.columns if c not in schema.names]
    return df.select(*known, *extra)


def union_evolved(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of both frames over the union of their columns."""
    return current.unionByName(incoming, allowMissingColumns=True)
