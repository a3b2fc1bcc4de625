"""Loading the daily fact: filters, quarantine, upsert, watermark, summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillflow.operators.merge import full_merge, keep_one, unknown_keys
from tillflow.operators.transform import REASON
from tillflow.schemas import ETL_METADATA, FACT_KEY, FACT_MEASURES, FACT_SALES, conform

WATERMARK = "last_processed_date"
# Columns a fact batch has to carry.
REQUIRED_FACT_COLUMNS = ["retailer_id", "store_id", "sku_id", "date", "units_sold",
                         "sales_value", "price", "promo_active"]


def require_fact_columns(batch: DataFrame) -> None:
    absent = [c for c in REQUIRED_FACT_COLUMNS if c not in batch.columns]
    if absent:
        raise ValueError(f"fact batch lacks columns: {', '.join(absent)}")

# How far a batch may be dated after its load and still move the watermark.
AHEAD = dt.timedelta(days=7)


def newer_than(batch: DataFrame, watermark: dt.date | None,
               process_type: str = "incremental") -> DataFrame:
    """Rows after the watermark. ``full`` takes all, also late rows of a loaded day."""
    if process_type not in ("incremental", "full"):
        raise ValueError("process_type must be 'incremental' or 'full'")
    if process_type == "full" or watermark is None:
        return batch
    return batch.filter(F.col("date") > F.lit(watermark))


def split_references(batch: DataFrame, dim_sku: DataFrame,
                     dim_store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with known product and store, and the others with a reason.

    The batch is not shuffled to test its keys: its distinct keys are looked up, and it
    is joined with the unknown ones only. Rows without a key count as unknown.
    """
    bad_sku = unknown_keys(batch, dim_sku, "sku_id").withColumn("_bad_sku", F.lit(True))
    bad_store = unknown_keys(batch, dim_store, "store_id").withColumn("_bad_store", F.lit(True))
    flagged = batch.join(bad_sku, "sku_id", "left").join(bad_store, "store_id", "left").select(
        *batch.columns,
        F.when(F.col("_bad_sku") | F.col("sku_id").isNull(), "unknown_sku")
        .when(F.col("_bad_store") | F.col("store_id").isNull(), "unknown_store").alias(REASON),
    )
    return (flagged.filter(F.col(REASON).isNull()).drop(REASON),
            flagged.filter(F.col(REASON).isNotNull()))


def known_references(batch: DataFrame, dim_sku: DataFrame, dim_store: DataFrame) -> DataFrame:
    return split_references(batch, dim_sku, dim_store)[0]


def latest_per_key(batch: DataFrame, order: str) -> DataFrame:
    """One row per fact key: the last in file order. Columns beyond the layout stay."""
    return conform(keep_one(batch, FACT_KEY, order, "last"), FACT_SALES)


def _widened(current: DataFrame, latest: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the columns of either beyond the layout, and the names of those."""
    current = conform(current, FACT_SALES)
    added = {f.name: f.dataType for f in [*latest.schema, *current.schema]
             if f.name not in FACT_SALES.names}

    def widened(df: DataFrame) -> DataFrame:
        return df.select(*FACT_SALES.names, *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in added.items()])

    return widened(current), widened(latest), list(added)


def _merged_values(added: list[str], given: list[str], loaded_on: dt.date | None) -> dict:
    """Columns of a merged row from ``cur`` and ``inc``."""
    values = {
        m: F.when(F.col("inc._here"), F.col(f"inc.{m}")).otherwise(F.col(f"cur.{m}"))
        for m in given
    }
    values |= {c: F.col(f"cur.{c}") for c in added if c not in given}
    values["created_at"] = F.when(F.col("cur._here"), F.col("cur.created_at")).otherwise(
        F.coalesce(F.col("inc.created_at"), F.lit(loaded_on).cast("date"))
    )
    return values


def merge_fact(current: DataFrame, latest: DataFrame,
               loaded_on: dt.date | None = None) -> DataFrame:
    """Incoming rows replace the measures of equal keys; new keys are added.

    Both sides are unique by key. The date of first load stays. Columns beyond the layout
    are kept from either side; one that the incoming rows lack keeps its present values.
    """
    given = [*FACT_MEASURES, *[c for c in latest.columns if c not in FACT_SALES.names]]
    held, incoming, added = _widened(current, latest)
    return full_merge(held, incoming, FACT_KEY, _merged_values(added, given, loaded_on)).select(
        *FACT_SALES.names, *added
    )


def merge_few(current: DataFrame, latest: DataFrame,
              loaded_on: dt.date | None = None) -> DataFrame:
    """``merge_fact`` for few incoming rows: they are sent to the held rows, which stay in place.

    The caller has checked the number of incoming rows. The held files are read twice, the
    second time for their keys alone, and no held row is shuffled.
    """
    given = [*FACT_MEASURES, *[c for c in latest.columns if c not in FACT_SALES.names]]
    held, incoming, added = _widened(current, latest)
    same = [F.col(f"cur.{k}") == F.col(f"inc.{k}") for k in FACT_KEY]
    values = _merged_values(added, given, loaded_on)
    here = F.lit(True)
    replaced = held.withColumn("_here", here).alias("cur").join(
        F.broadcast(incoming.withColumn("_here", here)).alias("inc"), same, "left").select(
        *[F.col(f"cur.{k}").alias(k) for k in FACT_KEY],
        *[value.alias(name) for name, value in values.items()])
    keys = F.broadcast(incoming.select(FACT_KEY))
    # Keys are unique on both sides, so no more of them are met than come in.
    met = held.select(FACT_KEY).join(keys, FACT_KEY, "left_semi")
    new = incoming.join(F.broadcast(met), FACT_KEY, "left_anti").withColumn(
        "created_at", F.coalesce("created_at", F.lit(loaded_on).cast("date")))
    columns = [*FACT_SALES.names, *added]
    return replaced.select(columns).unionByName(new.select(columns))


def watermark_row(batch: DataFrame, updated_at: dt.datetime | None = None,
                  present: dt.datetime | None = None) -> DataFrame:
    """The state row after a batch: its latest date.

    Dates more than AHEAD after the load are left aside: sheets may be dated a little ahead,
    but a mistyped year must not stop all later loads. ``present`` is the time of the load
    where no ``updated_at`` is to be stored; with neither, every date counts.
    """
    loaded = updated_at or present
    if loaded is not None:
        batch = batch.where(F.col("date") <= F.lit(loaded.date() + AHEAD))
    return conform(
        batch.agg(F.max("date").alias("day")).filter(F.col("day").isNotNull()).select(
            F.lit(WATERMARK).alias("key"), F.col("day").cast("string").alias("value"),
            F.lit(updated_at).cast("timestamp").alias("updated_at"),
        ), ETL_METADATA,
    )


def load_summary(batch: DataFrame) -> DataFrame:
    """Rows, date range, stores, products and sums of a batch."""
    return batch.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_distinct("store_id").alias("unique_stores"),
        F.count_distinct("sku_id").alias("unique_skus"),
        F.sum("sales_value").alias("total_sales_value"),
        F.sum("units_sold").alias("total_units_sold"),
    )
