"""The batch load: raw sales in, star schema and fact updated."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tillflow.functions.text import pack_size, strip, tidy_text
from tillflow.operators.calendar import missing_days
from tillflow.operators.dimensions import (add_retailers, ensure_retailer,
                                           merge_skus_from_master, merge_skus_from_sales,
                                           merge_stores_from_master, merge_stores_from_sales,
                                           retailers_of)
from tillflow.operators.facts import (load_summary, newer_than, require_fact_columns,
                                      split_references, watermark_row)
from tillflow.operators.transform import (REASON, accepted, counted_rows, rejected, require_populated,
                                          transform_sales)
from tillflow.operators.validate import (FLAGS, flag_sums, missing_columns, row_flags,
                                         standard_columns, with_shares)
from tillflow.schemas import (DEFAULT_RETAILER_ID, ITEM_COLUMNS, POSITION, RAGGED, SEEN_FILES,
                              conform)
from tillflow.session import scratch_path
from tillflow.sources.sales_files import listed_files, read_new_sales, unseen_files
from tillflow.sources.tables import SavedTables


RAW_ROW = "raw_row"
# Set off from the raw columns, whose names may differ by case alone.
ITEM_MARK = "item: "


@dataclass(frozen=True)
class LoadResult:
    loaded: int
    rejected: int
    skipped: int
    rejects: DataFrame
    summary: DataFrame
    validation: DataFrame


def _item_texts(raw: DataFrame) -> dict[str, Column]:
    """What the file says of its products, by dimension column, as it stands there."""
    found = {name: F.col(c) for c, name in ITEM_COLUMNS.items() if c in raw.columns}
    if "ITEM_NAME" in raw.columns:
        found["pack_size"] = F.col("ITEM_NAME")
    return found


def _item_attribute(name: str) -> Column:
    """An attribute from the text of ``_item_texts``; blank texts are none."""
    clean = {"sku_name": tidy_text, "pack_size": pack_size}.get(name, strip)
    return F.nullif(clean(F.col(name)), F.lit(""))


def _validation(staged: DataFrame, sums: dict) -> DataFrame:
    """The counts of the staging pass, and repeats from the digests it left."""
    repeats = staged.groupBy("_row").count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]
    counts = {**sums, "duplicate_records": repeats}
    return with_shares(staged.sparkSession.createDataFrame(
        [tuple(counts.values())], ", ".join(f"{c} long" for c in counts)))


def load_sales(tables: SavedTables, raw: DataFrame, retailer_id: str = DEFAULT_RETAILER_ID,
               master: DataFrame | None = None, order: str = POSITION,
               process_type: str = "incremental", loaded_at: dt.datetime | None = None,
               keep_sign: bool = False, stock_default: int = 0,
               add_unknown: bool = True, load_id: str | None = None,
               name_products: bool = True) -> LoadResult:
    """Transform, validate, complete the dimensions, filter, upsert, note the watermark.

    The parsed batch is written once to the shared folder and every later step reads that
    copy, so the raw files are parsed once and a lost executor costs no second parse. The
    same pass counts what ``validate_sales`` counts; only digests are read again, for repeats.
    Rows that cannot be loaded are kept with their reason under ``load_id``, so that a repeated
    load does not keep them twice; rows that could not be parsed keep their texts as JSON in
    ``raw_row``, lines with too many or too few fields (see ``RAGGED``) their whole text. With
    ``add_unknown`` off, products and stores missing from the dimensions are rejected, not
    added. New products take name, pack size, category, department and supplier from the file
    unless ``name_products`` is off. An incremental load counts the rows up to the watermark as
    skipped: loaded, rejected and skipped rows add up to the batch. Without ``loaded_at``
    nothing is stamped, and dates are held against the clock before they move the watermark.

    All dimensions change in one commit; those whose content does not change keep their version.
    """
    spark = tables.spark
    loaded_on = loaded_at.date() if loaded_at else None
    raw = counted_rows(raw, "raw")
    absent = missing_columns(standard_columns(raw))
    if absent:   # before a default could stand in for them
        raise ValueError(f"sales lack columns: {', '.join(absent)}")
    staged_path = scratch_path(spark, "batch")
    own = [c for c in raw.columns if c not in (order, RAGGED)]
    row = F.struct(*[F.col(f"`{c}`") for c in own])
    texts = F.to_json(F.col(RAW_ROW))   # of rejected rows alone
    if RAGGED in raw.columns:
        texts = F.coalesce(F.col(RAGGED), texts)
    items = _item_texts(raw) if name_products else {}
    marked = {f"{ITEM_MARK}{name}": value for name, value in items.items()}
    ragged = [RAGGED] if RAGGED in raw.columns else []
    parsed = transform_sales(
        raw.withColumns({RAW_ROW: row, **marked, **row_flags(raw, keep_sign,
                                                            leave_out=(order, RAGGED))}),
        retailer_id, keep_sign, stock_default,
        [order, RAW_ROW, *FLAGS, *[f"`{c}`" for c in marked], *ragged])
    if ragged:
        parsed = parsed.withColumn(REASON, F.when(
            F.col(RAGGED).isNotNull(), "ragged_row").otherwise(F.col(REASON)))
    counted = Observation()
    parsed.withColumn(RAW_ROW, F.when(F.col(REASON).isNotNull(), texts)).drop(*ragged).observe(
        counted, *flag_sums()).write.parquet(staged_path)
    with_flags = spark.read.parquet(staged_path)
    validation = _validation(with_flags, counted.get)
    staged = with_flags.drop(*FLAGS).withColumnsRenamed(
        {f"{ITEM_MARK}{name}": name for name in items})
    good, bad = accepted(staged), rejected(staged).drop(*items)
    if counted.get["total_records"] == 0:
        return LoadResult(0, 0, 0, bad, load_summary(good), validation)
    require_fact_columns(good)
    require_populated(staged, [c for c in good.columns if c not in (order, RAW_ROW, *items)])

    retailers = ensure_retailer(tables.read("dim_retailer"), retailer_id, created_at=loaded_on)
    seen = retailers_of(good).withColumn("created_at", F.lit(loaded_on).cast("date"))
    skus, stores = tables.read("dim_sku"), tables.read("dim_store")
    if master is not None:
        if "sku_id" in master.columns:
            skus = merge_skus_from_master(skus, master, order, loaded_at)
        if "store_id" in master.columns:
            stores = merge_stores_from_master(stores, master, order, loaded_at)
    if add_unknown:
        skus = merge_skus_from_sales(skus, good, order, loaded_at,
                                     {name: _item_attribute(name) for name in items})
        stores = merge_stores_from_sales(stores, good, loaded_at)
    days = tables.read("dim_time")
    tables.replace_all({
        "dim_retailer": add_retailers(retailers, seen), "dim_sku": skus, "dim_store": stores,
        "dim_time": days.unionByName(missing_days(good, days))})

    good = good.drop(*items)
    fresh = newer_than(good, tables.watermark(), process_type)
    if add_unknown:   # every product and store of the batch has just been added
        known, unknown = fresh, bad.limit(0)
    else:
        known, unknown = split_references(fresh, tables.read("dim_sku"), tables.read("dim_store"))
    tables.upsert_fact(known.drop(RAW_ROW), order, loaded_on)
    tables.set_watermark(watermark_row(known, loaded_at, present=dt.datetime.now()))
    skipped = 0 if process_type == "full" else good.count() - fresh.count()

    label = load_id or staged_path.rsplit("/", 1)[-1]
    kept = f"{tables.path('quarantine')}/load_id={label}"
    bad.unionByName(unknown.select(*bad.columns)).drop(order).write.mode("overwrite").parquet(kept)
    rejects = spark.read.parquet(kept)
    summary = spark.createDataFrame(load_summary(good).collect(), load_summary(good).schema)
    result = LoadResult(known.count(), rejects.count(), skipped, rejects, summary, validation)
    tables.log.remove(staged_path)
    return result


def load_new_files(tables: SavedTables, folder: str, **load_options) -> LoadResult | None:
    """Load the sales files of a folder that are not in the ledger, and note them there.

    None if there is no new one. A load that fails notes nothing, so its files come again; the
    upsert makes that harmless. Late days are welcome, so every row is loaded.
    """
    load_options.setdefault("process_type", "full")
    seen = tables.read("seen_files")
    new = unseen_files(listed_files(tables.spark, folder), seen)
    # Settled here: files that arrive during the load belong to the next one.
    path = scratch_path(tables.spark, "new-files")
    new.write.parquet(path)
    new = tables.spark.read.schema(SEEN_FILES).parquet(path)
    if new.isEmpty():
        return None
    raw = read_new_sales(tables.spark, folder, new, ragged=RAGGED)
    result = load_sales(tables, raw, **load_options)
    tables.replace("seen_files", conform(seen, SEEN_FILES).join(
        new.select("path"), "path", "left_anti").unionByName(new))
    return result


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
