"""Validation of raw sales: cleaned columns and one row of counts. No row is dropped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillflow.functions.dates import ISO_DATE, parse_date
from tillflow.functions.numbers import clean_number
from tillflow.schemas import NUMERIC_COLUMNS, POSITION, REQUIRED_COLUMNS, STANDARD_NAMES


def standard_columns(raw: DataFrame) -> DataFrame:
    """Raw headings to standard ones; a standard column that is already there stays."""
    return raw.withColumnsRenamed(
        {old: new for old, new in STANDARD_NAMES.items()
         if old in raw.columns and new not in raw.columns}
    )


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in REQUIRED_COLUMNS if c not in df.columns]


def clean_columns(df: DataFrame, keep_sign: bool = False, layouts=(ISO_DATE,)) -> DataFrame:
    """Numbers and dates of a standard frame parsed in place; bad values become null."""
    cleaned = {c: clean_number(F.col(c), keep_sign) for c in NUMERIC_COLUMNS if c in df.columns}
    if "DATE" in df.columns:
        cleaned["DATE"] = parse_date(F.col("DATE"), layouts)
    return df.withColumns(cleaned) if cleaned else df


def _any(conditions: list[Column], otherwise: bool) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(otherwise)


def _total(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [f.cast("long") for f in flags], F.lit(0).cast("long"))


FLAGS = ("_row", "_missing", "_invalid", "_negative", "_bad_date")


def row_flags(raw: DataFrame, keep_sign: bool = False, layouts=(ISO_DATE,),
              leave_out: tuple[str, ...] = ()) -> dict[str, Column]:
    """FLAGS: a digest that is equal for equal cleaned rows, and what is counted of a raw row.

    Missing fields are counted before cleaning. 32 bytes of digest stand for the row where
    repeats are counted.
    """
    names = {new: old for old, new in zip(raw.columns, standard_columns(raw).columns)
             if old not in (POSITION, *leave_out)}
    before = [raw[f"`{names[c]}`"] for c in REQUIRED_COLUMNS if c in names]
    cleaned = {new: raw[f"`{old}`"] for new, old in names.items()}
    cleaned |= {c: clean_number(cleaned[c], keep_sign) for c in NUMERIC_COLUMNS if c in names}
    if "DATE" in names:
        cleaned["DATE"] = parse_date(cleaned["DATE"], layouts)
    numbers = [cleaned[c] for c in NUMERIC_COLUMNS if c in names]
    row = F.struct(*[c.alias(n) for n, c in cleaned.items()])
    return {
        "_row": F.unhex(F.sha2(F.to_json(row), 256)),
        "_missing": _any([c.isNull() for c in before], otherwise=True).cast("long"),
        "_invalid": _total([c.isNull() for c in numbers]),
        "_negative": _total([F.coalesce(c < 0, F.lit(False)) for c in numbers]),
        "_bad_date": (cleaned["DATE"].isNull() if "DATE" in names else F.lit(False)).cast("long"),
    }


def stats_of_flags(flagged: DataFrame) -> DataFrame:
    """One row of counts of rows of ``row_flags``: one shuffle of their digests."""
    per_row = flagged.groupBy("_row").agg(
        F.count(F.lit(1)).alias("_copies"),
        *[F.sum(c).alias(c) for c in ("_missing", "_invalid", "_negative", "_bad_date")],
    )
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))
    return with_shares(per_row.agg(
        total("_copies").alias("total_records"),
        total("_missing").alias("missing_required_fields"),
        total("_invalid").alias("invalid_numeric_values"),
        total("_negative").alias("negative_values"),
        total("_bad_date").alias("invalid_dates"),
        total(F.col("_copies") - 1).alias("duplicate_records"),
    ))


def with_shares(counts: DataFrame) -> DataFrame:
    """Counts of rows, and the valid ones: no row is dropped."""
    return counts.select(
        "*",
        F.col("total_records").alias("valid_records"),
        F.when(F.col("total_records") > 0, F.lit(100.0)).alias("valid_pct"),
    )


def flag_sums() -> list[Column]:
    """Metrics of rows of ``row_flags`` that need no shuffle, for an ``Observation``."""
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))
    return [F.count(F.lit(1)).alias("total_records"),
            total("_missing").alias("missing_required_fields"),
            total("_invalid").alias("invalid_numeric_values"),
            total("_negative").alias("negative_values"),
            total("_bad_date").alias("invalid_dates")]


def validation_stats(raw: DataFrame, keep_sign: bool = False, layouts=(ISO_DATE,)) -> DataFrame:
    """Counts of missing, invalid, negative and repeated values: one scan, one shuffle."""
    flags = row_flags(raw, keep_sign, layouts)
    return stats_of_flags(raw.select(*[c.alias(n) for n, c in flags.items()]))


def validate_sales(raw: DataFrame, keep_sign: bool = False,
                   layouts=(ISO_DATE,)) -> tuple[DataFrame, DataFrame]:
    """The cleaned frame and its counts, both lazy."""
    cleaned = clean_columns(standard_columns(raw), keep_sign, layouts)
    return cleaned, validation_stats(raw, keep_sign, layouts)
