"""Is the fact up to date?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

# The check is due on Fridays (Monday is 0) and alerts after a day.
CHECK_WEEKDAY = 4
MAX_AGE_HOURS = 24


def date_column(df: DataFrame) -> str:
    """The first column whose name speaks of a date or time."""
    for name in df.columns:
        if "date" in name.lower() or "time" in name.lower():
            return name
    raise ValueError("no date column found")


def freshness(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row: last load, its age in hours, whether a check is due and whether it fails."""
    due = as_of.weekday() == CHECK_WEEKDAY
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    last = fact.agg(F.max(date_column(fact)).cast("timestamp").alias("last_load"))
    hours = (F.unix_timestamp(now) - F.unix_timestamp("last_load")) / 3600.0
    late = F.col("last_load").isNull() | (F.col("hours_since_load") > MAX_AGE_HOURS)
    return last.withColumn("hours_since_load", hours).select(
        F.col("last_load").cast("date").alias("last_load"), "hours_since_load",
        F.lit(due).alias("check_due"), (F.lit(due) & late).alias("stale"),
    )
