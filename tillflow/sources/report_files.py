"""Reports as CSV folders."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F, types as T


def without_zone(df: DataFrame) -> DataFrame:
    """Zoned timestamps as plain local ones."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def save_reports(reports: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write every report that has rows below ``folder``; gives the row counts.

    Reports are kept for the length of the call: counting and writing run once each, and
    the issue summary counts the flag lists that are already there. Losing an executor
    only recomputes.
    """
    kept = {name: df.persist(StorageLevel.MEMORY_AND_DISK) for name, df in reports.items()}
    counts = {}
    try:
        for name, df in kept.items():
            counts[name] = df.count()
            if counts[name]:
                without_zone(df).write.mode("overwrite").option("header", True).csv(
                    f"{folder.rstrip('/')}/{name}"
                )
    finally:
        for df in kept.values():
            df.unpersist()
    return counts
