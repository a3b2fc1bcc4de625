"""Exact ranks, tiles and percentiles without a single-task window.

Rows are range-partitioned into ordered slices. Only the slice sizes are added up
globally: one row per slice and group, whatever the size of the data. The sliced rows
are checkpointed, since a range partitioning that is recomputed may cut elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillflow.session import shared_folder

SLICE = "_slice"


def _ordered_slices(df: DataFrame, columns: list[str]) -> DataFrame:
    shared_folder(df.sparkSession)
    return (
        df.repartitionByRange(*columns).withColumn(SLICE, F.spark_partition_id()).checkpoint()
    )


def _slice_offsets(sliced: DataFrame, group: list[str], weight: Column) -> DataFrame:
    """Rows before each slice and rows in all, per group."""
    sizes = sliced.groupBy(*group, SLICE).agg(F.sum(weight).alias("_rows"))
    within = Window.partitionBy(*group)
    before = within.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *group, SLICE, "_rows",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(within).alias("_total"),
    )


def ntile(df: DataFrame, order: list[str], tiles: int, alias: str) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY order)``; ``order`` should identify a row."""
    sliced = _ordered_slices(df, order)
    offsets = _slice_offsets(sliced, [], F.lit(1))
    in_slice = Window.partitionBy(SLICE).orderBy(*order)
    ranked = sliced.join(offsets, SLICE).withColumn(
        "_rank", F.col("_before") + F.row_number().over(in_slice)
    )
    # The first total % tiles tiles hold one row more than the others.
    size = F.expr(f"_total div {tiles}")
    larger = F.col("_total") % tiles
    return ranked.withColumns({"_size": size, "_larger": larger}).select(
        *df.columns,
        F.when(
            F.col("_rank") <= F.col("_larger") * (F.col("_size") + 1),
            F.expr("(_rank - 1) div (_size + 1) + 1"),
        ).otherwise(
            F.expr("_larger + (_rank - _larger * (_size + 1) - 1) div nullif(_size, 0) + 1")
        ).cast("int").alias(alias),
    )


def row_numbers(df: DataFrame, order: list[str], alias: str) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)``; ``order`` should identify a row."""
    sliced = _ordered_slices(df, order)
    in_slice = Window.partitionBy(SLICE).orderBy(*order)
    return sliced.join(_slice_offsets(sliced, [], F.lit(1)), SLICE).select(
        *df.columns, (F.col("_before") + F.row_number().over(in_slice)).alias(alias))


def value_counts(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Ordered, checkpointed histogram of ``value`` per group: the input of ``percentile``."""
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_count"))
    return _ordered_slices(counts, [*group, value])


def percentile(counts: DataFrame, group: list[str], value: str, share: float,
               alias: str) -> DataFrame:
    """Exact interpolated percentile per group from ``value_counts``; nulls do not count.

    Only the slices that hold one of the two neighbouring ranks are ranked row by row.
    """
    known = counts.filter(F.col(value).isNotNull())
    position = F.lit(share) * (F.col("_total") - 1)
    offsets = _slice_offsets(known, group, F.col("_count")).withColumns({
        "_low": F.floor(position) + 1, "_high": F.ceil(position) + 1,
        "_part": position - F.floor(position),
    })
    first, last = F.col("_before") + 1, F.col("_before") + F.col("_rows")
    holding = offsets.filter(
        F.col("_low").between(first, last) | F.col("_high").between(first, last)
    )
    running = Window.partitionBy(*group, SLICE).orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = known.join(holding, [*group, SLICE]).withColumn(
        "_upto", F.col("_before") + F.sum("_count").over(running)
    )
    covers = lambda rank: (
        F.col(rank) <= F.col("_upto")) & (F.col(rank) > F.col("_upto") - F.col("_count"))
    number = F.col(value).cast("double")
    ends = ranked.groupBy(*group).agg(
        F.max(F.when(covers("_low"), number)).alias("_from"),
        F.max(F.when(covers("_high"), number)).alias("_to"),
        F.max("_part").alias("_part"),
    )
    return ends.select(
        *group, (F.col("_from") + (F.col("_to") - F.col("_from")) * F.col("_part")).alias(alias)
    )
