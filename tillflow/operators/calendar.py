"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Days without a row that still count as a gap in the calendar; more is taken for a mistyped date.
WIDEST_GAP = 366


def calendar_between(bounds: DataFrame) -> DataFrame:
    """One row per day of a frame with ``first`` and ``last`` dates, both included.

    Monday is day 1 and weeks are ISO weeks; the year is the calendar year.
    """
    day = F.col("date")
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date")).select(
        "date",
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_number"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def day_spans(fact: DataFrame) -> DataFrame:
    """(first, last, wide) from each day of the fact to the day before its next one.

    A span of more than WIDEST_GAP days is ``wide`` and holds its first day alone. Distinct
    days are no more than the calendar has, which bounds the window's only task.
    """
    days = fact.select("date").where(F.col("date").isNotNull()).distinct()
    next_day = F.lead("date").over(Window.orderBy("date"))
    gap = F.datediff(next_day, F.col("date"))
    wide = F.coalesce(gap > WIDEST_GAP, F.lit(False))
    return days.select(
        F.col("date").alias("first"), wide.alias("wide"),
        F.when(wide, F.col("date")).otherwise(
            F.coalesce(F.date_sub(next_day, 1), F.col("date"))).alias("last"))


def missing_days(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Calendar rows for the fact's days and the gaps between them that the dimension lacks.

    Spans are dealt over tasks before they are filled. One mistyped year adds its own day and
    no other: see ``wide_gaps`` for such dates.
    """
    spans = day_spans(fact).repartition("first")
    return calendar_between(spans).join(dim_time.select("date"), "date", "left_anti")


def wide_gaps(fact: DataFrame) -> DataFrame:
    """(after, before): neighbouring days of the fact with over WIDEST_GAP days between them."""
    days = fact.select("date").where(F.col("date").isNotNull()).distinct()
    pairs = days.select(F.col("date").alias("after"),
                        F.lead("date").over(Window.orderBy("date")).alias("before"))
    return pairs.where(F.datediff("before", "after") > WIDEST_GAP)
