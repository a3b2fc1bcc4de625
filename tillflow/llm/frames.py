"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# ASCII white space, as the contracts spell it: [\x20\x09-\x0D].
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = "[ \\t-\\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased and nothing else; pure ASCII values take the fast built-in."""
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(
        F.translate(column, UPPER, UPPER.lower()))


def packed(df: DataFrame, **own: Column) -> DataFrame:
    """``own`` columns beside the whole input row in one struct, so that names cannot clash."""
    return df.select(*[c.alias(n) for n, c in own.items()], F.struct("*").alias("row"))


def unpacked(df: DataFrame, columns: list[str], **added: Column) -> DataFrame:
    """The input columns again, and ``added`` ones, which replace inputs of the same name."""
    kept = [F.col("row").getField(c).alias(c) for c in columns if c not in added]
    return df.select(*kept, *[c.alias(n) for n, c in added.items()])
