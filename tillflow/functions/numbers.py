"""Number cleaning and rounding, safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Everything but digits and the decimal point is dropped.
NOT_A_DIGIT = r"[^\d\.]"
# A value is negative when it starts with a minus or is written in parentheses.
NEGATIVE_MARK = r"^\s*[-(]"
# What is left of a number: a failing cast raises per row, which costs far more than a pattern.
NUMBER = r"^-?(?:\d+\.?\d*|\.\d+)$"
# Most texts are a number as they stand: one pattern settles them, nothing is taken out.
PLAIN_NUMBER = r"\A(?:\d+\.?\d*|\.\d+)\z"


def number_text(col: Column, keep_sign: bool = False) -> Column:
    """The digits and points of a text, ready to be parsed; null where they make no number.

    The sign is dropped by default (returns then count as sales); ``keep_sign`` keeps it.
    """
    text = col.cast("string")
    digits = F.regexp_replace(text, NOT_A_DIGIT, "")
    if keep_sign:
        digits = F.concat(F.when(text.rlike(NEGATIVE_MARK), "-").otherwise(""), digits)
    found = F.nullif(F.regexp_extract(digits, NUMBER, 0), F.lit(""))
    return F.when(text.rlike(PLAIN_NUMBER), text).otherwise(found)


def clean_number(col: Column, keep_sign: bool = False, data_type: str = "double") -> Column:
    """Text to number; what does not parse becomes null.

    A decimal ``data_type`` is parsed from the text itself, not by way of a double.
    """
    return number_text(col, keep_sign).try_cast(data_type)


def parse_money(text: Column, data_type: str, missing: Column) -> Column:
    """A decimal from cleaned text; ``missing`` where there is no number.

    Null only for a number that does not fit the type.
    """
    unreadable = text.try_cast("double").isNull()
    return F.coalesce(text.try_cast(data_type), F.when(unreadable, missing))


def whole(col: Column) -> Column:
    """Truncate toward zero; null when the value does not fit an int."""
    return col.try_cast("int")


def round2(col: Column) -> Column:
    """Round a double half away from zero at two decimals.

    Going through a ten-digit decimal settles ties that a binary fraction would miss.
    """
    return F.round(col.cast("double").cast("decimal(38,10)"), 2).cast("double")


def percent(part: Column, whole_part: Column) -> Column:
    """``part / whole_part`` in percent at two decimals; null when the divisor is zero."""
    divisor = F.nullif(whole_part.cast("double"), F.lit(0.0))
    return round2((part * 100).cast("double") / divisor)
