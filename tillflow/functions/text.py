"""Text cleaning with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings of a missing value in delimited text.
MISSING_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# A pack size is a number with one of these units; the first unit listed wins.
PACK_SIZE = r"(\d+\s*(?:g|kg|ml|l|oz|lb|pcs?|pack|pk|ct))"
# Spellings of an active promotion.
TRUE_SPELLINGS = ["1", "t", "true", "y", "yes"]

# Runs of cased letters and of everything else.
_CASED_RUNS = r"([\p{IsUppercase}\p{IsLowercase}\p{Lt}]+|[^\p{IsUppercase}\p{IsLowercase}\p{Lt}]+)"
_WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def is_blank(col: Column) -> Column:
    """Whether nothing but white space is there; the first other character settles it."""
    return ~col.rlike(r"(?U)[^\s\x1c-\x1f]")


def missing_to_null(col: Column) -> Column:
    return F.when(~col.isin(MISSING_SPELLINGS), col)


def tidy_text(col: Column) -> Column:
    """Collapse whitespace and title-case every run of letters; null gives an empty text.

    ``initcap`` alone starts words at blanks only, so it is applied run by run.
    """
    flat = F.trim(F.regexp_replace(col, _WHITESPACE, " "))
    runs = F.regexp_extract_all(F.lower(flat), F.lit(_CASED_RUNS), F.lit(1))
    return F.coalesce(F.array_join(F.transform(runs, F.initcap), ""), F.lit(""))


def pack_size(col: Column) -> Column:
    """First number with a unit in a product name, or an empty text."""
    return F.coalesce(F.regexp_extract(col, "(?iU)" + PACK_SIZE, 1), F.lit(""))


def promo_flag(col: Column) -> Column:
    return F.coalesce(F.lower(F.trim(col)).isin(TRUE_SPELLINGS), F.lit(False))
