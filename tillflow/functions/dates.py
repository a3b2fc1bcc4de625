"""Report dates, date parsing and calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Accepted date layouts, and how each is turned into the ISO one.
ISO_DATE = (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "$1-$2-$3")
_TIME = r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?Z?)?$"
ISO_WITH_TIME = (r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})" + _TIME, "$1-$2-$3")
DAY_FIRST_WITH_TIME = (r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})" + _TIME, "$3-$2-$1")
DATE_LAYOUTS = (ISO_WITH_TIME, DAY_FIRST_WITH_TIME)
# An ISO date whose month has the day; in a common year 29 February is left to the cast.
_DAY = r"0?[1-9]|[12]\d"
POSSIBLE_DAY = (rf"\A\d{{4}}-(?:(?:0?[13578]|1[02])-(?:{_DAY}|3[01])"
                rf"|(?:0?[469]|11)-(?:{_DAY}|30)|0?2-(?:{_DAY}))\z")


def parse_date(col: Column, layouts=DATE_LAYOUTS) -> Column:
    """Text in one of the layouts to a date; null for impossible days and other texts.

    Texts are matched before they are cast: a failing date parser raises per row, which
    costs far more than a pattern. No layout changes an ISO date, so one is cast as it stands.
    """
    text = written = col.cast("string")
    for pattern, iso in layouts:
        if (pattern, iso) != ISO_DATE:
            written = F.regexp_replace(written, pattern, iso)
    # A line end may follow an ISO date where no layout has taken it off.
    written = F.regexp_extract(F.regexp_extract(written, ISO_DATE[0], 0), POSSIBLE_DAY, 0)
    return F.when(text.rlike(POSSIBLE_DAY), text).otherwise(written).try_cast("date")


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def week_start(col: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(col, "week")


def previous_month(as_of: dt.date) -> dt.date:
    """First day of the month before ``as_of``'s month."""
    return (as_of.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def two_months_back(as_of: dt.date) -> dt.date:
    return previous_month(previous_month(as_of))
