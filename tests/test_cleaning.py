import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.functions.dates import (ISO_DATE, month_start, parse_date, previous_month,
                                      two_months_back, week_start)
from tillflow.functions.numbers import clean_number, number_text, percent, round2, whole
from tillflow.functions.text import (is_blank, missing_to_null, pack_size, promo_flag, strip,
                                     tidy_text)
from tillflow.operators.transform import accepted, rejected, require_populated, transform_sales
from tillflow.operators.validate import (clean_columns, missing_columns, standard_columns,
                                         validate_sales, validation_stats)


def apply(spark, column, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}").coalesce(1)
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_clean_number(spark):
    texts = ["12", "1,200", "-5", "(7)", "1.2.3", "1e5", "", None, "2.9", "$9.99", "5.", ".5", "."]
    assert apply(spark, clean_number, texts) == [
        12, 1200, 5, 7, None, 15, None, None, 2.9, 9.99, 5, 0.5, None]
    assert apply(spark, lambda c: clean_number(c, keep_sign=True), ["-5", "(7)", " -1.5", "3-1"]) \
        == [-5, -7, -1.5, 31]
    assert apply(spark, lambda c: clean_number(c, data_type="decimal(12,2)"), ["2.675", "x"]) \
        == [Decimal("2.68"), None]


def test_whole_truncates_toward_zero(spark):
    assert apply(spark, whole, [2.9, -2.9, 1e12, None], "double") == [2, -2, None, None]


def test_rounding_ties(spark):
    assert apply(spark, round2, [2.675, -34.375, 1.005, None], "double") \
        == [2.68, -34.38, 1.01, None]
    row = spark.range(1).select(percent(F.lit(1), F.lit(0)), percent(F.lit(1), F.lit(3))).first()
    assert list(row) == [None, 33.33]


def test_parse_date(spark):
    texts = ["2024-01-05", "2024-1-5", "05/01/2024", "2024-02-30", "x", "", None,
             "2024-01-05 10:00", "31/02/2024", "13/13/2024", "2024-01-05T10:00:01.5Z",
             "2024/1/5", "05-01-2024 9:30", "2024-01-05 noon", "2024-02-30 10:00"]
    day = dt.date(2024, 1, 5)
    # The time of day is dropped, whatever it says; other words beside a date are not.
    assert apply(spark, parse_date, texts) == [
        day, day, day, None, None, None, None, day, None, None, day, day, day, None, None]
    assert apply(spark, lambda c: parse_date(c, (ISO_DATE,)), texts) == [day, day] + [None] * 13


def test_plain_texts_are_told_as_before(spark):
    """What one pattern settles is what taking apart and matching again finds."""
    numbers = ["12", "12\n", "1.", ".5", ".", "", "-3", "00", "1.2.3", "\u0661", "1_0", " 7 ", None]
    slow = lambda c: F.nullif(F.regexp_extract(
        F.regexp_replace(c, r"[^\d\.]", ""), r"^-?(?:\d+\.?\d*|\.\d+)$", 0), F.lit(""))
    assert apply(spark, number_text, numbers) == apply(spark, slow, numbers)
    days = [f"{y}-{m}-{d}" for y in (1900, 2000, 2023) for m in ("0", "2", "02", "04", "11", "12", "13")
            for d in ("0", "1", "09", "28", "29", "30", "31", "32")] + ["2024-01-05\n", "20240105"]
    cast = lambda c: F.regexp_extract(c, ISO_DATE[0], 0).try_cast("date")
    assert apply(spark, lambda c: parse_date(c, (ISO_DATE,)), days) == apply(spark, cast, days)
    blanks = ["", " ", "\t\n", "\u00a0\u2003", "\x1c", "a", " a ", "\u200b", None]
    assert apply(spark, is_blank, blanks) == apply(spark, lambda c: strip(c) == "", blanks)


@pytest.mark.parametrize("keep_sign", [False, True])
def test_steps_of_the_transform_are_compiled(spark, keep_sign, capsys):
    """A generated method of over 8,000 bytes is interpreted."""
    names = ["STORE_ID", "ITEM_CODE", "DATE", "QTY", "SALES_AMOUNT", "STOCK", "STOCK_LEVEL", "RRP",
             "PRICE", "COST", "PROMO_FLAG"]
    raw = spark.range(10).select(*[F.col("id").cast("string").alias(n) for n in names])
    transform_sales(raw, keep_sign=keep_sign).explain("codegen")
    text = capsys.readouterr().out
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_report_dates():
    assert previous_month(dt.date(1999, 2, 28)) == dt.date(1999, 1, 1)
    assert two_months_back(dt.date(1999, 1, 15)) == dt.date(1998, 11, 1)


def test_period_starts(spark):
    row = spark.createDataFrame([(dt.date(1999, 1, 3),)], "d date").select(
        month_start(F.col("d")), week_start(F.col("d"))).first()
    assert list(row) == [dt.date(1999, 1, 1), dt.date(1998, 12, 28)]


@pytest.mark.parametrize("text", [
    "  o'neil   100g red-wine ", "CAFE CRÈME", "élan vital", "mcdonald's", "3rd a1b2", "\tx y",
    "straße", "日本abc", "",
])
def test_tidy_text_matches_title_case(spark, text):
    assert apply(spark, tidy_text, [text]) == [" ".join(text.split()).title()]


def test_tidy_text_of_null(spark):
    assert apply(spark, tidy_text, [None]) == [""]


def test_pack_size(spark):
    names = ["Milk 500ML", "1 lb beef", "Egg 6 pack", "Rice 1kg", "x 5 large", "none", None]
    assert apply(spark, pack_size, names) == ["500ML", "1 l", "6 pack", "1kg", "5 l", "", ""]


def test_flags_and_missing_spellings(spark):
    assert apply(spark, promo_flag, ["Y", "1", "true", " yes ", "N", "", None]) \
        == [True] * 4 + [False] * 3
    assert apply(spark, missing_to_null, ["NA", "null", "", "Nab", None]) \
        == [None, None, None, "Nab", None]


RAW = "STORE_NAME string, ITEM_CODE string, QTY string, SALES_PRE_VAT string, Date string"


def raw(spark, rows, schema=RAW):
    return spark.createDataFrame(rows, schema)


def test_validation_counts(spark):
    df = raw(spark, [
        ("s", "i", "1", "2", "2024-01-05"),
        ("s", "i", "1", "2", "2024-01-05"),
        ("s", "i", "1x", "2", "2024-01-05"),   # equal once cleaned
        (None, "i", "-3", "abc", "05/01/2024"),
        ("s", None, None, "", "2024-02-30"),
    ])
    row = validation_stats(df).first().asDict()
    assert row == {
        "total_records": 5, "missing_required_fields": 2, "invalid_numeric_values": 3,
        "negative_values": 0, "invalid_dates": 2, "duplicate_records": 2,
        "valid_records": 5, "valid_pct": 100.0,
    }
    assert validation_stats(df, keep_sign=True).first().negative_values == 1
    cleaned, stats = validate_sales(df)
    assert cleaned.count() == 5 and stats.count() == 1


def test_validation_of_odd_layouts(spark):
    other = raw(spark, [("a",), ("a",)], "OTHER string")
    assert missing_columns(standard_columns(other)) == [
        "STORE_ID", "ITEM_CODE", "QTY", "SALES_AMOUNT", "DATE"]
    row = validation_stats(other).first()
    assert (row.missing_required_fields, row.duplicate_records) == (2, 1)
    empty = validation_stats(raw(spark, [])).first()
    assert (empty.total_records, empty.duplicate_records, empty.valid_pct) == (0, 0, None)
    both = raw(spark, [("a", "b")], "STORE_NAME string, STORE_ID string")
    assert standard_columns(both).columns == ["STORE_NAME", "STORE_ID"]
    assert clean_columns(other).columns == ["OTHER"]


FULL = RAW + ", RRP string, PRICE string, COST string, STOCK string, PROMO_FLAG string"


def test_transform_defaults_and_rejects(spark):
    df = raw(spark, [
        ("s", "i", "2.9", "1,234.50", "2024-01-05", "$9.99", None, None, None, "Y"),
        ("s", "i", "-4", "10", "05/01/2024", None, "5", "3", "8", "N"),
        ("s", "i", "0", "7.505", "2024-01-05", None, None, None, None, None),
        ("", "i", "1", "1", "2024-01-05", None, None, None, None, None),
        ("s", "i", "1", "1", "2024-02-30", None, None, None, None, None),
        ("s", "i", "99999999999", "1", "2024-01-05", "1", None, None, None, None),
        ("s", "i", "1", "123456789012.00", "2024-01-05", "1", None, None, None, None),
        ("s", "i", "1", "1", "2024-01-05", "123456789.00", None, None, None, None),
    ], FULL)
    out = transform_sales(df, "r", stock_default=3)
    rows = {r.units_sold: r for r in accepted(out).collect()}
    first, second, third = rows[2], rows[4], rows[0]
    assert (first.sales_value, first.price, first.cost, first.stock_level, first.promo_active) \
        == (Decimal("1234.50"), Decimal("9.99"), Decimal("6.99"), 3, True)
    assert (second.price, second.cost, second.stock_level, second.date) \
        == (Decimal("5.00"), Decimal("3.00"), 8, dt.date(2024, 1, 5))
    assert (third.price, third.sales_value) == (Decimal("7.51"), Decimal("7.51"))
    assert {r.retailer_id for r in rows.values()} == {"r"}
    reasons = sorted(r.reject_reason for r in rejected(out).collect())
    assert reasons == ["invalid_date", "missing_key"] + ["number_out_of_range"] * 3
    signed = transform_sales(df, "r", keep_sign=True)
    assert accepted(signed).filter("units_sold = -4").count() == 1


def test_retailer_column_wins(spark):
    df = raw(spark, [("7", "s", "i", "1", "1", "2024-01-05"), (None, "s", "i", "1", "1", "2024-01-05")],
             "RETAILER_ID string, " + RAW)
    assert {r.retailer_id for r in transform_sales(df).collect()} == {"7", "DEFAULT_RETAILER"}


def test_require_populated(spark):
    df = raw(spark, [("a", None)], "x string, y string")
    require_populated(df, ["x"])
    with pytest.raises(ValueError, match="y, z|z"):
        require_populated(df, ["x", "y", "z"])
    with pytest.raises(ValueError, match="y"):
        require_populated(df, ["x", "y"])


def test_generated_methods_of_the_transform_stay_compiled(spark, sf_dir):
    """The JVM interprets methods of over 8,000 bytes."""
    import re

    from tillflow.operators.transform import transform_sales
    from tillflow.sources.order_lines import raw_sales

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        raw = raw_sales(spark, sf_dir)
        plan = transform_sales(raw, carry=["feed_position"])._jdf.queryExecution()
        code = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenString(
            plan.executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) <= 8000


def test_texts_that_are_no_numbers(spark):
    texts = [".", "1.2.3", "", None, "n/a", "1.", ".5", "(3)", "1,234.50"]
    assert apply(spark, clean_number, texts) == [None] * 5 + [1.0, 0.5, 3.0, 1234.5]
