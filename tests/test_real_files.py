"""Files as stores write them: doubled quotes, backslashes, mixed encodings, late rows."""

import datetime as dt

from pyspark.sql import functions as F

from tillflow.functions.dates import parse_date
from tillflow.plans.load import load_sales
from tillflow.schemas import POSITION
from tillflow.sources.sales_files import map_master_columns, read_sales_csv
from tillflow.sources.tables import SavedTables
from tillflow.streaming.landing import land_sales

HEADER = "STORE_NAME,ITEM_CODE,ITEM_NAME,QTY,SALES_PRE_VAT,Date,RRP\n"


def test_doubled_quotes_and_backslashes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEADER + 's1,k1,"Pizza 12"", large",5,10.00,2024-01-01,2\n'
                    's1,k2,"path C:\\",6,11.00,2024-01-01,2\n')
    rows = read_sales_csv(spark, str(path)).orderBy("ITEM_CODE").collect()
    assert [(r.ITEM_NAME, r.QTY) for r in rows] == [('Pizza 12", large', "5"), ("path C:\\", "6")]


def test_encodings_are_told_by_bytes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_bytes((HEADER + "Café �,k1,x,1,1,2024-01-01,1\n").encode())
    (folder / "b.csv").write_bytes((HEADER + "Cafè,k2,x,1,1,2024-01-01,1\n").encode("latin-1"))
    rows = read_sales_csv(spark, str(folder)).collect()
    assert {r.STORE_NAME for r in rows} == {"Café �", "Cafè"}
    tables = SavedTables(spark, str(tmp_path / "tables"))
    tables.create()
    land_sales(tables, str(folder), str(tmp_path / "progress")).awaitTermination()
    assert {r.store_id for r in tables.read("fact_sales").collect()} == {"Café �", "Cafè"}


def _load(spark, tables, rows, **options):
    raw = spark.createDataFrame(rows, "STORE_NAME string, ITEM_CODE string, ITEM_NAME string, "
                                      "QTY string, SALES_PRE_VAT string, Date string, RRP string")
    raw = raw.withColumn(POSITION, F.monotonically_increasing_id())
    return load_sales(tables, raw, "9", loaded_at=dt.datetime(2024, 3, 1), **options)


def test_no_row_vanishes(spark, tmp_path):
    tables = SavedTables(spark, str(tmp_path / "tables"))
    tables.create()
    _load(spark, tables, [("s", "k", "x", "1", "1", "2024-02-10", "1"),
                          ("s", "k", "x", "1", "1", "9999-01-01", "1")])
    assert tables.watermark() == dt.date(2024, 2, 10)
    late = [("s", "k", "x", "2", "1", "2024-01-01", "1"), ("s", "k", "x", "2", "1", "no", "1"),
            ("s", "k", "x", "2", "1", "2024-02-20", "1")]
    result = _load(spark, tables, late, process_type="incremental")
    assert (result.loaded, result.rejected, result.skipped) == (1, 1, 1)
    assert '"Date":"no"' in result.rejects.first()["raw_row"]
    result = _load(spark, tables, late[:1], process_type="full")
    assert (result.loaded, result.rejected, result.skipped) == (1, 0, 0)
    assert tables.watermark() == dt.date(2024, 2, 20)


def test_dates_with_time_and_other_marks(spark):
    texts = ["2024-01-05 00:00:00", "2024/01/05", "05-01-2024", "05/01/2024", "2024-01-05T10:30",
             "2024-02-30", "5 Jan", "2024-01/x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in rows.select(parse_date(F.col("t"))).collect()]
    assert found == [dt.date(2024, 1, 5)] * 5 + [None] * 3


def test_master_is_trimmed_of_all_white_space(spark):
    sheet = spark.createDataFrame([("\tA1 ", "n")], "CODE string, NAME string")
    assert map_master_columns(sheet).first()["sku_id"] == "A1"
