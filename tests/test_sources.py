import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillflow.operators.transform import transform_sales
from tillflow.schemas import TABLES, conform, union_evolved
from tillflow.sources.report_files import save_reports
from tillflow.sources.sales_files import (discover_master_files, discover_sales_files,
                                          distinct_headers, read_master_csv,
                                          read_master_parquet, read_sales_csv)
from tillflow.sources.tables import SavedTables, describe_catalog

BODY = "s1,i1,5,10.00,2024-01-05\n"
HEAD = "STORE_NAME,ITEM_CODE,QTY,SALES_PRE_VAT,Date\n"


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df):
    return [tuple(r) for r in df.drop("file_position").collect()]


def test_bom_and_blank_headers(spark, tmp_path):
    path = write(tmp_path / "a.csv", "﻿STORE_NAME , ITEM_CODE,QTY \n s1,i1,NA\n")
    df = read_sales_csv(spark, path)
    assert df.columns == ["STORE_NAME", "ITEM_CODE", "QTY", "file_position"]
    assert rows(df) == [(" s1", "i1", None)]


def test_latin1_files_are_found_one_by_one(spark, tmp_path):
    write(tmp_path / "a.csv", HEAD + "café,i1,1,1,2024-01-05\n")
    write(tmp_path / "b b.csv", HEAD + "crème,i1,1,1,2024-01-05\n", "latin-1")
    names = {r[0] for r in rows(read_sales_csv(spark, str(tmp_path)))}
    assert names == {"café", "crème"}
    only = read_sales_csv(spark, str(tmp_path / "b b.csv"))
    assert [r[0] for r in rows(only)] == ["crème"]
    assert [r[0] for r in rows(read_sales_csv(spark, str(tmp_path / "b b.csv"), "ISO-8859-1"))] \
        == ["crème"]


def test_latin1_header(spark, tmp_path):
    path = write(tmp_path / "a.csv", "STORE_NAME,NOMÉ\ns,é\n", "latin-1")
    df = read_sales_csv(spark, path)
    assert df.columns[1] == "NOMÉ" and rows(df) == [("s", "é")]


def test_headers_equal_up_to_case(spark, tmp_path):
    assert distinct_headers(["Date", "DATE", "x"]) == ["Date", "DATE_2", "x"]
    df = read_sales_csv(spark, write(tmp_path / "a.csv", "Date,DATE\n1,2\n"))
    assert df.columns[:2] == ["Date", "DATE_2"] and rows(df) == [("1", "2")]


def test_another_column_order_is_refused(spark, tmp_path):
    write(tmp_path / "a.csv", HEAD + BODY)
    write(tmp_path / "b.csv", "ITEM_CODE,STORE_NAME,QTY,SALES_PRE_VAT,Date\n" + BODY)
    with pytest.raises(Exception, match="(?i)header"):
        read_sales_csv(spark, str(tmp_path), "UTF-8").collect()


def test_header_only_and_empty_files(spark, tmp_path):
    df = read_sales_csv(spark, write(tmp_path / "a.csv", HEAD))
    assert df.count() == 0 and transform_sales(df).count() == 0
    with pytest.raises(ValueError, match="no header"):
        read_sales_csv(spark, write(tmp_path / "b.csv", ""))


def test_full_layout_and_position_order(spark, tmp_path):
    heading = ("STORE_NAME,ITEM_CODE,ITEM_NAME,CATEGORY,DEPARTMENT,QTY,COST,SALES_PRE_VAT,"
               "SUPPLIER_NAME,Date,RRP,PRICE,TRANS_DATE,PROMO_FLAG,STOCK_LEVEL,STOCK")
    lines = "".join(",".join([f"s{i}"] + ["x"] * 15) + "\n" for i in range(50))
    path = write(tmp_path / "a.csv", f"{heading}\n{lines}")
    df = read_sales_csv(spark, path)
    ordered = [r[0] for r in df.orderBy("file_position").collect()]
    assert ordered == [f"s{i}" for i in range(50)]


def test_discovery(spark, tmp_path):
    for name in ("sales_a.csv", "b.csv", "Master_list.csv", "master.csv", "note.txt"):
        write(tmp_path / name, HEAD + BODY)
    found = [p.rsplit("/", 1)[-1] for p in discover_sales_files(spark, str(tmp_path))]
    assert found == ["b.csv", "sales_a.csv"]
    masters = [p.rsplit("/", 1)[-1] for p in discover_master_files(spark, str(tmp_path))]
    assert masters == ["Master_list.csv", "master.csv"]


def test_master_sheets(spark, tmp_path):
    text = "CODE,NAME,CATEGORY,DEPARTMENT,SUB DEPARTMENT,MICRO DEPARTMENT,Brand,VAT,SUPPLIER\n" \
           "1, Milk ,Dairy,Food,Cold,Milk,Acme,20,Sup\n"
    df = read_master_csv(spark, write(tmp_path / "master.csv", text))
    assert df.select("sku_id", "sku_name", "micro_department", "vat_rate").first() \
        == ("1", "Milk", "Milk", "20")
    spark.createDataFrame([("1", " Milk ")], "CODE string, NAME string").write.parquet(
        str(tmp_path / "m"))
    assert read_master_parquet(spark, str(tmp_path / "m")).first() == ("1", "Milk")


def test_create_is_repeatable(spark, tmp_path):
    tables = SavedTables(spark, str(tmp_path / "t"))
    tables.create(dt.date(2024, 1, 1))
    tables.create(dt.date(2025, 1, 1))
    assert [tuple(r) for r in tables.read("dim_retailer").collect()] \
        == [("DEFAULT", "Default Retailer", dt.date(2024, 1, 1))]
    assert tables.read("fact_sales").count() == 0 and tables.watermark() is None
    assert set(tables.star()) == set(TABLES)


def test_evolution(spark):
    old = spark.createDataFrame([("a", 1)], "store_id string, units_sold int")
    fact = conform(old, TABLES["fact_sales"])
    assert fact.columns == TABLES["fact_sales"].names
    assert fact.first().units_sold == 1 and fact.first().cost is None
    both = union_evolved(fact, old.withColumn("channel", F.lit("web")))
    assert both.columns[-1] == "channel" and both.count() == 2
    assert conform(both, TABLES["fact_sales"]).columns[-1] == "channel"


def test_catalog(spark, star):
    from tillflow.plans.views import VIEW_SQL, create_views, view_frame

    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    star.register("shop")
    assert create_views(spark, "shop") == list(VIEW_SQL)
    assert create_views(spark, "shop") == list(VIEW_SQL)
    listed = describe_catalog(spark, "shop")
    kinds = {r.table_name: r.table_type for r in listed.collect()}
    assert {k for k, v in kinds.items() if v == "VIEW"} == set(VIEW_SQL)
    assert set(TABLES) <= set(kinds)
    for name in VIEW_SQL:
        ours = view_frame(spark, name, star.star())
        saved = spark.table(f"shop.{name}")
        assert saved.columns == ours.columns
        assert saved.exceptAll(ours).isEmpty() and ours.exceptAll(saved).isEmpty()


def test_temporary_views_lie_in_no_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS corner")
    spark.sql("CREATE TABLE IF NOT EXISTS corner.t (a int) USING parquet")
    spark.range(1).createOrReplaceTempView("passing")
    try:
        assert [r.table_name for r in describe_catalog(spark, "corner").collect()] == ["t"]
    finally:
        spark.catalog.dropTempView("passing")
        spark.sql("DROP TABLE corner.t")


def test_report_files_skip_empty(spark, tmp_path):
    full = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5))], "a int, t timestamp")
    counts = save_reports({"full": full, "none": full.filter("a > 1")}, str(tmp_path))
    assert counts == {"full": 1, "none": 0}
    assert not (tmp_path / "none").exists()
    back = spark.read.csv(str(tmp_path / "full"), header=True).first()
    assert back.a == "1" and back.t == "2024-01-01T05:00:00.000"
