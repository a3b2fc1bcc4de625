import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.operators import dimensions as dims
from tillflow.operators.calendar import missing_days
from tillflow.operators.facts import (latest_per_key, load_summary, newer_than,
                                      require_fact_columns, split_references)
from tillflow.operators.freshness import date_column, freshness
from tillflow.operators.merge import greatest_leads, keep_one, leading_rows
from tillflow.plans.load import load_sales, reject_counts
from tillflow.schemas import DIM_SKU, DIM_STORE, FACT_KEY, TABLES, conform
from tillflow.sources.sales_files import map_master_columns, read_sales_csv
from tillflow.sources.tables import SavedTables
from tillflow.streaming.landing import land_sales

T1, T2 = dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 2, 1, 8)
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
BATCH = ("retailer_id string, store_id string, sku_id string, date date, units_sold int, "
         "sales_value decimal(12,2), stock_level int, promo_active boolean, "
         "price decimal(10,2), cost decimal(10,2), seq int")


def fact_rows(spark, *rows):
    """Rows of (store, sku, day, units, seq)."""
    one = Decimal("1.00")
    return spark.createDataFrame(
        [("r", st, sk, d, u, one, 1, False, one, one, q) for st, sk, d, u, q in rows], BATCH)


def units(df):
    return {(r.store_id, r.sku_id, r.date): r.units_sold for r in df.collect()}


def test_keep_one(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 5, "z")],
                               "k string, seq int, v string")
    assert sorted(map(tuple, keep_one(df, ["k"], "seq", "last").collect())) \
        == [("a", None), ("b", "z")]
    assert sorted(map(tuple, keep_one(df, ["k"], "seq", "first").collect())) \
        == [("a", "x"), ("b", "z")]


def test_rows_that_may_be_the_last(spark):
    order = "struct<a:int,b:string>"
    rows = [("a", "x", (1, "p"), 1), ("a", "x", (2, "p"), 2), ("a", "x", (2, "q"), 3),
            ("a", "x", None, 4), (None, "x", (None, "r"), 5), (None, "x", None, 6), ("b", "y", (7, None), 7)]
    df = spark.createDataFrame(rows, f"k string, l string, seq {order}, v int")
    leads = greatest_leads(df, ["k", "l"], "seq")
    kept = leading_rows(df, leads, ["k", "l"], "seq")
    assert kept.columns == df.columns
    assert sorted(r.v for r in kept.collect()) == [2, 3, 5, 6, 7]
    whole, few = (keep_one(d, ["k", "l"], "seq", "last") for d in (df, kept))
    assert few.exceptAll(whole).isEmpty() and whole.exceptAll(few).isEmpty()
    assert greatest_leads(df, ["k"], "l") is None


def test_large_batch_sorts_the_rows_that_may_be_the_last(spark, tmp_path, monkeypatch):
    """Over FEW_ROWS rows of few keys: copies go before they are sorted, ties of the lead stay."""
    monkeypatch.setattr("tillflow.sources.tables.FEW_ROWS", 3)
    seen = []
    monkeypatch.setattr("tillflow.sources.tables.latest_per_key", lambda batch, order: (
        seen.append(batch.count()), latest_per_key(batch, order))[1])
    tables = SavedTables(spark, str(tmp_path))
    tables.create()
    tables.upsert_fact(fact_rows(
        spark, *[("s", "a", D1, k, k) for k in range(20)], ("s", "b", D1, 70, 1)), "seq", D1)
    assert units(tables.read("fact_sales")) == {("s", "a", D1): 19, ("s", "b", D1): 70}
    assert seen == [2]


def test_upsert_properties(spark, tmp_path):
    tables = SavedTables(spark, str(tmp_path))
    tables.create()
    first = fact_rows(spark, ("s", "a", D1, 1, 1), ("s", "a", D2, 2, 2), ("s", "b", D1, 3, 3))
    tables.upsert_fact(first, "seq", D1)
    second = fact_rows(spark, ("s", "a", D1, 10, 1), ("s", "a", D1, 11, 2), ("t", "a", D3, 5, 3))
    tables.upsert_fact(second, "seq", D3)
    expected = {("s", "a", D1): 11, ("s", "b", D1): 3, ("s", "a", D2): 2, ("t", "a", D3): 5}
    assert units(tables.read("fact_sales")) == expected
    # The first load date stays, also for replaced rows.
    loaded = {(r.store_id, r.sku_id, r.date): r.created_at
              for r in tables.read("fact_sales").collect()}
    assert loaded[("s", "a", D1)] == D1 and loaded[("t", "a", D3)] == D3
    # Applying a batch twice is applying it once.
    tables.upsert_fact(second, "seq", D3)
    assert units(tables.read("fact_sales")) == expected
    assert tables.read("fact_sales").groupBy(FACT_KEY).count().filter("count > 1").isEmpty()


def test_upsert_leaves_other_days_untouched(spark, tmp_path):
    tables = SavedTables(spark, str(tmp_path))
    tables.create()
    tables.upsert_fact(fact_rows(spark, ("s", "a", D1, 1, 1), ("s", "a", D2, 2, 2)), "seq")
    day = tmp_path / "fact_sales" / f"date={D1}"
    before = sorted(p.name for p in day.iterdir())
    tables.upsert_fact(fact_rows(spark, ("s", "a", D2, 7, 1)), "seq")
    assert sorted(p.name for p in day.iterdir()) == before
    assert units(tables.read("fact_sales")) == {("s", "a", D1): 1, ("s", "a", D2): 7}


def test_upsert_reads_only_the_days_it_changes(spark, star):
    days = [dt.date(1999, 1, 5), dt.date(1999, 1, 9)]
    current = star.read("fact_sales").filter(F.col("date").isin(days))
    read = {path.split("date=")[1][:10] for path in
            (r[0] for r in current.select("_metadata.file_path").distinct().collect())}
    assert read == {str(d) for d in days}
    plan = current._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_filters(spark):
    batch = fact_rows(spark, ("s", "a", D1, 1, 1), ("s", "a", D2, 2, 2))
    assert newer_than(batch, D1).count() == 1
    assert newer_than(batch, D1, "full").count() == 2 == newer_than(batch, None).count()
    with pytest.raises(ValueError):
        newer_than(batch, D1, "half")
    with pytest.raises(ValueError, match="price"):
        require_fact_columns(batch.drop("price"))


def test_references_with_null_keys(spark):
    sku = spark.createDataFrame([("a",)], "sku_id string")
    store = spark.createDataFrame([("s",)], "store_id string")
    batch = fact_rows(spark, ("s", "a", D1, 1, 1), ("s", "zz", D1, 1, 2), ("zz", "a", D1, 1, 3),
                      ("zz", "zz", D1, 1, 4), ("s", None, D1, 1, 5), (None, "a", D1, 1, 6))
    good, bad = split_references(batch, sku, store)
    assert good.count() == 1
    assert {(r.seq, r.reject_reason) for r in bad.collect()} == {
        (2, "unknown_sku"), (3, "unknown_store"), (4, "unknown_sku"), (5, "unknown_sku"),
        (6, "unknown_store")}


def test_sku_precedence(spark):
    current = conform(spark.createDataFrame([("a", "Old", None), ("b", "Keep", None)],
                                            "sku_id string, sku_name string, brand string"),
                      DIM_SKU)
    master = spark.createDataFrame(
        [("a", "New", None, 1), ("a", "Later", "B", 2), ("c", "Add", "C", 3)],
        "sku_id string, sku_name string, brand string, seq int")
    merged = dims.merge_skus_from_master(current, master, "seq", T1)
    byid = {r.sku_id: r for r in merged.collect()}
    assert byid["a"].sku_name == "New" and byid["a"].brand is None
    assert byid["b"].sku_name == "Keep" and byid["b"].updated_at is None
    assert byid["c"].created_at == T1 == byid["c"].updated_at
    sales = spark.createDataFrame(
        [("a", Decimal("1.00"), 1), ("a", Decimal("2.00"), 2), ("d", Decimal("3.00"), 3)],
        "sku_id string, cost decimal(10,2), seq int")
    filled = {r.sku_id: r for r in dims.merge_skus_from_sales(merged, sales, "seq", T2).collect()}
    assert filled["a"].sku_name == "New" and filled["a"].cost == Decimal("2.00")
    assert filled["a"].brand == "Unknown" and filled["a"].updated_at == T2
    assert filled["b"].brand is None
    assert (filled["d"].sku_name, filled["d"].rrp, filled["d"].created_at) \
        == ("Unknown SKU", Decimal("0.00"), T2)


def test_store_merges(spark):
    current = conform(spark.createDataFrame([("s", "Main")], "store_id string, store_name string"),
                      DIM_STORE)
    sales = fact_rows(spark, ("s", "a", D1, 1, 1), ("t", "a", D1, 1, 2))
    byid = {r.store_id: r for r in dims.merge_stores_from_sales(current, sales, T1).collect()}
    assert byid["s"].store_name == "Main" and byid["t"].store_name == "t"
    assert byid["t"].region == "Unknown"
    sheet = spark.createDataFrame([("s", "New", "North", 1)],
                                  "store_id string, store_name string, region string, seq int")
    row = dims.merge_stores_from_master(current, sheet, "seq", T1).first()
    assert (row.store_name, row.region) == ("New", "North")


def test_generic_upsert_counts(spark):
    current = conform(spark.createDataFrame([], "store_id string"), DIM_STORE)
    rows = spark.createDataFrame([(" s ", " A ", 1), ("s", "B", 2), ("", "C", 3), (None, "D", 4)],
                                 "store_id string, store_name string, seq int")
    merged, counts = dims.upsert_dimension(current, rows, DIM_STORE, "store_id",
                                           ["store_name", "area"], "seq", T1)
    assert [(r.store_id, r.store_name) for r in merged.collect()] == [("s", "B")]
    assert tuple(counts.first()) == (2, 2)


def test_master_variants(spark):
    sheet = spark.createDataFrame(
        [("a", " A1 ", "c", "d", "s", "m", "b", "0", "x", 1),
         ("a", "A2", None, "d2", "s", "m", "b", "0", "x", 2),
         ("n", "N", "c", "d", "s", "m", "b", "0", "x", 3)],
        "CODE string, NAME string, CATEGORY string, DEPARTMENT string, `SUB DEPARTMENT` string, "
        "`MICRO DEPARTMENT` string, Brand string, VAT string, SUPPLIER string, seq int")
    master = map_master_columns(sheet)
    replaced = {r.sku_id: r.sku_name for r in dims.replace_skus(master, "seq").collect()}
    assert replaced == {"a": "A1", "n": "N"}
    current = spark.createDataFrame([("a", "old", "oldc", "oldd"), ("z", "z", "z", "z")],
                                    "sku_id string, sku_name string, category string, "
                                    "department string")
    enriched = {r.sku_id: tuple(r)[1:] for r in dims.enrich_skus(current, master, "seq").collect()}
    assert enriched == {"a": ("A2", "oldc", "d2"), "z": ("z", "z", "z")}


def test_retailers(spark):
    none = spark.createDataFrame([], TABLES["dim_retailer"])
    once = dims.ensure_retailer(none, "7", created_at=D1)
    twice = dims.ensure_retailer(once, "7", created_at=D2)
    assert [tuple(r) for r in twice.collect()] == [("7", "Retailer 7", D1)]
    assert dims.seed_retailer(twice).count() == 2


def test_missing_days(spark):
    fact = spark.createDataFrame([(D1,), (D3,)], "date date")
    known = spark.createDataFrame([(D2,)], "date date")
    rows = sorted(missing_days(fact, known).collect())
    assert [r.date for r in rows] == [D1, D3]
    assert tuple(rows[0])[1:] == (1, "Monday", 1, 1, "January", 1, 2024, False)
    assert missing_days(fact.filter("date is null"), known).count() == 0


def test_freshness(spark):
    fact = spark.createDataFrame([("x", dt.date(2024, 1, 4))], "store string, date date")
    friday, saturday = dt.datetime(2024, 1, 5, 9), dt.datetime(2024, 1, 6, 9)
    assert tuple(freshness(fact, friday).first()) == (dt.date(2024, 1, 4), 33.0, True, True)
    assert freshness(fact, dt.datetime(2024, 1, 5)).first().stale is False
    assert freshness(fact, saturday).first().stale is False
    none = freshness(fact.filter("store = 'y'"), friday).first()
    assert none.last_load is None and none.stale is True
    assert date_column(fact) == "date"
    with pytest.raises(ValueError):
        date_column(fact.select("store"))


def test_summary_of_nothing(spark):
    row = load_summary(fact_rows(spark).limit(0)).first()
    assert row.total_records == 0 and row.first_date is None


HEAD = "STORE_NAME,ITEM_CODE,QTY,SALES_PRE_VAT,Date,RRP,STOCK,PROMO_FLAG\n"
FILE_1 = HEAD + "s1,a,5,50,2024-01-01,10,3,Y\ns1,a,6,60,2024-01-01,10,3,Y\n" \
    "s2,b,1,9,02/01/2024,9,0,N\n,b,1,9,2024-01-01,9,0,N\ns1,a,1,9,nope,9,0,N\n"
FILE_2 = HEAD + "s1,a,8,80,2024-01-01,10,3,Y\ns3,c,2,20,2024-01-03,10,3,\n"


def test_load_sales(spark, tmp_path):
    (tmp_path / "a.csv").write_text(FILE_1)
    (tmp_path / "b.csv").write_text(FILE_2)
    tables = SavedTables(spark, str(tmp_path / "t"))
    tables.create()
    result = load_sales(tables, read_sales_csv(spark, str(tmp_path / "a.csv")), "9", loaded_at=T1)
    assert (result.loaded, result.rejected) == (3, 2)
    assert {tuple(r) for r in reject_counts(result.rejects).collect()} == {
        ("missing_key", 1), ("invalid_date", 1)}
    assert units(tables.read("fact_sales")) == {("s1", "a", D1): 6, ("s2", "b", D2): 1}
    assert tables.watermark() == D2
    assert {r.retailer_id for r in tables.read("dim_retailer").collect()} == {"DEFAULT", "9"}
    assert tables.read("dim_time").count() == 2
    assert {r.sku_id for r in tables.read("dim_sku").collect()} == {"a", "b"}
    # Incremental: the late correction of day 1 stays out; a full load takes it.
    second = read_sales_csv(spark, str(tmp_path / "b.csv"))
    assert load_sales(tables, second, "9", loaded_at=T2).loaded == 1
    assert units(tables.read("fact_sales"))[("s1", "a", D1)] == 6
    load_sales(tables, second, "9", loaded_at=T2, process_type="full")
    assert units(tables.read("fact_sales"))[("s1", "a", D1)] == 8
    assert tables.watermark() == D3
    # Nothing to load: nothing changes.
    header_only = tmp_path / "c.csv"
    header_only.write_text(HEAD)
    assert load_sales(tables, read_sales_csv(spark, str(header_only)), "9").loaded == 0


def test_load_refuses_an_empty_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + "s1,,5,50,2024-01-01,10,3,Y\n")
    tables = SavedTables(spark, str(tmp_path / "t"))
    tables.create()
    with pytest.raises(ValueError, match="sku_id"):
        load_sales(tables, read_sales_csv(spark, str(tmp_path / "a.csv")), "9")


def test_load_refuses_a_file_without_quantities(spark, tmp_path):
    (tmp_path / "a.csv").write_text("STORE_NAME,ITEM_CODE,SALES_PRE_VAT,Date\ns1,a,5,2024-01-01\n")
    tables = SavedTables(spark, str(tmp_path / "t"))
    tables.create()
    with pytest.raises(ValueError, match="QTY"):
        load_sales(tables, read_sales_csv(spark, str(tmp_path / "a.csv")), "9")
    assert tables.read("fact_sales").isEmpty()


def test_added_columns_survive_later_upserts(spark, tmp_path):
    tables = SavedTables(spark, str(tmp_path))
    tables.create()
    first = fact_rows(spark, ("s", "a", D1, 1, 1), ("s", "b", D1, 2, 2))
    tables.upsert_fact(first.withColumn("channel", F.lit("web")), "seq", D1)
    tables.upsert_fact(fact_rows(spark, ("s", "a", D1, 9, 1), ("s", "c", D1, 3, 2)), "seq", D2)
    tables.upsert_fact(fact_rows(spark, ("s", "b", D1, 4, 1)).withColumn("till", F.lit(5)), "seq")
    rows = {r.sku_id: (r.units_sold, r.channel, r.till) for r in tables.read("fact_sales").collect()}
    assert rows == {"a": (9, "web", None), "b": (4, "web", 5), "c": (3, None, None)}
    assert tables.watermark() is None


def test_load_with_master_and_closed_dimensions(spark, tmp_path):
    (tmp_path / "a.csv").write_text(FILE_1)
    tables = SavedTables(spark, str(tmp_path / "t"))
    tables.create()
    master = spark.createDataFrame(
        [("a", "Apple", "s1", "Main", 1)],
        "sku_id string, sku_name string, store_id string, store_name string, file_position int")
    result = load_sales(tables, read_sales_csv(spark, str(tmp_path / "a.csv")), "9",
                        master=master, loaded_at=T1, add_unknown=False)
    assert (result.loaded, result.rejected) == (2, 3)
    assert units(tables.read("fact_sales")) == {("s1", "a", D1): 6}
    assert tables.read("dim_sku").first().sku_name == "Apple"
    assert tables.read("dim_store").first().store_name == "Main"


def test_stream_lands_like_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    stream, batch = (SavedTables(spark, str(tmp_path / n)) for n in ("stream", "batch"))
    stream.create(), batch.create()
    for name, text in (("a.csv", FILE_1), ("b.csv", FILE_2)):
        (landing / name).write_text(text)
        query = land_sales(stream, str(landing), str(tmp_path / "progress"), retailer_id="9",
                           loaded_at=T1)
        query.awaitTermination()
        load_sales(batch, read_sales_csv(spark, str(landing / name)), "9", loaded_at=T1,
                   process_type="full")
    ours, theirs = stream.read("fact_sales"), batch.read("fact_sales")
    assert ours.count() == 3
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    assert stream.watermark() == batch.watermark() == D3
    kept = spark.read.parquet(stream.path("quarantine"))
    assert {r.load_id for r in kept.collect()} == {f"stream-{query.id}-0"} and kept.count() == 2
    # Without a new file nothing happens.
    land_sales(stream, str(landing), str(tmp_path / "progress"), retailer_id="9",
               loaded_at=T2).awaitTermination()
    assert units(stream.read("fact_sales")) == units(ours)


def test_a_far_date_does_not_stop_later_loads_without_loaded_at(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(HEAD + "s1,a,5,50,9999-01-01,10,3,Y\ns1,a,5,50,2024-01-01,10,3,Y\n")
    (tmp_path / "b.csv").write_text(FILE_2)
    batch, stream = (SavedTables(spark, str(tmp_path / n)) for n in ("batch", "stream"))
    batch.create(), stream.create()
    assert load_sales(batch, read_sales_csv(spark, str(landing / "a.csv")), "9").loaded == 2
    land_sales(stream, str(landing), str(tmp_path / "progress"), retailer_id="9").awaitTermination()
    for tables in (batch, stream):
        assert tables.watermark() == D1
        result = load_sales(tables, read_sales_csv(spark, str(tmp_path / "b.csv")), "9")
        assert (result.loaded, result.skipped) == (1, 1)
        assert units(tables.read("fact_sales"))[("s3", "c", D3)] == 2
        assert tables.watermark() == D3
        # The clock bounds the mark and stamps nothing.
        assert tables.read("fact_sales").where("created_at IS NOT NULL").isEmpty()
        assert tables.read("etl_metadata").first().updated_at is None
