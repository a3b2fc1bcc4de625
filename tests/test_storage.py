"""Versions, commits, day totals and bitmaps of the saved tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tillflow.operators.day_totals import day_rows, distinct_skus, store_bitmaps, with_codes
from tillflow.operators.dimensions import merge_stores_from_master, merge_stores_from_sales
from tillflow.operators.facts import WATERMARK, merge_fact, merge_few
from tillflow.operators.ranking import row_numbers
from tillflow.plans import reports
from tillflow.plans.views import view_frame
from tillflow.schemas import ETL_METADATA, SKU_CODES, TABLES, conform, evolved, wider
from tillflow.sources.commits import CommitLog, Conflict
from tillflow.sources.tables import SavedTables

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 2, 3)
T1 = dt.datetime(2024, 3, 1, 8)


@pytest.fixture
def tables(spark, tmp_path):
    made = SavedTables(spark, str(tmp_path / "t"))
    made.create()
    return made


def stores(spark, *names):
    rows = [(n, n.upper()) for n in names]
    return conform(spark.createDataFrame(rows, "store_id string, store_name string"),
                   TABLES["dim_store"])


def ids(df):
    return sorted(r.store_id for r in df.collect())


def fact(spark, *rows):
    one = Decimal("1.00")
    return spark.createDataFrame(
        [("r", st, sk, d, u, one * u, 1, u % 2 == 0, one, one, 1) for st, sk, d, u in rows],
        "retailer_id string, store_id string, sku_id string, date date, units_sold int, "
        "sales_value decimal(12,2), stock_level int, promo_active boolean, "
        "price decimal(10,2), cost decimal(10,2), seq int")


# Versions

def test_a_reader_keeps_its_version(spark, tables):
    tables.replace("dim_store", stores(spark, "a"))
    before = tables.read("dim_store")
    path = tables.path("dim_store")
    assert tables.replace("dim_store", stores(spark, "a", "b"))
    assert ids(before) == ["a"] and ids(tables.read("dim_store")) == ["a", "b"]
    assert tables.path("dim_store") != path
    # A version may be made of itself, and of several before it.
    for name in "cdefg":
        tables.replace("dim_store", tables.read("dim_store").unionByName(stores(spark, name)))
    assert ids(tables.read("dim_store")) == list("abcdefg")


def test_superseded_versions_go(spark, tables, tmp_path):
    for n in range(8):
        tables.replace("dim_store", stores(spark, *"abcdefgh"[:n + 1]))
    left = [p for p in (tmp_path / "t" / "dim_store").iterdir() if p.name.startswith("version-")]
    assert len(left) <= 4 and ids(tables.read("dim_store")) == list("abcdefgh")


def test_the_same_content_is_not_written(spark, tables, tmp_path):
    rows = stores(spark, "a", "b").withColumn("updated_at", F.lit(T1).cast("timestamp"))
    assert tables.replace("dim_store", rows)
    number = tables.log.head()[0]
    later = rows.orderBy(F.desc("store_id")).withColumn(
        "updated_at", F.lit(dt.datetime(2025, 1, 1)).cast("timestamp"))
    assert not tables.replace("dim_store", later)
    assert tables.log.head()[0] == number
    assert tables.read("dim_store").first().updated_at == T1
    # Null and text change places: another content.
    swapped = rows.withColumns({"region": F.lit("x")})
    assert tables.replace("dim_store", swapped)
    assert tables.replace("dim_store", rows.withColumns({"area": F.lit("x")}))


def test_all_tables_change_in_one_commit(spark, tables):
    number = tables.log.head()[0]
    sku = conform(spark.createDataFrame([("k",)], "sku_id string"), TABLES["dim_sku"])
    changed = tables.replace_all({"dim_store": stores(spark, "a"), "dim_sku": sku,
                                  "dim_retailer": tables.read("dim_retailer")})
    assert sorted(changed) == ["dim_sku", "dim_store"]
    assert tables.log.head()[0] == number + 1


def test_a_table_replaced_by_another_writer_is_not_overwritten(spark, tables):
    other = SavedTables(spark, tables.root)
    tables.read("dim_store"), other.read("dim_store")
    assert other.replace("dim_store", stores(spark, "theirs"))
    with pytest.raises(RuntimeError, match="another writer"):
        tables.replace("dim_store", stores(spark, "ours"))
    assert ids(tables.read("dim_store")) == ["theirs"]
    assert tables.replace("dim_store", tables.read("dim_store").unionByName(stores(spark, "ours")))


def test_tables_of_plain_folders_are_taken_over(spark, tmp_path):
    root = str(tmp_path / "old")
    stores(spark, "a").write.parquet(f"{root}/dim_store")
    spark.createDataFrame([(WATERMARK, str(D2), None)], ETL_METADATA).write.parquet(
        f"{root}/etl_metadata")
    tables = SavedTables(spark, root)
    tables.create()
    assert ids(tables.read("dim_store")) == ["a"] and tables.watermark() == D2
    tables.replace("dim_store", tables.read("dim_store").unionByName(stores(spark, "b")))
    assert ids(tables.read("dim_store")) == ["a", "b"]


# State

def mark(spark, day):
    return spark.createDataFrame([(WATERMARK, str(day), T1)], ETL_METADATA)


def test_one_of_two_commits_on_one_base_fails(spark, tmp_path):
    log, other = (CommitLog(spark, str(tmp_path / "log")) for _ in range(2))
    assert log.head() == (-1, {})
    assert log.commit(-1, {"n": 1}) == 0
    with pytest.raises(Conflict):
        other.commit(-1, {"n": 2})
    assert other.head() == (0, {"n": 1}) and other.commit(0, {"n": 2}) == 1
    # What a writer has not finished does not count.
    (tmp_path / "log" / f"{2:020d}.json").write_text('{"n": ')
    assert log.head() == (1, {"n": 2})


def test_writers_keep_the_greater_mark(spark, tables, monkeypatch):
    other = SavedTables(spark, tables.root)
    commit, between = tables.log.commit, []

    def after_another(base, content):
        if not between:
            between.append(1)
            other.set_watermark(mark(spark, D3))
        return commit(base, content)

    monkeypatch.setattr(tables.log, "commit", after_another)
    tables.set_watermark(mark(spark, D2))
    assert between and tables.watermark() == D3


def test_replay_and_withdrawal(spark, tables):
    for day in (D1, D2, dt.date(2924, 1, 1)):
        tables.set_watermark(mark(spark, day))
    history = tables.state_history().where(F.col("key") == WATERMARK).orderBy("number").collect()
    assert [r.mark for r in history] == [D1, D2, dt.date(2924, 1, 1)]
    # Replaying the log gives the present state.
    assert history[-1].mark == tables.watermark()
    assert tables.withdraw_watermark() == D2 and tables.watermark() == D2
    tables.set_watermark(mark(spark, D3))
    assert tables.watermark() == D3 and tables.withdraw_watermark() == D2
    assert tables.withdraw_watermark() == D1
    assert tables.withdraw_watermark() is None and tables.watermark() is None


# Evolution

def test_widening():
    def check(a, b, expected):
        kinds = [T.StructType.fromDDL(f"x {k}")[0].dataType for k in (a, b, expected)]
        assert wider(kinds[0], kinds[1]) == wider(kinds[1], kinds[0]) == kinds[2]

    check("int", "bigint", "bigint")
    check("int", "decimal(10,2)", "decimal(12,2)")
    check("decimal(30,2)", "decimal(20,18)", "double")
    check("bigint", "double", "double")
    check("date", "timestamp", "timestamp")
    check("date", "int", "string")
    check("boolean", "string", "string")
    base = T.StructType.fromDDL("a int")
    assert evolved(base, T.StructType.fromDDL("b int"), T.StructType.fromDDL("b bigint")) \
        == T.StructType.fromDDL("a int, b bigint")


def test_added_dimension_columns_survive_merges(spark, tables):
    tables.replace("dim_store", stores(spark, "s"))
    tables.add_columns("dim_store", "floor int")
    assert tables.read("dim_store").first().floor is None
    sheet = spark.createDataFrame([("s", 3, 1), ("t", 4, 2)], "store_id string, floor int, seq int")
    tables.replace("dim_store", merge_stores_from_master(tables.read("dim_store"), sheet, "seq"))
    seen = fact(spark, ("s", "k", D1, 1), ("u", "k", D1, 1))
    tables.replace("dim_store", merge_stores_from_sales(tables.read("dim_store"), seen))
    wide = spark.createDataFrame([("u", 2 ** 40, 1)], "store_id string, floor long, seq int")
    tables.replace("dim_store", merge_stores_from_master(tables.read("dim_store"), wide, "seq"))
    assert {r.store_id: r.floor for r in tables.read("dim_store").collect()} \
        == {"s": 3, "t": 4, "u": 2 ** 40}


# Day totals

def test_day_totals_follow_every_write(spark, tables):
    tables.write_days(fact(spark, ("a", "x", D1, 1), ("b", "x", D1, 2), ("a", "y", D3, 4)))
    tables.upsert_fact(fact(spark, ("a", "x", D1, 6), ("c", "z", D2, 3), ("c", "w", D2, 1)), "seq")
    saved = tables.read("fact_sales")
    ours, expected = tables.read("fact_days"), day_rows(saved)
    assert ours.count() == 3
    assert ours.exceptAll(expected).isEmpty() and expected.exceptAll(ours).isEmpty()
    codes = {r.sku_id: r.code for r in tables.read("sku_codes").collect()}
    assert sorted(codes.values()) == [1, 2, 3, 4] and sorted((codes["x"], codes["y"])) == [1, 2]
    found = distinct_skus(tables.read("fact_day_stores"), F.trunc("date", "month").alias("m"))
    assert {r.m: r.skus for r in found.collect()} == {D1: 3, D3.replace(day=1): 1}


def test_a_broken_write_is_made_good(spark, tables, monkeypatch):
    tables.write_days(fact(spark, ("a", "x", D1, 1)))

    def fail(touched):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "_refresh", fail)
        with pytest.raises(OSError):
            tables.upsert_fact(fact(spark, ("a", "x", D1, 5), ("a", "x", D2, 7)), "seq")
    assert {r.date: r.total_units_sold for r in tables.read("fact_days").collect()} == {D1: 1}
    assert tables.repair_days() == [D1, D2] and tables.repair_days() == []
    assert {r.date: r.total_units_sold for r in tables.read("fact_days").collect()} \
        == {D1: 5, D2: 7}


def test_bitmaps_of_many_products(spark):
    rows = spark.range(70_000).select(
        F.concat(F.lit("k"), "id").alias("sku_id"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("store_id"),
        F.date_add(F.lit(D1), (F.col("id") % 40).cast("int")).alias("date"))
    none = spark.createDataFrame([], SKU_CODES)
    codes = with_codes(none, rows)
    assert codes.agg(F.min("code"), F.max("code"), F.count_distinct("code")).first() \
        == (1, 70_000, 70_000)
    more = with_codes(codes, rows.unionByName(rows.limit(1).withColumn("sku_id", F.lit("new"))))
    assert more.where("sku_id = 'new'").first().code == 70_001
    assert with_codes(more, rows) is more
    bitmaps = store_bitmaps(rows.unionByName(rows), more)
    assert bitmaps.agg(F.max("bucket")).first()[0] == 3
    month = F.trunc("date", "month").alias("month")
    expected = rows.groupBy("store_id", month).agg(F.count_distinct("sku_id").alias("skus"))
    found = distinct_skus(bitmaps, "store_id", month)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_row_numbers(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"))
    found = row_numbers(rows.repartition(5), ["k"], "n").orderBy("k").collect()
    assert [r.n for r in found] == list(range(1, 1001))


def test_few_rows_leave_the_held_ones_in_place(spark, tables):
    tables.write_days(fact(spark, ("a", "x", D1, 1), ("b", "x", D1, 2), ("a", "y", D3, 4)))
    tables.add_columns("fact_sales", "till int")
    held = tables.read("fact_sales")
    batch = fact(spark, ("a", "x", D1, 6), ("c", "z", D2, 3)).drop("seq").withColumn(
        "channel", F.lit("web")).withColumn("created_at", F.lit(None).cast("date"))
    few, whole = merge_few(held, batch, D2), merge_fact(held, batch, D2)
    assert few.schema == whole.schema
    assert few.exceptAll(whole).isEmpty() and whole.exceptAll(few).isEmpty() and few.count() == 4
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert merge_few(held.limit(0), batch, D2).count() == 2
    assert merge_few(held, batch.limit(0), D2).count() == 3


def test_large_batches_take_the_full_join(spark, tables, monkeypatch):
    monkeypatch.setattr("tillflow.sources.tables.FEW_ROWS", 1)
    tables.write_days(fact(spark, ("a", "x", D1, 1), ("b", "x", D1, 2)))
    tables.upsert_fact(fact(spark, ("a", "x", D1, 6), ("c", "z", D2, 3)), "seq", D2)
    found = {(r.store_id, r.date): r.units_sold for r in tables.read("fact_sales").collect()}
    assert found == {("a", D1): 6, ("b", D1): 2, ("c", D2): 3}


def fact_scans(df) -> int:
    """How often a plan reads files of the fact."""
    return df._jdf.queryExecution().executedPlan().toString().count("/fact_sales]")


def test_days_are_not_looked_up_in_the_fact(spark, star):
    saved = star.star_with_totals()
    as_of = dt.date(1999, 2, 28)
    out = reports.stockouts(saved["fact_sales"], saved["dim_sku"], saved["dim_store"],
                            saved["fact_days"])
    plain = reports.stockouts(saved["fact_sales"], saved["dim_sku"], saved["dim_store"])
    assert (fact_scans(out), fact_scans(plain)) == (1, 2)
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()
    for name in ("sku_store_matrix_view", "promo_analysis_view"):
        ours = view_frame(spark, name, saved)
        derived = view_frame(spark, name, {k: v for k, v in saved.items() if k != "fact_days"})
        assert (fact_scans(ours), fact_scans(derived)) == (1, 2)
        assert ours.exceptAll(derived).isEmpty() and derived.exceptAll(ours).isEmpty()
    every = reports.all_reports(saved, as_of)
    plain = reports.all_reports({k: v for k, v in saved.items()
                                 if k in ("fact_sales", "dim_sku", "dim_store")}, as_of)
    for name in ("sales_summary", "sales_growth_mom", "numeric_distribution"):
        assert every[name].schema.simpleString() == plain[name].schema.simpleString()
        assert every[name].collect() == plain[name].collect()
        assert fact_scans(every[name]) == 0 < fact_scans(plain[name])


def test_rows_of_a_replacement_are_computed_once(spark, tables):
    computed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            computed.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(str(k), f"Store {k}") for k in range(10)],
                                 "store_id string, store_name string")
    assert tables.replace("dim_store", rows.mapInPandas(counting, rows.schema))
    assert computed.value == 10
    folder = tables.path("dim_store")
    assert not tables.replace("dim_store", rows)
    assert tables.path("dim_store") == folder and tables.read("dim_store").count() == 10
