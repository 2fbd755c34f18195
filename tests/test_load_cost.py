"""What a load does for each line: how often it is parsed, shuffled and compared."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import gold, silver
from shelfwise.operators.incremental import beyond_stored, differing_days
from shelfwise.plans import build, registry
from shelfwise.sources import trade_tables as tables
from shelfwise.sources import shared, store
from shelfwise.sources.feeds import CORRUPT, read_bronze

SALES = "SALESDATE string, StoreID string, ITEMCODE string, `Vendas Unidades` string, PVP string"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_staged_with_one_look_at_its_date(spark):
    feed = spark.createDataFrame([("20190101", "S", "I", "1", "2")], SALES)
    assert plan_of(silver.stage_sales(feed)).count("try_to_date") == 1


def test_staged_lines_keep_reason_and_raw_text(spark):
    rows = [
        ("20190101", "S", "I", "1", "2 €", None), (None, "S", "I", "x", "€2", None), ("20191301", "S", None, "1", "2 €", None),
        ("20190101", "S", None, None, None, "20190101,S"),
    ]
    staged = silver.stage_sales(spark.createDataFrame(rows, f"{SALES}, {CORRUPT} string"))
    found = {tuple(row) for row in staged.select("Reason", "Line", "Ano").collect()}
    assert found == {
        (None, None, 2019), (silver.MISSING_DATE, ',S,I,x,€2', None), (silver.UNREADABLE_DATE, '20191301,S,,1,2 €', None),
        (silver.WRONG_FIELD_COUNT, "20190101,S", None),
    }


def test_stored_lines_are_counted_in_one_aggregation(spark):
    schema = "k string, n int, note string"
    lines = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", None, "y"), (None, None, "z"), (None, None, "z")], schema)
    stored = spark.createDataFrame([("a", 1, "other"), (None, None, "other"), ("b", 2, "other")], schema)
    found = beyond_stored(lines, stored, ["k", "n"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("a", 1, "x"), ("a", None, "y"), (None, None, "z")], key=str)
    assert "Union" in plan_of(found) and "LeftOuter" not in plan_of(found)


def test_days_that_differ_are_told_from_equal_ones(spark):
    schema = "Data int, k string, n int"
    lines = [(1, "a", 1), (1, "a", 1), (2, "a", 1), (3, None, 1), (4, "b", None), (4, None, 2), (5, "a", 1), (5, "b", 2)]
    stored = [(1, "a", 1), (1, "a", 1), (2, "a", 1), (2, "a", 1), (3, "a", None), (4, None, 2), (4, "b", None), (5, "a", 2), (5, "b", 1), (6, "a", 1)]
    found = differing_days(spark.createDataFrame(lines, schema), spark.createDataFrame(stored, schema), ["k", "n"])
    assert sorted(row.Data for row in found.collect()) == [2, 3, 5]


def test_lines_of_a_day_that_is_stored_are_not_compared_again(spark, tmp_path, monkeypatch):
    sales = [(f"201901{day:02}", "S1", item, "1", "2") for day in (1, 2, 3) for item in ("I1", "I1", None)]
    feeds = {
        "Sales": spark.createDataFrame(sales, schemas.SALES), "Items": spark.createDataFrame([("I1", "a", "b", "c", "d")], schemas.ITEMS),
        "Store": spark.createDataFrame([("S1", "X", "X - Y", "A", "B")], schemas.STORE), "Client": spark.createDataFrame([("B", "X", "X", "A")], schemas.CLIENT),
    }
    root, compared = str(tmp_path), []
    build.load_increment(spark, feeds, root, "first")

    def noted(lines, stored, key):
        compared.append((lines.count(), stored.count()))
        return beyond_stored(lines, stored, key)

    monkeypatch.setattr(build, "beyond_stored", noted)
    build.load_increment(spark, feeds, root, "second")
    assert compared[0] == (0, 0) and build.read_silver(spark, root).count() == 9
    compared.clear()
    more = {**feeds, "Sales": spark.createDataFrame([*sales, ("20190102", "S1", "I1", "1", "2")], schemas.SALES)}
    build.load_increment(spark, more, root, "third")
    assert compared[0] == (4, 3) and build.read_silver(spark, root).count() == 10


@pytest.mark.parametrize("text, number", [
    ("10485760b", 10485760), ("256k", 262144), ("128MB", 2**27), ("134217728", 2**27), ("-1", 0), ("-1b", 0),
])
def test_a_broadcast_threshold_has_a_unit(text, number):
    assert build.broadcast_bytes(text) == number


def test_lines_go_to_their_months_without_the_columns_of_small_dimensions(spark):
    fact = spark.createDataFrame(
        [("S", "I", "20190102", 1, 2, 2, 2019, 1), ("S", "J", "20190102", 1, 3, 3, 2019, 1), ("T", "I", "20190102", 1, 4, 4, 2019, 1)],
        "StoreID string, ITEMCODE string, DateKey string, `Vendas Unidades` int, PVP int, `Vendas Valor` int, Ano int, Mes int",
    )
    dates = gold.dim_date(spark.sql("SELECT DATE'2019-01-02' AS Data"))
    stores = spark.createDataFrame([("S", "X - Y", "Y", "C", "C", "G")] * 2, "StoreID string, Store string, City string, Cliente string, Client_Name string, `Store Type` string")
    items = spark.createDataFrame([("I", "a", "b", "c", "d")], "ITEMCODE string, SKU string, Category string, Brand string, Segment string")
    plain, late = [gold.sales_wide(fact, dates, stores, items, late) for late in ((), ("stores", "dates"))]
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, plain.collect())) and late.count() == 2
    assert late.columns == plain.columns
    dealt = plan_of(late).split("RebalancePartitions")[1].splitlines()[0:2]
    assert "RebalancePartitions" in plan_of(late) and not any("City" in line for line in dealt)


def test_codes_are_padded_as_by_a_formatter(spark):
    keys = spark.createDataFrame([(0,), (7,), (-7,), (999999,), (1000000,), (-1234567,), (2**63 - 1,), (-(2**63),), (None,)], "k long")
    rows = keys.select(tables._code("ST", "k").alias("a"), F.format_string("ST%06d", "k").alias("b")).collect()
    assert all(row.a == row.b for row in rows) and "format_string" not in plan_of(keys.select(tables._code("ST", "k")))


def feeds_of(spark, sales):
    return {
        "Sales": spark.createDataFrame(sales, schemas.SALES), "Items": spark.createDataFrame([("I1", "a", "b", "c", "d")], schemas.ITEMS),
        "Store": spark.createDataFrame([("S1", "X", "X - Y", "A", "B")], schemas.STORE), "Client": spark.createDataFrame([("B", "X", "X", "A")], schemas.CLIENT),
    }


def stored_rows(spark, root):
    now = store.open_snapshot(spark, root)
    return {name: sorted(map(str, now.table(name).collect())) for name in now.tables}


def test_months_are_joined_and_added_up_in_portions(spark, tmp_path, monkeypatch):
    sales = [(f"2019{month:02}{day:02}", "S1", item, "1", "2") for month in range(1, 8) for day in (1, 1, 2) for item in ("I1", "I9", None)]
    sales += [("20190101", "S1", "I1", "-1", "2"), (None, "S1", "I1", "1", "2"), ("20191301", "S1", "I1", "1", "2")]
    expected, written = {}, []
    load_write = store.Load.write

    def noted(run, df, name, **options):
        written.append((name, options.get("months")))
        load_write(run, df, name, **options)

    for at_most, least in ((1, 1), (3, 1), (100, 1)):
        monkeypatch.setattr(build, "PORTIONS", at_most)
        monkeypatch.setattr(build, "PORTION_BYTES", least)
        monkeypatch.setattr(store.Load, "write", noted)
        root = str(tmp_path / str(at_most))
        written.clear()
        build.load_increment(spark, feeds_of(spark, sales), root, "first")
        build.refresh_grain(spark, root)
        for name in ("Sold_Months", "Sales_Wide", "Sales_Daily", "Audit_Grain"):
            months = [months for table, months in written if table == name]
            assert 1 <= len(months) <= at_most and sum(len(one) for one in months) == len({month for one in months for month in one})
            assert len(months) > 1 or at_most == 1
        more = [*sales, ("20190203", "S1", "I9", "5", "2"), ("20190801", "S1", "I7", "5", "2")]
        build.load_increment(spark, feeds_of(spark, more), root, "second")
        build.refresh_grain(spark, root)
        expected = expected or stored_rows(spark, root)
        assert stored_rows(spark, root) == expected
    assert len(expected["Sales_Wide"]) == 44 and len(expected["Silver_Sales"]) == 68


def test_an_empty_feed_is_loaded(spark, tmp_path):
    build.build_gold(spark, feeds_of(spark, []), str(tmp_path))
    assert stored_rows(spark, str(tmp_path))["Sales_Wide"] == []


def test_an_increment_leaves_no_intermediate_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_path", lambda spark, name: f"{tmp_path}/shared/{name}-{len(os.listdir(tmp_path))}{os.urandom(4).hex()}")
    sales = [(f"2019010{day}", "S1", "I1", "1", "2") for day in (1, 2, 3)]
    for load in ("first", "second", "third"):
        build.load_increment(spark, feeds_of(spark, [*sales, ("20190101", "S1", load, "1", "2")]), str(tmp_path / "tables"), load)
    assert build.read_silver(spark, str(tmp_path / "tables")).count() == 6
    assert glob.glob(f"{tmp_path}/shared/*") == []


def test_shuffle_files_are_given_back_with_each_table(spark, tmp_path, monkeypatch):
    released = []
    monkeypatch.setattr(store, "release_shuffles", lambda spark: released.append(1))
    monkeypatch.setattr(store, "PORTION_BYTES", 1)
    build.build_gold(spark, feeds_of(spark, [("20190101", "S1", "I1", "1", "2")]), str(tmp_path))
    assert len(released) >= 5  # tables with lines or totals of months


def test_lines_reach_their_month_without_what_follows_from_other_columns(spark, tmp_path):
    run = store.Load(spark, str(tmp_path), "one")
    staged = silver.stage_sales(spark.createDataFrame([("20190101", "S", "I", "3", "2 €")], SALES), "one")
    run.write(staged.drop("Load", "Vendas_Valor"), "Silver_Sales", after=build._after("one"))
    assert run.table("Silver_Sales").select("Load", "Vendas_Valor").collect() == staged.select("Load", "Vendas_Valor").collect()
    assert run.table("Silver_Sales").schema == schemas.tables()["Silver_Sales"]
    files = glob.glob(f"{tmp_path}/Silver_Sales/**/*.parquet", recursive=True)
    assert files and all(".zstd." in file for file in files)


def test_feeds_as_files_are_compressed(spark, tmp_path):
    rows = {
        "lineitem": ([(key, key % 3, key % 2, 1 + key % 2, 5.0, 1234.5) for key in range(70, 110)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"),
        "part": ([(1, "a, \"b\"", "T", "Brand#1", 3)], "p_partkey long, p_name string, p_type string, p_brand string, p_size int"),
        "supplier": ([(0, 1), (1, 1)], "s_suppkey long, s_nationkey long"), "nation": ([(1, "N", 2)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(2, "R")], "r_regionkey long, r_name string"),
    }
    for name, (values, schema) in rows.items():
        df = spark.createDataFrame(values, schema)
        df = df.withColumn("l_shipdate", F.lit("1999-02-03").cast("timestamp_ntz")) if name == "lineitem" else df
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    path = registry._csv(spark, str(tmp_path))
    for feed, df in tables.feeds(spark, str(tmp_path)).items():
        assert sorted(map(str, read_bronze(spark, f"{path}/{feed}.csv", feed).collect())) == sorted(map(str, df.collect()))
    files = [file for file in glob.glob(f"{path}/**/part-*", recursive=True)]
    assert files and all(file.endswith(".csv.gz") for file in files)
    assert registry._stream_load(spark, str(tmp_path)).count() == len(
        registry._incremental_load(spark, str(tmp_path)).collect()
    ) > 0
    registry._quarantined_sales(spark, str(tmp_path)).collect()
    found = registry._stored[spark.sparkContext.applicationId, str(tmp_path), "quarantine"]
    assert all(file.endswith(".txt.gz") for file in glob.glob(f"{found}/Sales.csv/part-*"))
