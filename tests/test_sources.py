import os

import pytest

from shelfwise import schemas
from shelfwise.operators import contracts, gold, incremental, silver
from shelfwise.plans.build import (
    build_gold, gold_layer, load_increment, read_quarantine, read_silver, read_wide, wide_frame,
)
from shelfwise.sources.feeds import read_bronze, read_bronze_strict, read_feeds
from shelfwise.sources.store import read_star, read_table
from shelfwise.sources.shared import shared_path
from shelfwise.streaming.feed_stream import load_available, sales_stream

SALES_HEADER = "SALESDATE,StoreID,ITEMCODE,Vendas Unidades,PVP\n"


def write(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as file:
        file.write(text)
    return str(path)


def test_csv_with_bom_quotes_and_blanks(spark, tmp_path):
    path = write(tmp_path / "Sales.csv", SALES_HEADER + '20200101,S1,I1,"1,200",2.50 €\n20200102,S1,,,"say ""hi"""\n', bom=True)
    rows = read_bronze(spark, path, "Sales").collect()
    assert tuple(rows[0]) == ("20200101", "S1", "I1", "1,200", "2.50 €")
    assert tuple(rows[1]) == ("20200102", "S1", None, None, 'say "hi"')


def test_reordered_header_is_refused(spark, tmp_path):
    path = write(tmp_path / "Sales.csv", "StoreID,SALESDATE,ITEMCODE,Vendas Unidades,PVP\nS1,20200101,I1,1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_bronze(spark, path, "Sales").collect()


def test_contract_violations(spark, tmp_path):
    path = write(
        tmp_path / "Sales.csv",
        SALES_HEADER + "20200101,S1,I1,1,2\n20200101,S1\n20209901,S1,I1,x,2\n20200101,,I1,1,abc\n20200101,S1,I1,1,2,3\n",
    )
    found = contracts.contract_violations(read_bronze_strict(spark, path, "Sales")).collect()
    assert sorted((row.Field, row.Value or "", row.Rule) for row in found) == [
        ("PVP", "abc", "unreadable"),
        ("SALESDATE", "20209901", "unreadable"),
        ("StoreID", "", "missing"),
        ("Vendas Unidades", "x", "unreadable"),
        ("line", "20200101,S1", "wrong field count"),
        ("line", "20200101,S1,I1,1,2,3", "wrong field count"),
    ]


def test_load_from_csv_files(spark, tmp_path):
    write(tmp_path / "Sales.csv", SALES_HEADER + "20200101,S1,I1,2,3 €\n20200301,S1,I9,1,€4\n20200302,S1,I1,-1,3 €\n")
    write(tmp_path / "Items.csv", "ITEMCODE,SKU,Category,Brand,Segment\nI1,Cola,Drinks,B1,Small\n,,,,\n", bom=True)
    write(tmp_path / "Store.csv", "StoreID,Cliente,Store,Store Type,BannerID\nS1,Mart,Mart - Oslo,,B1\n", bom=True)
    write(tmp_path / "Client.csv", "BannerID,BannerName,Cliente,Store Type\nB1,Mart Supers,Mart,GOLD\n", bom=True)
    raw = read_feeds(spark, str(tmp_path))
    root = str(tmp_path / "gold")
    stored = build_gold(spark, raw, root)
    lazy = gold_layer(raw)
    for name, table in stored.items():
        assert sorted(map(str, table.collect())) == sorted(map(str, lazy[name].select(table.columns).collect()))
    assert any(os.path.isdir(f"{root}/Fact_Sales/{version}/Ano=2020/Mes=3") for version in os.listdir(f"{root}/Fact_Sales"))
    assert sorted((row.SKU, float(row.Revenue)) for row in wide_frame(stored).collect()) == [
        ("Cola", 6.0), ("⚠️ UNMAPPED (Missing SKU)", 4.0)
    ]
    # A refresh replaces what was there.
    assert build_gold(spark, raw, root)["Fact_Sales"].count() == 2


def cleaned(spark, *days):
    return silver.clean_sales(spark.createDataFrame([(day, "S1", "I1", "1", "2") for day in days], schemas.SALES))


ITEMS = [("I1", "Cola", "Drinks", "B1", "Small"), ("I3", "Tea", "Drinks", "B1", "Small")]


def feeds_of(spark, *lines):
    """Feeds with sale lines of (day, item, units)."""
    rows = [(day, "S1", item, units, "2") for day, item, units in lines]
    return {
        "Sales": spark.createDataFrame(rows, schemas.SALES), "Items": spark.createDataFrame(ITEMS, schemas.ITEMS),
        "Store": spark.createDataFrame([("S1", "X", "X - Oslo", "A", "B1")], schemas.STORE),
        "Client": spark.createDataFrame([("B1", "X", "X", "A")], schemas.CLIENT),
    }


def stored_lines(spark, root):
    wide = sorted((row.DateKey, row.ITEMCODE, row.Volume, row.SKU) for row in read_wide(spark, root).collect())
    fact = sorted((row.DateKey, row.ITEMCODE, row["Vendas Unidades"]) for row in read_table(spark, root, "Fact_Sales").collect())
    assert [line[:3] for line in wide] == fact
    joined = wide_frame(read_star(spark, root))
    assert sorted((row.DateKey, row.ITEMCODE, row.Volume, row.SKU) for row in joined.collect()) == wide
    return wide


def test_increment_reaches_every_table_once(spark, tmp_path):
    root, unmapped = str(tmp_path), "⚠️ UNMAPPED (Missing SKU)"
    load_increment(spark, feeds_of(spark, ("20200101", "I1", "1"), ("20200110", "I1", "1")), root, "a")
    # The last day again with a line more, an older line that is too late, a new code, a code of the master, a new year,
    # bad dates.
    feed = feeds_of(
        spark, ("20200101", "I1", "5"), ("20200110", "I1", "1"), ("20200110", "I1", "2"), ("20200111", "NEW", "3"),
        ("20210201", "I3", "4"), ("n/a", "I1", "9"), (None, "I1", "9"),
    )
    for _ in range(2):
        load_increment(spark, feed, root, "b", lateness=0)
        assert stored_lines(spark, root) == [
            ("20200101", "I1", 1, "Cola"), ("20200110", "I1", 1, "Cola"), ("20200110", "I1", 2, "Cola"),
            ("20200111", "NEW", 3, unmapped), ("20210201", "I3", 4, "Tea"),
        ]
        assert sorted(row.Reason for row in read_quarantine(spark, root).collect()) == ["late", "missing date", "unreadable date"]
        days = read_table(spark, root, "Dim_Date")
        assert days.count() == 366 + 365 and days.select("DateKey").distinct().count() == 366 + 365
        assert read_table(spark, root, "Dim_Item").count() == 3
    # The last day without any sale: its month goes.
    load_increment(spark, feeds_of(spark, ("20210201", "I3", "0")), root, "c")
    assert [line[0] for line in stored_lines(spark, root)] == ["20200101", "20200110", "20200110", "20200111"]


def test_lenient_increment_keeps_its_place(spark, tmp_path):
    root = str(tmp_path)
    load_increment(spark, feeds_of(spark, ("n/a", "I1", "1"), ("20200101", "I1", "1")), root, "a", lenient_dates=True)
    assert read_silver(spark, root).count() == 2
    load_increment(spark, feeds_of(spark, ("20200102", "I1", "1")), root, "b", lenient_dates=True)
    assert sorted(row.DateKey for row in read_wide(spark, root).collect()) == ["20200101", "20200102"]
    assert sorted(row.DateKey for row in read_silver(spark, root).collect()) == ["20200101", "20200102", "n/a"]


def test_incremental_rows(spark):
    def cleaned(*days):
        rows = [(day, "S1", "I1", "1", "2") for day in days]
        return silver.clean_sales(spark.createDataFrame(rows, schemas.SALES), lenient_dates=True)

    feed = cleaned("20200101", "20200110", "20200111", None)
    assert incremental.incremental_rows(feed, gold.fact_sales(feed.where("false"))).count() == 4
    stored = gold.fact_sales(cleaned("20191231", "20200110", "n/a"))
    assert sorted(row.DateKey for row in incremental.incremental_rows(feed, stored).collect()) == ["20200110", "20200111"]


def test_broken_lines_never_reach_silver(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "tables")
    raw.mkdir()
    bad = ["20200101,S1,I1,1,200,5.00 €", "20200101,S1,I1", "20201345,S1,I1,1,2", ",S1,I1,1,2"]
    write(raw / "Sales.csv", SALES_HEADER + "\n".join(["20200101,S1,I1,1,2", *bad, '20200102,S1,I1,"1,000",2']) + "\n")
    feeds = {**feeds_of(spark), "Sales": read_bronze_strict(spark, str(raw / "Sales.csv"), "Sales")}
    for ansi in ("true", "false"):
        before = spark.conf.get("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            build_gold(spark, feeds, root)
            assert sorted((row.DateKey, row.Vendas_Unidades) for row in read_silver(spark, root).collect()) == [
                ("20200101", 1), ("20200102", 1000)
            ]
            assert sorted(row.Reason for row in read_quarantine(spark, root).collect()) == [
                "missing date", "unreadable date", "wrong field count", "wrong field count"
            ]
            with pytest.raises(Exception, match="malformed date"):
                silver.clean_sales(feeds["Sales"]).select("Data").collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)


def test_prices_that_lose_decimals_are_reported(spark):
    rows = [("20200101", "S1", "I1", "1", price) for price in ("0.333", "0.1234567", "2", "1.50 €")]
    found = contracts.contract_violations(spark.createDataFrame(rows, schemas.SALES)).collect()
    assert [(row.Field, row.Value, row.Rule) for row in found] == [("PVP", "0.1234567", "inexact")]


def test_stream_loads_each_file_once(spark, tmp_path):
    arriving, root, progress = tmp_path / "in", str(tmp_path / "gold"), str(tmp_path / "progress")
    arriving.mkdir()
    masters = {name: feed for name, feed in feeds_of(spark).items() if name != "Sales"}

    def load():
        load_available(sales_stream(spark, str(arriving), max_files=1), masters, root, progress).awaitTermination()
        return [line[0] for line in stored_lines(spark, root)]

    write(arriving / "a.csv", SALES_HEADER + "20200101,S1,I1,1,2\n20200102,S1,I1,-1,2\n20200102,S1\n")
    write(arriving / "b.csv", SALES_HEADER + "20200105,S1,I1,1,2\nn/a,S1,I1,1,2\n")
    assert load() == ["20200101", "20200105"]
    assert load() == ["20200101", "20200105"]
    write(arriving / "c.csv", SALES_HEADER + "20191231,S1,NEW,1,2\n20200105,S1,I1,1,2\n")
    assert load() == ["20191231", "20200101", "20200105", "20200105"]
    assert read_quarantine(spark, root).count() == 2


def test_shared_path_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_path(spark, "x")
    assert path != shared_path(spark, "x")
    if root:
        assert path.startswith(root.rstrip("/") + "/")
