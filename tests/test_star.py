from shelfwise import schemas
from shelfwise.operators import gold, silver
from shelfwise.plans.build import gold_layer, wide_frame
from shelfwise.settings import UNMAPPED_BRAND


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SALES)


def feeds(spark, *rows):
    return {
        "Sales": sales(spark, *rows),
        "Items": spark.createDataFrame([("I1", "Cola", "Drinks", "B1", "Small"), (None,) * 5], schemas.ITEMS),
        "Store": spark.createDataFrame(
            [("S1", "Mart", "Mart - Oslo", None, "B20"), ("S2", "Other", "Other", "GOLD", "B20")], schemas.STORE
        ),
        "Client": spark.createDataFrame(
            [("B20", "Mart Supers", "Mart", "BRONZE"), ("B19", "Mart Hypers", "Mart", "SILVER")], schemas.CLIENT
        ),
    }


def test_cleaning_fills_and_multiplies(spark):
    rows = silver.clean_sales(sales(
        spark,
        ("20200101", "S1", "I1", "1,200", "2.50 €"),
        ("20200101", "S1", "I1", "bad", "2.50 €"),
        ("20200101", "S1", "I1", "3", "1,99 €"),
        (None, "S1", "I1", "-2", "4"),
    )).collect()
    assert [(r.Vendas_Unidades, float(r.PVP), float(r.Vendas_Valor)) for r in rows] == [
        (1200, 2.5, 3000.0), (0, 2.5, 0.0), (3, 0.0, 0.0), (-2, 4.0, -8.0)
    ]
    assert rows[0].DateKey == "20200101" and rows[3].Data is None


def test_largest_units_and_price_do_not_overflow(spark):
    row = silver.clean_sales(sales(spark, ("20200101", "S1", "I1", "2147483647", "9999999999999999.99"))).first()
    assert row.Vendas_Valor == row.PVP * 2147483647


def test_fact_keeps_free_sales_and_drops_returns(spark):
    fact = gold.fact_sales(silver.clean_sales(sales(
        spark,
        ("20200101", "S1", "free", "1", None), ("20200101", "S1", "sold", "2", "3"),
        ("20200101", "S1", "returned", "-1", "3"), ("20200101", "S1", "refund", "1", "-3"),
        ("20200101", "S1", "nothing", "0", "3"),
    )))
    assert {row.ITEMCODE for row in fact.collect()} == {"free", "sold"}


def test_unmapped_items_include_rejected_lines_and_one_null_row(spark):
    cleaned = silver.clean_sales(sales(
        spark,
        ("20200101", "S1", "I1", "1", "1"), ("20200101", "S1", "new", "1", "1"), ("20200102", "S1", "new", "1", "1"),
        ("20200101", "S1", "returned", "-1", "1"), ("20200101", "S1", None, "1", "1"), ("20200102", "S1", None, "1", "1"),
    ))
    items = silver.clean_items(feeds(spark, ("20200101", "S1", "I1", "1", "1"))["Items"])
    rows = gold.unmapped_items(cleaned, items, label="?", brand="P", category="C", segment="U").collect()
    assert sorted((row.ITEMCODE or "", row.SKU, row.Brand) for row in rows) == [
        ("", "?", "P"), ("new", "?", "P"), ("returned", "?", "P")
    ]
    assert gold.dim_item(cleaned, items).count() == 4


def test_store_dimension_joins_client_on_both_keys(spark):
    stores = gold.dim_store(*[feeds(spark, ("20200101", "S1", "I1", "1", "1"))[name] for name in ("Store", "Client")])
    rows = {row.StoreID: row for row in stores.collect()}
    assert len(rows) == 2
    assert (rows["S1"].Client_Name, rows["S1"]["Store Type"], rows["S1"].City) == ("Mart", "BRONZE", "Oslo")
    assert (rows["S2"].Client_Name, rows["S2"]["Store Type"], rows["S2"].City) == (None, "GOLD", "Unknown")


def test_calendar_spans_whole_years_of_all_lines(spark):
    cleaned = silver.clean_sales(sales(
        spark, ("20190615", "S1", "I1", "-1", "1"), ("20200229", "S1", "I1", "1", "1"), (None, "S1", "I1", "1", "1")
    ))
    days = gold.dim_date(cleaned).orderBy("Data").collect()
    assert len(days) == 365 + 366
    assert (days[0].DateKey, days[-1].DateKey) == ("20190101", "20201231")
    leap = next(day for day in days if day.DateKey == "20200229")
    assert (leap.Ano, leap.Mes, leap.Dia, leap.Trimestre, leap.Nome_Mes, leap.AnoMes) == (2020, 2, 29, 1, "February", "2020-02")


def test_calendar_of_nothing_is_empty(spark):
    assert gold.dim_date(silver.clean_sales(sales(spark, (None, "S1", "I1", "1", "1")))).count() == 0


def test_wide_frame_drops_orphans_and_fans_out(spark):
    raw = feeds(
        spark,
        ("20200101", "S1", "I1", "1", "5"), ("20200101", "S9", "I1", "1", "5"), ("20200101", "S1", "new", "2", "5"),
        ("20200101", None, "I1", "1", "5"), (None, "S1", "I1", "1", "5"), ("20200101", "S1", None, "1", "5"),
    )
    star = gold_layer(raw)
    wide = wide_frame(star).collect()
    assert sorted((row.ITEMCODE, float(row.Revenue), row.City, row.Brand) for row in wide) == [
        ("I1", 5.0, "Oslo", "B1"), ("new", 10.0, "Oslo", UNMAPPED_BRAND)
    ]
    twice = {**star, "Dim_Store": star["Dim_Store"].unionByName(star["Dim_Store"])}
    assert wide_frame(twice).count() == 4


def test_wide_frame_without_stored_city_or_partitions(spark):
    star = gold_layer(feeds(spark, ("20200101", "S1", "I1", "1", "5")))
    expected = wide_frame(star).collect()
    assert wide_frame({**star, "Dim_Store": star["Dim_Store"].drop("City")}).collect() == expected
    assert wide_frame({**star, "Fact_Sales": star["Fact_Sales"].drop("Ano", "Mes")}).collect() == expected
