"""Star schema: fact, item, store and date dimensions, and the wide frame joined from them."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import city_of, parse_units
from ..settings import UNMAPPED_BRAND, UNMAPPED_CATEGORY, UNMAPPED_LABEL, UNMAPPED_SEGMENT


def is_sale(units: Column, price: Column) -> Column:
    """What counts as a sale: units sold for a revenue that may be zero but not negative. With positive units that
    is a price which is not negative, so the product need not be computed to filter by it."""
    return (units > 0) & (price >= 0)


def reject_reason(raw_units: Column) -> Column:
    """Why a line that is no sale is none, from its units as they came: there a zero and an unreadable text differ."""
    units = parse_units(raw_units)
    return (
        F.when(raw_units.isNull(), F.lit("missing units"))
        .when(units.isNull(), F.lit("unreadable units"))
        .when(units < 0, F.lit("returned units"))
        .when(units == 0, F.lit("zero units"))
        .otherwise(F.lit("negative revenue"))
    )


def fact_sales(silver_sales: DataFrame) -> DataFrame:
    """Sale lines, not aggregated. ``Ano`` and ``Mes`` are the storage partitions."""
    return silver_sales.where(is_sale(F.col("Vendas_Unidades"), F.col("PVP"))).select(
        "StoreID",
        "ITEMCODE",
        "DateKey",
        F.col("Vendas_Unidades").alias("Vendas Unidades"),
        "PVP",
        F.col("Vendas_Valor").alias("Vendas Valor"),
        F.year("Data").alias("Ano"),
        F.month("Data").alias("Mes"),
    )


def unmapped_items(
    silver_sales: DataFrame,
    items: DataFrame,
    *,
    label: str = UNMAPPED_LABEL,
    brand: str = UNMAPPED_BRAND,
    category: str = UNMAPPED_CATEGORY,
    segment: str = UNMAPPED_SEGMENT,
) -> DataFrame:
    """One row per item code sold without a master row, rejected lines included; NULL codes give one NULL row.

    ``distinct`` comes before the anti join: it is combined on the map side, so a code that holds a third of
    all lines leaves each task as one row and never reaches the join as lines.
    """
    codes = silver_sales.select("ITEMCODE").distinct()
    return codes.join(items.select("ITEMCODE"), "ITEMCODE", "left_anti").select(
        "ITEMCODE",
        F.lit(label).alias("SKU"),
        F.lit(category).alias("Category"),
        F.lit(brand).alias("Brand"),
        F.lit(segment).alias("Segment"),
    )


def dim_item(silver_sales: DataFrame, items: DataFrame, **labels: str) -> DataFrame:
    """Item master and the unmapped items, so that no revenue is lost in the join."""
    master = items.select("ITEMCODE", "SKU", "Category", "Brand", "Segment")
    return master.unionByName(unmapped_items(silver_sales, items, **labels))


def dim_store(stores: DataFrame, clients: DataFrame) -> DataFrame:
    """Stores with their city and client. Client rows are keyed by client and banner together."""
    client = clients.select(
        "Cliente", "BannerID",
        F.col("Cliente").alias("Client_Name"),
        F.col("Store Type").alias("_client_type"),
    )
    return stores.join(client, ["Cliente", "BannerID"], "left").select(
        "StoreID",
        "Store",
        city_of(F.col("Store")).alias("City"),
        "Cliente",
        "Client_Name",
        F.coalesce("Store Type", "_client_type").alias("Store Type"),
    )


def year_bounds(silver_sales: DataFrame) -> DataFrame:
    """First and last year with sale lines, rejected ones included, as one row."""
    return silver_sales.agg(
        F.year(F.min("Data")).alias("Min_Year"), F.year(F.max("Data")).alias("Max_Year")
    )


def dim_date(silver_sales: DataFrame) -> DataFrame:
    """Every day from 1 January of the first year to 31 December of the last."""
    first = F.make_date(F.col("Min_Year"), F.lit(1), F.lit(1))
    last = F.make_date(F.col("Max_Year"), F.lit(12), F.lit(31))
    days = year_bounds(silver_sales).select(F.explode(F.sequence(first, last)).alias("Data"))
    return days.select(
        "Data",
        F.date_format("Data", "yyyyMMdd").alias("DateKey"),
        F.year("Data").alias("Ano"),
        F.month("Data").alias("Mes"),
        F.dayofmonth("Data").alias("Dia"),
        F.quarter("Data").alias("Trimestre"),
        F.date_format("Data", "MMMM").alias("Nome_Mes"),
        F.date_format("Data", "yyyy-MM").alias("AnoMes"),
    )


def sales_wide(
    fact: DataFrame, dates: DataFrame, stores: DataFrame, items: DataFrame, late: Collection[str] = ()
) -> DataFrame:
    """Sale lines with all attributes: inner joins, so lines with an unknown or NULL key are not in it.

    No broadcast hint: Spark broadcasts each dimension whose stored size is below its threshold and sort-merges
    the others, where adaptive execution splits the partition of a hot key. Year and month come from the fact's
    storage partitions when it has them, so that a period filter reads only the files of that period.

    ``late`` names dimensions ('dates', 'stores', 'items') that are small enough to broadcast: lines are joined to the
    others first, then dealt to their months, and get the columns of these where they are then.
    """
    keys = ["DateKey"]
    if {"Ano", "Mes"} <= set(fact.columns):
        keys += ["Ano", "Mes"]
    if "City" not in stores.columns:
        stores = stores.withColumn("City", city_of(F.col("Store")))
    joins = {
        "dates": (dates.select("DateKey", "Data", "AnoMes", "Mes", "Ano", "Nome_Mes"), keys),
        "stores": (stores.select("StoreID", "Store", "Cliente", "Store Type", "City"), "StoreID"),
        "items": (items.select("ITEMCODE", "SKU", "Category", "Brand", "Segment"), "ITEMCODE"),
    }
    joined = fact
    for name, (dimension, key) in joins.items():
        joined = joined if name in late else joined.join(dimension, key)
    if late:
        joined = joined.hint("rebalance", "Ano", "Mes")
    for name in late:
        joined = joined.join(*joins[name])
    return (
        joined
        .select(
            "DateKey", "StoreID", "ITEMCODE",
            F.col("Vendas Valor").alias("Revenue"),
            F.col("Vendas Unidades").alias("Volume"),
            F.col("Data").alias("Date"),
            F.col("AnoMes").alias("YearMonth"),
            F.col("Mes").alias("Month"),
            F.col("Ano").alias("Year"),
            F.col("Nome_Mes").alias("MonthName"),
            "Store",
            F.col("Cliente").alias("Client"),
            F.col("Store Type").alias("StoreType"),
            "City", "SKU", "Category", "Brand", "Segment",
        )
    )
