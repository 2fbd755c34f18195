"""Raw sell-out feeds derived from order-line tables, with every kind of dirt the cleansing has to handle.

Every order line becomes one sale line. The key arithmetic only decides which dirt a line carries; no line is
left out. The master row of one part in twenty has another code, and one region's client another banner, which is what
the operators for unmapped items and unmatched clients look for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Values of these tables that take the place of the case's own.
PARENT_BRAND = "Brand#1"
PARENT_CATEGORY = "ECONOMY"
REPORT_YEAR = 2000
REPORT_MONTH = "2000-06"
LOADED_UNTIL = "2001-06-30"
LATENESS_DAYS = 700


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _code(prefix: str, key: str) -> Column:
    """The key with six digits at least, as ``%06d`` writes it. A formatter for each line took most of a load's time."""
    digits = F.abs(F.col(key).cast("decimal(20,0)")).cast("string")
    sign, width = F.when(F.col(key) < 0, F.lit("-")).otherwise(F.lit("")), F.when(F.col(key) < 0, 5).otherwise(6)
    padded = F.concat(F.lit(prefix), sign, F.repeat(F.lit("0"), width - F.length(digits)), digits)
    return F.coalesce(padded, F.lit(f"{prefix}  null"))


def sales_feed(spark: SparkSession, folder: str) -> DataFrame:
    order, quantity = F.col("l_orderkey"), F.col("l_quantity").cast("int")
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    return _table(spark, folder, "lineitem").select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("SALESDATE"),
        _code("ST", "l_suppkey").alias("StoreID"),
        _code("IT", "l_partkey").alias("ITEMCODE"),
        F.when(order % 97 == 0, (-quantity).cast("string"))
        .when(order % 89 == 0, F.lit("n/a"))
        .otherwise(F.format_number(quantity * 100, 0))
        .alias("Vendas Unidades"),
        F.when(order % 83 == 0, F.lit(None).cast("string"))
        .when(order % 79 == 0, F.lit("1,99 €"))
        .when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("€"), price))
        .otherwise(F.concat(price, F.lit(" €")))
        .alias("PVP"),
    )


def broken_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The sales feed as lines of text, with three kinds of broken lines among them."""
    order, number = F.col("l_orderkey"), F.col("l_linenumber")
    day, store, item = F.date_format("l_shipdate", "yyyyMMdd"), _code("ST", "l_suppkey"), _code("IT", "l_partkey")
    units, price = F.col("l_quantity").cast("int").cast("string"), F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    line = (
        F.when(order % 101 == 0, F.concat_ws(",", day, store, item, F.concat(F.lit("1,"), number.cast("string"), F.lit("00")), price))
        .when(order % 103 == 0, F.concat_ws(",", day, store, item))
        .when(order % 107 == 0, F.concat_ws(",", F.concat(F.year("l_shipdate").cast("string"), F.lit("1301")), store, item, units, price))
        .otherwise(F.concat_ws(",", day, store, item, units, price))
    )
    return _table(spark, folder, "lineitem").select(line.alias("Line"))


def items_feed(spark: SparkSession, folder: str) -> DataFrame:
    master = _table(spark, folder, "part").select(
        F.when(F.col("p_partkey") % 20 == 0, _code("OLD", "p_partkey")).otherwise(_code("IT", "p_partkey")).alias("ITEMCODE"),
        F.col("p_name").alias("SKU"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Brand"),
        F.concat("p_type", F.lit(" "), F.col("p_size").cast("string")).alias("Segment"),
    )
    nothing = F.lit(None).cast("string")
    blanks = spark.range(5).select([nothing.alias(column) for column in master.columns])
    return master.unionByName(blanks)


def store_feed(spark: SparkSession, folder: str) -> DataFrame:
    places = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    stores = _table(spark, folder, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    return stores.select(
        _code("ST", "s_suppkey").alias("StoreID"),
        F.col("r_name").alias("Cliente"),
        F.when(F.col("s_suppkey") % 10 == 0, F.concat("r_name", F.lit(" Supers")))
        .otherwise(F.concat(F.lit("Super-Max "), "r_name", F.lit(" - "), "n_name"))
        .alias("Store"),
        F.when(F.col("s_suppkey") % 3 != 0, F.lit("SILVER")).alias("Store Type"),
        F.concat(F.lit("B"), F.col("r_regionkey").cast("string")).alias("BannerID"),
    )


def client_feed(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("r_regionkey")
    return _table(spark, folder, "region").select(
        F.concat(F.lit("B"), F.when(key == 4, key + 90).otherwise(key).cast("string")).alias("BannerID"),
        F.concat("r_name", F.lit(" Supers")).alias("BannerName"),
        F.col("r_name").alias("Cliente"),
        F.lit("GOLD").alias("Store Type"),
    )


def feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "Sales": sales_feed(spark, folder),
        "Items": items_feed(spark, folder),
        "Store": store_feed(spark, folder),
        "Client": client_feed(spark, folder),
    }


# What the columns of the sales feed are called in its third version.
RENAMED = {"Day": "SALESDATE", "Store": "StoreID", "Units": "Vendas Unidades", "Price": "PVP"}


def versions_of_sales(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The sales feed as three groups of stores deliver it: as agreed; in another order; renamed, with two more columns."""
    sales, group = sales_feed(spark, folder), F.substring("StoreID", 3, 6).cast("int") % 3
    agreed, other, third = [sales.where(group == number) for number in range(3)]
    renamed = third.select(
        F.col("PVP").alias("Price"), F.col("SALESDATE").alias("Day"), F.lit("a, \"b\"").alias("Remark"),
        F.col("Vendas Unidades").alias("Units"), "ITEMCODE", F.col("StoreID").alias("Store"), F.lit("till").alias("Channel"),
    )
    return {"agreed": agreed, "reordered": other.select(*reversed(other.columns)), "renamed": renamed}


def reports_late() -> Column:
    """Sale lines of one store in seven."""
    return F.substring("StoreID", 3, 6).cast("int") % 7 == 0


def early_masters(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The masters as they may have been before: without one item and one store in six, with other names for one item in
    eleven, and without a client."""
    def number(column: str) -> Column:
        return F.substring(column, -6, 6).cast("int")

    items = feeds["Items"].where(F.col("ITEMCODE").isNull() | (number("ITEMCODE") % 6 != 0))
    renamed = F.when(number("ITEMCODE") % 11 == 0, F.concat(F.lit("former "), "SKU")).otherwise(F.col("SKU"))
    return {
        "Items": items.withColumn("SKU", renamed),
        "Store": feeds["Store"].where(number("StoreID") % 6 != 0),
        "Client": feeds["Client"].where(F.col("BannerID") != "B1"),
    }
