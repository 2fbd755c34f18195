"""Totals per day, client, city, SKU and brand: what every tile, series, ranking and filter list adds up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..settings import PRICE_PRECISION, PRICE_SCALE

KEYS = ["Date", "YearMonth", "Year", "Month", "Client", "City", "SKU", "Brand"]


def sales_daily(wide: DataFrame, price_scale: int = PRICE_SCALE) -> DataFrame:
    """One row per combination of ``KEYS`` with its revenue, volume and number of lines.

    Lines are added up on the map side first, so a day of a hot SKU leaves each task as one row. The revenue is kept in
    18 digits, which Spark adds up as longs; one beyond that is split over as many rows as it needs, of which the first has
    the volume and the lines, so that all sums are exact.
    """
    groups = wide.groupBy(*KEYS).agg(
        F.sum("Revenue").alias("_sum"), F.sum("Volume").alias("_volume"), F.count(F.lit(1)).alias("_lines")
    )
    kind = f"decimal({PRICE_PRECISION},{price_scale})"
    most = 10 ** (PRICE_PRECISION - price_scale) // 2
    rows = F.floor(F.abs("_sum").cast("double") / most).cast("int") + 1
    split = groups.withColumn("_rows", F.coalesce(rows, F.lit(1))).withColumn("_row", F.explode(F.sequence(F.lit(1), "_rows")))
    share = (F.col("_sum") / F.col("_rows")).cast(kind)
    first = (F.col("_sum") - share * (F.col("_rows") - 1)).cast(kind)
    is_first = F.col("_row") == 1
    return split.select(
        *KEYS,
        F.when(F.col("_rows") == 1, F.col("_sum").cast(kind)).when(is_first, first).otherwise(share).alias("Revenue"),
        F.when(is_first, F.col("_volume")).otherwise(F.lit(0)).alias("Volume"),
        F.when(is_first, F.col("_lines")).otherwise(F.lit(0)).alias("Lines"),
    )
