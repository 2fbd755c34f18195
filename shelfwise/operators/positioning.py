"""Rankings, contribution and positioning. Groups with a NULL key are left out throughout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.grouping import per_column
from ..functions.measures import total, total_where
from ..functions.ranking import ranked
from ..settings import CITY_COORDINATES, DEFAULT_COORDINATES, UNKNOWN_BRAND, UNMAPPED_LABEL
from .context import Period, with_sides

NOT_AVAILABLE = "N/A"


def _sums(p: DataFrame, by: Sequence[str], *measures: str) -> DataFrame:
    for key in by:
        p = p.where(F.col(key).isNotNull())
    return p.groupBy(*by).agg(*[total(measure).alias(measure) for measure in measures])


def _leader(key: Column, revenue: Column) -> Column:
    """Key with the highest revenue, the alphabetically first on a tie: one pass, no sort."""
    return F.coalesce(F.min_by(key, F.when(key.isNotNull(), F.struct(-revenue, key))), F.lit(NOT_AVAILABLE))


def top_city(p: DataFrame) -> DataFrame:
    cities = _sums(p, ["City"], "Revenue")
    return cities.agg(
        _leader(F.col("City"), F.col("Revenue")).alias("Top_City"),
        F.coalesce(F.max("Revenue"), F.lit(0)).alias("Top_City_Revenue"),
    )


def _is_known(label: str) -> Column:
    return F.col("SKU").isNull() | (F.col("SKU") != label)


def top_sku(p: DataFrame, label: str = UNMAPPED_LABEL) -> DataFrame:
    """SKU with the highest revenue, the unmapped label left out."""
    skus = _sums(p.where(_is_known(label)), ["SKU"], "Revenue")
    return skus.agg(_leader(F.col("SKU"), F.col("Revenue")).alias("Top_SKU"))


def unmapped_revenue(p: DataFrame, label: str = UNMAPPED_LABEL) -> DataFrame:
    return p.agg(total_where(F.col("SKU") == label, "Revenue").alias("Unmapped_Revenue"))


def insights(p: DataFrame, label: str = UNMAPPED_LABEL, direction: DataFrame | None = None) -> DataFrame:
    """Leading city and SKU, unmapped revenue and its warning flag as one row, from one scan; and, with the one row of
    ``forecast.forecast_direction``, where the forecast points."""
    sums = per_column(p, {"City": "City", "SKU": "SKU"}, {"Revenue": "Revenue"})
    is_sku, key, revenue = F.col("Label") == "SKU", F.col("Key"), F.col("Revenue")
    city = F.when(~is_sku, key)
    known = F.when(is_sku & (key != label), key)
    found = sums.agg(
        _leader(city, revenue).alias("Top_City"),
        F.coalesce(F.max(F.when(city.isNotNull(), revenue)), F.lit(0)).alias("Top_City_Revenue"),
        _leader(known, revenue).alias("Top_SKU"),
        total_where(is_sku & (key == label), "Revenue").alias("Unmapped_Revenue"),
    ).withColumn("Data_Quality_Warning", F.col("Unmapped_Revenue") > 0)
    if direction is None:
        return found
    return found.withColumn("Direction", direction.select("Direction").scalar())


def yoy_bridge(s: DataFrame, period: Period = Period(), by: str = "Brand") -> DataFrame:
    """Waterfall from the previous to the current year: one step per ``by``, largest gain first.

    A side without sales counts as 0. Empty unless both years have revenue. Steps with a NULL key are left out,
    though their revenue is in the two totals.
    """
    sides = with_sides(s, period).groupBy(by).agg(
        total_where(F.col("_is_current"), "Revenue").alias("cy"),
        total_where(F.col("_is_previous"), "Revenue").alias("py"),
    )
    totals = sides.agg(
        total("cy").alias("cy"), total("py").alias("py"), F.count(by).alias("steps")
    ).where((F.col("cy") > 0) & (F.col("py") > 0))

    def bound(position: Column, label: str, measure: str, value: str) -> Column:
        return F.struct(
            position.alias("Position"), F.lit(label).alias(by), F.lit(measure).alias("Measure"),
            F.col(value).alias("Revenue"),
        )

    bounds = totals.select(F.inline(F.array(
        bound(F.lit(0).cast("long"), "Previous Year", "absolute", "py"),
        bound(F.col("steps") + 1, "Current Year", "total", "cy"),
    )))
    steps = ranked(
        sides.withColumn("Revenue", F.col("cy") - F.col("py")), "Revenue", [by],
        wholes=["cy", "py"], only=F.col(by).isNotNull(),
    )
    relative = steps.where((F.col("Whole_cy") > 0) & (F.col("Whole_py") > 0)).select(
        "Position", by, F.lit("relative").alias("Measure"), "Revenue"
    )
    return bounds.unionByName(relative)


def city_map(
    p: DataFrame,
    coordinates: dict[str, tuple[float, float]] | DataFrame = CITY_COORDINATES,
    default: tuple[float, float] = DEFAULT_COORDINATES,
) -> DataFrame:
    """Revenue and coordinates per city; ``coordinates`` may also be a frame of (city, lat, lon)."""
    cities = _sums(p, ["City"], "Revenue")
    if isinstance(coordinates, DataFrame):
        known = coordinates.toDF("City", "_lat", "_lon")
        cities = cities.join(known, "City", "left")
        lat, lon = F.col("_lat"), F.col("_lon")
    elif coordinates:
        lat, lon = (
            F.create_map(*[F.lit(x) for city, point in coordinates.items() for x in (city, float(point[i]))])[F.col("City")]
            for i in (0, 1)
        )
    else:
        lat = lon = F.lit(None).cast("double")
    return cities.select(
        "City", "Revenue",
        F.coalesce(lat, F.lit(float(default[0]))).alias("lat"),
        F.coalesce(lon, F.lit(float(default[1]))).alias("lon"),
    )


def pareto(p: DataFrame, by: str = "Brand") -> DataFrame:
    """Revenue per ``by`` from largest to smallest with its cumulative share in percent."""
    shares = ranked(_sums(p, [by], "Revenue"), "Revenue", [by])
    return shares.select(
        "Position", by, "Revenue",
        (F.try_divide(F.col("Running").cast("double"), F.col("Whole").cast("double")) * 100).alias("Cumulative_Pct"),
    )


def price_volume(p: DataFrame, by: Sequence[str] = ("Brand",), exclude_brand: str | None = None) -> DataFrame:
    """Revenue, volume and their ratio per group."""
    if exclude_brand is not None:
        p = p.where(F.col("Brand") != exclude_brand)
    groups = _sums(p, by, "Revenue", "Volume")
    return groups.withColumn(
        "Avg_Price", F.try_divide(F.col("Revenue").cast("double"), F.col("Volume").cast("double"))
    )


def brand_positioning(p: DataFrame) -> DataFrame:
    return price_volume(p, ["Brand"], exclude_brand=UNKNOWN_BRAND)


def sku_positioning(p: DataFrame) -> DataFrame:
    """All unmapped items share one SKU label and so form one row per brand."""
    return price_volume(p, ["SKU", "Brand"])
