"""Totals, year-over-year growth, targets. ``s`` is the filtered frame of all time, ``p`` that of the period.

All operators work on totals per day: one scan of the sales, combined before the shuffle, and a result of at most
one row per calendar day, small enough for whatever window or second aggregation follows. A frame of day totals
can itself be passed as ``s`` (see :func:`day_totals`), so that one scan serves all tiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.measures import growth_pct, ratio, total, total_where
from .context import Period, compared_years, with_calendar, with_last_date


def day_totals(s: DataFrame) -> DataFrame:
    """Revenue and volume per day. Only the date is grouped and read; year and month follow from it."""
    days = s.groupBy("Date").agg(total("Revenue").alias("Revenue"), total("Volume").alias("Volume"))
    return with_calendar(days)


def _sides(period: Period) -> tuple[Column, Column, Column]:
    last_date = F.col("_last_date")
    return period.selects(last_date), period.current(last_date), period.previous(last_date)


def kpi_totals(p: DataFrame) -> DataFrame:
    """Revenue, volume and average price as one row; zeros over no rows."""
    totals = p.agg(total("Revenue").alias("Total_Revenue"), total("Volume").alias("Total_Volume"))
    return totals.withColumn("Avg_Price", ratio(F.col("Total_Revenue"), F.col("Total_Volume")))


def _growth(totals: DataFrame) -> DataFrame:
    return totals.withColumns({
        "yoy_rev": growth_pct(F.col("rev_cy"), F.col("rev_py")),
        "yoy_vol": growth_pct(F.col("vol_cy"), F.col("vol_py")),
    })


def _side_sums(current: Column, previous: Column) -> list[Column]:
    return [
        total_where(side, measure).alias(f"{short}_{name}")
        for measure, short in (("Revenue", "rev"), ("Volume", "vol"))
        for side, name in ((current, "cy"), (previous, "py"))
    ]


def yoy(s: DataFrame, period: Period = Period()) -> DataFrame:
    """Both sides of the comparison and growth in percent (0 without a previous year), one row.

    All-time compares the last year with the one before it up to the same day of the year; a year or a month
    compares with the whole year or month before.
    """
    _, current, previous = _sides(period)
    days = with_last_date(day_totals(compared_years(s, period)))
    return _growth(days.agg(*_side_sums(current, previous)))


def best_year(s: DataFrame) -> DataFrame:
    """Highest revenue of any year, 0 over no rows."""
    years = s.groupBy("Year").agg(total("Revenue").alias("Revenue"))
    return years.agg(F.coalesce(F.max("Revenue"), F.lit(0)).alias("Best_Year_Revenue"))


def gauge(s: DataFrame, period: Period = Period()) -> DataFrame:
    """Revenue of the period against the best year of all time, with the end of the gauge's axis."""
    selected, _, _ = _sides(period)
    years = with_last_date(day_totals(s)).groupBy("Year").agg(
        total("Revenue").alias("_year"), total_where(selected, "Revenue").alias("_period")
    )
    totals = years.agg(
        total("_period").alias("Value"), F.coalesce(F.max("_year"), F.lit(0)).alias("Reference")
    )
    value, reference = F.col("Value").cast("double"), F.col("Reference").cast("double")
    return totals.select(
        "Value",
        "Reference",
        (F.col("Value") - F.col("Reference")).alias("Delta"),
        F.when(reference > 0, F.greatest(reference * 1.5, value * 1.2)).otherwise(F.lit(100.0)).alias("Axis_Max"),
    )


def _tile(measure: str, value: str, growth: str) -> Column:
    shown = F.col(value).cast("double")
    base = F.when(
        F.col(growth) != 0, F.try_divide(shown, 1 + F.col(growth) / 100)
    ).otherwise(shown)
    return F.struct(F.lit(measure).alias("Measure"), shown.alias("Value"), base.alias("Reference"))


def tile_reference(s: DataFrame, period: Period = Period()) -> DataFrame:
    """Per tile (revenue, volume): total of the period, the value growth is measured from, relative delta.

    All-time growth covers the year to date while the total covers all years; the reference value is derived from
    the two as they are. Growth of -100 % has no reference value (NULL).
    """
    selected, current, previous = _sides(period)
    totals = _growth(with_last_date(day_totals(s)).agg(
        *_side_sums(current, previous),
        total_where(selected, "Revenue").alias("_revenue"),
        total_where(selected, "Volume").alias("_volume"),
    ))
    tiles = F.array(_tile("Revenue", "_revenue", "yoy_rev"), _tile("Volume", "_volume", "yoy_vol"))
    return totals.select(F.inline(tiles)).withColumn(
        "Delta", F.try_divide(F.col("Value") - F.col("Reference"), F.col("Reference"))
    )
