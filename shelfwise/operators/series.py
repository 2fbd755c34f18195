"""Monthly series. ``series_keys`` makes one series per key (e.g. per brand); without keys there is one.

Windows here run over month totals, never over sale lines: a series has at most one row per calendar month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from ..functions.measures import total


def series_window(series_keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*series_keys) if series_keys else Window.partitionBy(F.lit(0))


def _month_totals(s: DataFrame, series_keys: Sequence[str]) -> DataFrame:
    for key in series_keys:
        s = s.where(F.col(key).isNotNull())
    month = F.trunc("Date", "month").alias("YearMonth")
    return s.groupBy(*series_keys, month).agg(
        total("Revenue").alias("Revenue"), F.max("Date").alias("_last_sale")
    )


def monthly_last(s: DataFrame, measure: str = "Revenue", n: int = 12) -> DataFrame:
    """The last ``n`` months that have sales; months without sales are absent."""
    months = s.groupBy(F.trunc("Date", "month").alias("YearMonth")).agg(total(measure).alias(measure))
    return months.orderBy(F.col("YearMonth").desc()).limit(n)


def observed_months(s: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Gap-filled months with ``Is_Complete``: false for the last month if its sales stop before month end."""
    whole = series_window(series_keys)
    months = _month_totals(s, series_keys).withColumns({
        "_next": F.lead("YearMonth").over(whole.orderBy("YearMonth")),
        "_last_sale": F.max("_last_sale").over(whole),
    })
    until = F.coalesce(F.add_months("_next", -1), F.col("YearMonth"))
    spine = F.explode(F.sequence(F.col("YearMonth"), until, F.expr("interval 1 month")))
    filled = months.select(*series_keys, "YearMonth", "Revenue", "_last_sale", spine.alias("_month"))
    complete = (F.col("_month") < F.trunc("_last_sale", "month")) | (
        F.col("_last_sale") == F.last_day("_last_sale")
    )
    return filled.select(
        *series_keys,
        F.col("_month").alias("YearMonth"),
        F.when(F.col("_month") == F.col("YearMonth"), F.col("Revenue")).otherwise(F.lit(0)).alias("Revenue"),
        complete.alias("Is_Complete"),
    )


def monthly_revenue(s: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Revenue per month, 0 in months without sales between the first and the last."""
    return observed_months(s, series_keys).drop("Is_Complete")


def training_months(s: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Months to learn from: all but an incomplete last one. Judged by the last sale of the series itself."""
    return observed_months(s, series_keys).where("Is_Complete").drop("Is_Complete")
