"""Sums, ratios and the cast to reporting types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def total(measure: Column | str) -> Column:
    """Sum that is 0, not NULL, over no rows."""
    return F.coalesce(F.sum(measure), F.lit(0))


def total_where(condition: Column, measure: Column | str) -> Column:
    column = F.col(measure) if isinstance(measure, str) else measure
    return total(F.when(condition, column))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; 0 where the denominator is not positive."""
    return F.when(
        denominator > 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))


def growth_pct(current: Column, previous: Column) -> Column:
    """Percent change; 0 where there is no previous value to compare with."""
    return F.when(
        previous > 0, (current - previous).cast("double") / previous.cast("double") * 100
    ).otherwise(F.lit(0.0))


def report(df: DataFrame) -> DataFrame:
    """Reporting types: exact decimals become doubles (after all sums) and dates midnight timestamps."""
    targets = {T.DecimalType: "double", T.DateType: "timestamp_ntz"}
    return df.select([
        F.col(f"`{field.name}`").cast(targets[type(field.dataType)]).alias(field.name)
        if type(field.dataType) in targets else F.col(f"`{field.name}`")
        for field in df.schema
    ])
