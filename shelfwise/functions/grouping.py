"""Grouping by several columns at once, each on its own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .measures import total


def per_column(df: DataFrame, columns: Mapping[str, str], sums: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Sums of ``df`` once per value of each column of ``{label: column}``, in a single scan.

    Gives ``Label`` (which column), ``Key`` (its value, as text) and the ``sums`` by name. Rows are added up per
    combination of all columns first, so only combinations, not rows, are copied for each grouping; and before each
    shuffle on the map side, so a value that holds most rows costs no more than others.
    """
    names, sums = list(columns.values()), dict(sums or {})
    combined = df.groupBy(*names).agg(*[total(value).alias(name) for name, value in sums.items()]) if sums else (
        df.select(*names).distinct()
    )
    sets = combined.groupingSets([[name] for name in names], *names).agg(
        *[F.grouping(name).alias(f"_left_out_{i}") for i, name in enumerate(names)],
        *[total(name).alias(name) for name in sums],
    )
    label, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (text, name) in enumerate(columns.items()):
        grouped_by = F.col(f"_left_out_{i}") == 0
        label = F.when(grouped_by, F.lit(text)).otherwise(label)
        key = F.when(grouped_by, F.col(name).cast("string")).otherwise(key)
    return sets.select(label.alias("Label"), key.alias("Key"), *sums)
