"""Global rank and running total without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.shared import materialized


def ranked(
    df: DataFrame, value: str, tie_break: list[str], wholes: Sequence[str] = (), only: Column | None = None
) -> DataFrame:
    """Add ``Position`` (1 = largest ``value``), ``Running`` (sum down to this row) and ``Whole`` (sum of all).

    A distributed prefix sum: rows are dealt into ranges of (value, tie break), so that equal values are dealt by their
    keys, and stored with the number of their range, as ranges drawn a second time may differ. Each range is ranked in
    its own task; what precedes it is added from the totals of the ranges, of which there is one per shuffle partition.

    ``wholes`` names further columns to sum over all rows (``Whole_<name>``). Rows where ``only`` is false are in
    these sums but are not ranked and not in the result.
    """
    ranks = F.lit(True) if only is None else only
    order = [F.col(value).desc(), *[F.col(column).asc_nulls_last() for column in tie_break]]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_ranks", ranks.cast("int")).repartitionByRange(ranges, *order)
    dealt = materialized(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    ranked_value = F.when(F.col("_ranks") == 1, F.col(value)).otherwise(F.lit(0))
    totals = (
        dealt.groupBy("_range")
        .agg(
            F.sum("_ranks").alias("_rows"),
            F.sum(ranked_value).alias("_sum"),
            *[F.sum(column).alias(f"_{column}") for column in wholes],
        )
        .select(
            "_range",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
            F.sum("_sum").over(everything).alias("Whole"),
            *[F.sum(f"_{column}").over(everything).alias(f"Whole_{column}") for column in wholes],
        )
    )
    ranked_rows = dealt.withColumns({
        "_rank": F.sum("_ranks").over(within), "_running": F.sum(ranked_value).over(within)
    })
    if only is not None:
        ranked_rows = ranked_rows.where(F.col("_ranks") == 1)
    return ranked_rows.join(F.broadcast(totals), "_range").select(
        *[f"`{column}`" for column in df.columns],
        (F.col("_rows_before") + F.col("_rank")).alias("Position"),
        (F.col("_sum_before") + F.col("_running")).alias("Running"),
        "Whole",
        *[f"Whole_{column}" for column in wholes],
    )
