"""Which lines of a feed an increment takes (see ``plans.build.load_increment``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# What tells lines apart, as a feed has no number for a line; lines that agree in all of it are told apart by counting.
LINE_KEY = ("DateKey", "StoreID", "ITEMCODE", "Vendas_Unidades", "PVP")


def incremental_rows(silver_sales: DataFrame, stored_fact: DataFrame) -> DataFrame:
    """Cleaned sales from the last stored day on, as lines of that day may have arrived since; all of them, with or
    without a date, if nothing is stored.

    The day is the parsed date, not its text, and is looked up in the newest stored month only.
    """
    month = F.col("Ano") * 12 + F.col("Mes")
    newest = stored_fact.select(F.max(month)).scalar()
    last = stored_fact.where(month == newest).select(F.max(F.try_to_date("DateKey", "yyyyMMdd"))).scalar()
    return silver_sales.where(last.isNull() | (F.col("Data") >= last))


def _hash_parts(key: Sequence[str]) -> list[Column]:
    """Four 32-bit parts of two hashes of a line. A hash passes over NULLs, so where they stand is hashed too."""
    nulls = F.concat(*[F.when(F.col(name).isNull(), F.lit("0")).otherwise(F.lit("1")) for name in key])
    hashes = [F.xxhash64(F.lit(seed), nulls, *key) for seed in (1, 2)]
    return [part for one in hashes for part in (one.bitwiseAND(F.lit(2**32 - 1)), F.shiftrightunsigned(one, 32))]


def differing_days(lines: DataFrame, stored: DataFrame, key: Sequence[str] = LINE_KEY, day: str = "Data") -> DataFrame:
    """The days of ``lines`` on which these are not those ``stored``, each as often; equal lines have the same day.

    A day is told by the number of its lines and the sums of 128 bits of their hashes, which leave each task as one row:
    no line is shuffled for a day that is stored as it is. Sums of 32 bits have room for 2^31 lines a day.
    """
    def signed(frame: DataFrame, sign: int) -> DataFrame:
        parts = [(part * F.lit(sign).cast("long")).alias(f"_h{i}") for i, part in enumerate(_hash_parts(key))]
        return frame.select(day, F.lit(sign).alias("_n"), *parts)

    sums = ["_n", *[f"_h{i}" for i in range(4)]]
    both = signed(lines, 1).unionAll(signed(stored, -1)).groupBy(day).agg(
        F.max("_n").alias("_side"), *[F.sum(name).alias(name) for name in sums]
    )
    unequal = " OR ".join(f"{name} <> 0" for name in sums)
    return both.where(f"_side = 1 AND ({unequal})").select(day)


def beyond_stored(lines: DataFrame, stored: DataFrame, key: Sequence[str] = LINE_KEY) -> DataFrame:
    """The lines that ``stored`` does not have: of n equal lines, where m are stored, n - m.

    Loading a feed again therefore adds nothing, whatever it is called. Both sides are counted in one aggregation, added
    up on the map side first: a line that is there a million times leaves each task as one row, and no line is compared
    with another. Only lines of which some are new are looked up again for their other columns.
    """
    others = [name for name in lines.columns if name not in key]
    both = lines.select(*key, F.lit(1).alias("_n")).unionAll(stored.select(*key, F.lit(-1).alias("_n")))
    counts = both.groupBy(*[F.col(name).alias(f"_{name}") for name in key]).agg(F.sum("_n").alias("_left")).where("_left > 0")
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in key]
    found = lines.join(counts, same).groupBy(*key).agg(
        F.max("_left").cast("int").alias("_left"), *[F.first(name).alias(name) for name in others]
    )
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_left"))).select(lines.columns)
