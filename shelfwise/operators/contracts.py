"""Contract of the sales feed, checked row by row."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import parse_day, parse_price, parse_units
from ..sources.feeds import CORRUPT
from .silver import WRONG_FIELD_COUNT

MISSING, UNREADABLE, INEXACT = "missing", "unreadable", "inexact"


def contract_violations(bronze_sales: DataFrame) -> DataFrame:
    """One row per broken rule: which field, its text, and whether it is missing, unreadable or (a price with more
    decimals than are kept) inexact.

    Keys and date must be present, units and price present and readable. If the feed was read with
    ``read_bronze_strict``, a line with too few or too many fields is one violation of its own.
    """

    fields = {
        "SALESDATE": parse_day(F.col("SALESDATE"), lenient=True),
        "StoreID": F.col("StoreID"),
        "ITEMCODE": F.col("ITEMCODE"),
        "Vendas Unidades": parse_units(F.col("Vendas Unidades")),
        "PVP": parse_price(F.col("PVP")),
    }

    rounded = parse_price(F.col("PVP"), 18, 38) != fields["PVP"]

    def check(field: str, parsed: Column) -> Column:
        value = F.col(f"`{field}`")
        rule = F.when(value.isNull(), F.lit(MISSING)).when(parsed.isNull(), F.lit(UNREADABLE))
        if field == "PVP":
            rule = rule.when(rounded, F.lit(INEXACT))
        return F.struct(F.lit(field).alias("Field"), value.alias("Value"), rule.alias("Rule"))

    found = F.filter(
        F.array(*[check(field, parsed) for field, parsed in fields.items()]), lambda one: one["Rule"].isNotNull()
    )
    # A missing value has no parsed one either, so this alone finds the broken lines; the list is for them only.
    is_broken = reduce(or_, [parsed.isNull() for parsed in fields.values()]) | F.coalesce(rounded, F.lit(False))
    if CORRUPT in bronze_sales.columns:
        line = F.struct(
            F.lit("line").alias("Field"), F.col(CORRUPT).alias("Value"), F.lit(WRONG_FIELD_COUNT).alias("Rule")
        )
        is_broken = F.col(CORRUPT).isNotNull() | is_broken
        found = F.when(F.col(CORRUPT).isNotNull(), F.array(line)).otherwise(found)
    return bronze_sales.where(is_broken).select("SALESDATE", "StoreID", "ITEMCODE", F.inline(found))
