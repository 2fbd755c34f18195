"""Cleansing: raw text feeds to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import date_key, parse_day, parse_price, parse_units
from ..schemas import SALES
from ..settings import PRICE_PRECISION, PRICE_SCALE
from ..sources.feeds import CORRUPT
from .gold import is_sale, reject_reason

WRONG_FIELD_COUNT, MISSING_DATE, UNREADABLE_DATE = "wrong field count", "missing date", "unreadable date"


def revenue() -> Column:
    """Of a cleaned line, exact."""
    return F.col("Vendas_Unidades") * F.col("PVP")


def clean_sales(
    bronze_sales: DataFrame, *, lenient_dates: bool = False, price_scale: int = PRICE_SCALE, also: Sequence[str] = ()
) -> DataFrame:
    """Typed sale lines with revenue, and the columns ``also`` as they are. Unreadable units and prices count as 0; a malformed date fails the load
    unless ``lenient_dates``. One projection, no shuffle, works on streams too."""
    day = F.col("SALESDATE")
    units = F.coalesce(parse_units(F.col("Vendas Unidades")), F.lit(0))
    price = F.coalesce(parse_price(F.col("PVP"), price_scale), F.lit(0).cast(f"decimal({PRICE_PRECISION},{price_scale})"))
    typed = bronze_sales.select(
        date_key(day).alias("DateKey"),
        parse_day(day, lenient_dates).alias("Data"),
        "StoreID",
        "ITEMCODE",
        units.alias("Vendas_Unidades"),
        price.alias("PVP"),
        *also,
    )
    return typed.withColumn("Vendas_Valor", revenue())


def stage_sales(
    bronze_sales: DataFrame, load: str = "full", *, lenient_dates: bool = False, price_scale: int = PRICE_SCALE
) -> DataFrame:
    """Every line of the feed as it is stored: cleaned, with its month and the name of the ``load`` that brings it.

    A line with a wrong number of fields (if the feed was read with ``read_bronze_strict``) or without a readable
    date has a ``Reason``, its text and no month: it is in quarantine. With ``lenient_dates`` the date is no reason.
    ``Rejected`` says why a line that is understood is no sale; only such lines are parsed again for it.
    """
    raw = bronze_sales.withColumns({
        "_Broken": F.col(CORRUPT) if CORRUPT in bronze_sales.columns else F.lit(None).cast("string"), "_Price": F.col("PVP"),
    })
    # The date is parsed once and what is wrong with it told from the result.
    typed = clean_sales(
        raw, lenient_dates=True, price_scale=price_scale, also=["SALESDATE", "Vendas Unidades", "_Price", "_Broken"]
    )
    reason = F.when(F.col("_Broken").isNotNull(), F.lit(WRONG_FIELD_COUNT))
    if not lenient_dates:
        reason = reason.when(F.col("SALESDATE").isNull(), F.lit(MISSING_DATE)).when(F.col("Data").isNull(), F.lit(UNREADABLE_DATE))
    came = {name: F.col(f"`{name}`") for name in SALES.fieldNames()} | {"PVP": F.col("_Price")}
    text = F.to_csv(F.struct(*[column.alias(name) for name, column in came.items()]))
    cleaned = typed.withColumn("_Reason", reason).withColumn(
        "_Line", F.when(F.col("_Reason").isNotNull(), F.coalesce("_Broken", text))
    )
    sale = is_sale(F.col("Vendas_Unidades"), F.col("PVP"))
    dated = F.col("_Reason").isNull()
    return cleaned.select(
        *[column for column in cleaned.columns if column not in ("SALESDATE", "Vendas Unidades") and not column.startswith("_")], F.lit(load).alias("Load"),
        F.col("_Reason").alias("Reason"), F.col("_Line").alias("Line"),
        F.when(~sale, reject_reason(F.col("Vendas Unidades"))).alias("Rejected"),
        F.when(dated, F.year("Data")).alias("Ano"), F.when(dated, F.month("Data")).alias("Mes"),
    )


def clean_items(bronze_items: DataFrame) -> DataFrame:
    """Item master without its blank rows."""
    return bronze_items.where(F.col("ITEMCODE").isNotNull())
