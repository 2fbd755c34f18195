"""Column expressions that turn feed text into typed values. No UDF: all of it stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..settings import PRICE_PRECISION, PRICE_SCALE, UNKNOWN_CITY


def date_key(day: Column) -> Column:
    return F.trim(day.cast("string"))


def parse_day(day: Column, lenient: bool = False) -> Column:
    """yyyymmdd to a date. A malformed value fails the load, whatever the session's ANSI mode; with ``lenient`` it
    becomes NULL."""
    key = date_key(day)
    parsed = F.try_to_date(key, "yyyyMMdd")
    if lenient:
        return parsed
    wrong = F.raise_error(F.concat(F.lit("malformed date: "), key)).cast("date")
    return F.when(parsed.isNull() & key.isNotNull(), wrong).otherwise(parsed)


def parse_units(units: Column) -> Column:
    """Whole units; ``,`` is a thousands mark, a fraction rounds half away from zero, other text is NULL."""
    digits = F.replace(units.cast("string"), F.lit(","), F.lit(""))
    rounded = F.round(digits.try_cast("decimal(38,18)"), 0).try_cast("int")
    # Almost every value is a plain integer: the decimal path runs only where that cast fails.
    return F.coalesce(digits.try_cast("int"), rounded)


def parse_price(price: Column, scale: int = PRICE_SCALE, precision: int = PRICE_PRECISION) -> Column:
    """Price without the euro mark. A decimal comma is not understood and gives NULL."""
    bare = F.replace(F.replace(price.cast("string"), F.lit(" €"), F.lit("")), F.lit("€"), F.lit(""))
    return bare.try_cast(f"decimal({precision},{scale})")


def parse_price_any(price: Column, scale: int = PRICE_SCALE) -> Column:
    """First number in a text of any currency, with a decimal point or comma and any grouping mark.

    With both marks present the last one is the decimal mark. With one kind only, ``1,234`` and ``1.234.567``
    are grouped integers; everything else (``1,99``, ``0.500``) is a decimal.
    """
    text = price.cast("string")
    joined = F.regexp_replace(text, r"(?<=[0-9])[ '’\u00a0\u202f](?=[0-9]{3}(?![0-9]))", "")
    number = F.regexp_extract(joined, "[0-9]+([.,][0-9]+)*", 0)
    grouped = number.rlike(r"^[1-9][0-9]{0,2}((,[0-9]{3})+|(\.[0-9]{3})+)$")
    has_mark = number.rlike("[.,]")
    whole = F.regexp_replace(F.regexp_extract(number, "^(.*)[.,]([0-9]+)$", 1), "[.,]", "")
    fraction = F.regexp_extract(number, "^(.*)[.,]([0-9]+)$", 2)
    plain = (
        F.when(grouped, F.regexp_replace(number, "[.,]", ""))
        .when(has_mark, F.concat(whole, F.lit("."), fraction))
        .otherwise(number)
    )
    sign = F.when(text.rlike("^[^0-9]*-"), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, plain).try_cast(f"decimal({PRICE_PRECISION},{scale})")


def city_of(store: Column) -> Column:
    """Text after the last hyphen of a store name, or ``Unknown`` if there is none."""
    tail = F.split_part(store, F.lit("-"), F.lit(-1))
    return F.when(store.contains("-"), F.regexp_replace(tail, r"^\p{Zs}+|\p{Zs}+$", "")).otherwise(
        F.lit(UNKNOWN_CITY)
    )
