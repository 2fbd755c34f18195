"""Data-quality audits, computed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.measures import total, total_where
from ..functions.text import parse_price, parse_units
from ..settings import UNMAPPED_LABEL
from .gold import is_sale, reject_reason

KIND_OF_KEY = {"ITEMCODE": "item", "StoreID": "store", "DateKey": "day"}  # in the totals by code and month


def _count(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def audit_keys(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table of ``{name: (frame, key columns)}``: rows, rows with a NULL key, keys held by several rows."""
    reports = []
    for name, (table, keys) in tables.items():
        has_null = F.array_contains(F.array(*[F.col(key).isNull() for key in keys]), True)
        held = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_null", has_null)
        reports.append(held.agg(
            F.lit(name).alias("Table_Name"),
            total("_rows").cast("bigint").alias("Rows"),
            total_where(F.col("_null"), "_rows").cast("bigint").alias("Null_Keys"),
            _count(~F.col("_null") & (F.col("_rows") > 1)).alias("Duplicate_Keys"),
        ))
    return _union(reports)


def audit_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows that repeat another row in all columns."""
    reports = [
        table.groupBy(*[f"`{column}`" for column in table.columns])
        .agg(F.count(F.lit(1)).alias("_rows"))
        .agg(
            F.lit(name).alias("Table_Name"),
            total("_rows").cast("bigint").alias("Rows"),
            total(F.col("_rows") - 1).cast("bigint").alias("Duplicate_Rows"),
        )
        for name, table in tables.items()
    ]
    return _union(reports)


def audit_grain(fact: DataFrame, keys: Sequence[str] = ("StoreID", "ITEMCODE", "DateKey")) -> DataFrame:
    """Key combinations with more than one sale line."""
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("Lines")).where(F.col("Lines") > 1)


def audit_orphans(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension of ``{name: (frame, key)}``: sale lines, their codes and revenue without a dimension row.

    Lines are first added up per key value of each dimension, so a hot key is one row before anything is shuffled or
    joined, and only distinct keys meet the dimensions. NULL keys count as orphans.
    """
    return audit_orphan_scopes(fact, {"": dims}).drop("Scope")


def audit_orphan_scopes(fact: DataFrame, scopes: Mapping[str, Mapping[str, tuple[DataFrame, str]]]) -> DataFrame:
    """As :func:`audit_orphans` against several sets of dimensions of the same names and keys, by ``Scope``. Each
    key column of the fact is read and added up once for all of them."""
    keys = {name: key for dims in scopes.values() for name, (_, key) in dims.items()}
    used = _union([
        fact.groupBy(F.col(key).cast("string").alias("Key"))
        .agg(F.count(F.lit(1)).alias("_lines"), total("Vendas Valor").alias("_revenue"))
        .select(F.lit(name).alias("Label"), "*")
        for name, key in keys.items()
    ])
    return _orphans(used, scopes)


def stored_orphans(months: DataFrame, scopes: Mapping[str, Mapping[str, tuple[DataFrame, str]]]) -> DataFrame:
    """As :func:`audit_orphan_scopes`, from the totals by code and month that loads maintain instead of sale lines.
    ``Orphan_Revenue`` of all months is the same decimal sum."""
    labels = {KIND_OF_KEY[key]: name for dims in scopes.values() for name, (_, key) in dims.items()}
    label = F.coalesce(*[F.when(F.col("Kind") == kind, F.lit(name)) for kind, name in labels.items()])
    sold = months.where(F.col("Kind").isin(*labels) & (F.col("Sold") > 0))
    used = sold.groupBy(label.alias("Label"), F.col("Code").alias("Key")).agg(
        F.sum("Sold").alias("_lines"), total("Revenue").alias("_revenue")
    )
    return _orphans(used, scopes)


def _orphans(used: DataFrame, scopes: Mapping[str, Mapping[str, tuple[DataFrame, str]]]) -> DataFrame:
    """Of codes by ``Label`` and ``Key`` with their lines and revenue: what no dimension row stands for."""
    known = _union([
        dim.select(F.lit(name).alias("Label"), F.col(key).cast("string").alias("Key"), F.lit(scope).alias("Scope"))
        for scope, dims in scopes.items() for name, (dim, key) in dims.items()
    ])
    known = known.groupBy("Label", "Key").agg(F.collect_set("Scope").alias("_scopes"))  # no more than there are scopes
    met = used.join(known, ["Label", "Key"], "left").select(
        "*", F.explode(F.array(*map(F.lit, scopes))).alias("Scope")
    )
    orphan = ~F.coalesce(F.array_contains("_scopes", F.col("Scope")), F.lit(False))
    return met.groupBy("Scope", F.col("Label").alias("Dimension")).agg(
        total_where(orphan, "_lines").cast("bigint").alias("Orphan_Lines"),
        _count(orphan).alias("Orphan_Keys"),
        total_where(orphan, "_revenue").alias("Orphan_Revenue"),
    )


def audit_rejects(bronze_sales: DataFrame) -> DataFrame:
    """Lines the fact leaves out, by reason. Read from the raw feed, where a zero and an unreadable text differ.

    Rejected lines are filtered out first, so that only those few are parsed again for their reason.
    """
    raw = F.col("Vendas Unidades")
    units, price = parse_units(raw), F.coalesce(parse_price(F.col("PVP")), F.lit(0))
    rejected = bronze_sales.where(~is_sale(F.coalesce(units, F.lit(0)), price))
    return rejected.groupBy(reject_reason(raw).alias("Reason")).agg(F.count(F.lit(1)).alias("Lines"))


def stored_rejects(months: DataFrame) -> DataFrame:
    """As :func:`audit_rejects`, from the totals by reason and month that loads maintain."""
    rejected = months.where(F.col("Kind") == "rejected").groupBy(F.col("Code").alias("Reason"))
    return rejected.agg(F.sum("Lines").alias("Lines"))


def _layer_totals(lines: DataFrame, layers: Mapping[str, Column], units: str, revenue: str) -> DataFrame:
    """One row per layer, each a subset of ``lines``; added up per item code first, which also counts the codes."""
    per_code = lines.groupBy("ITEMCODE").agg(*[
        F.struct(
            _count(member).alias("lines"),
            total_where(member, units).alias("units"),
            total_where(member, revenue).alias("revenue"),
        ).alias(layer)
        for layer, member in layers.items()
    ])
    totals = per_code.agg(*[
        F.struct(
            F.lit(layer).alias("Layer"),
            total(f"{layer}.lines").cast("bigint").alias("Lines"),
            _count((F.col(f"{layer}.lines") > 0) & F.col("ITEMCODE").isNotNull()).alias("Codes"),
            total(f"{layer}.units").cast("bigint").alias("Units"),
            total(f"{layer}.revenue").alias("Revenue"),
        ).alias(layer)
        for layer in layers
    ])
    return totals.select(F.inline(F.array(*layers)))


def control_totals(
    silver_sales: DataFrame, fact: DataFrame, wide: DataFrame, label: str = UNMAPPED_LABEL
) -> DataFrame:
    """Lines, item codes, units and revenue per layer, each read from its own table. What silver has beyond the
    rejected lines must be in the fact as stored; equal totals of fact and wide show that mapping unmapped items to a
    label lost nothing."""
    accepted = is_sale(F.col("Vendas_Unidades"), F.col("PVP"))
    cleaned = _layer_totals(
        silver_sales, {"silver": F.lit(True), "rejected": ~accepted}, "Vendas_Unidades", "Vendas_Valor"
    )
    stored = _layer_totals(fact, {"fact": F.lit(True)}, "Vendas Unidades", "Vendas Valor")
    unmapped = F.coalesce(F.col("SKU") == label, F.lit(False))
    joined = _layer_totals(wide, {"wide": F.lit(True), "unmapped": unmapped}, "Volume", "Revenue")
    return cleaned.unionByName(stored).unionByName(joined)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
