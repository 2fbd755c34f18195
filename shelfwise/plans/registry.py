"""Every operator as a query over order-line tables (see ``sources.trade_tables``).

Queries of the load read the derived feeds directly. Queries of the dashboard read the stored star schema, built
once per session and input folder in the shared folder, as a dashboard reads what the load has written.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import city_of, parse_price_any, report
from ..operators import (
    context, contracts, forecast as fc, gold, incremental, kpi, positioning as pos, quality, series, silver, trees,
)
from ..operators.context import Period
from ..sources import trade_tables as tables
from ..sources.feeds import read_bronze, read_bronze_by_name, read_bronze_strict
from ..sources.store import Snapshot, open_snapshot
from ..sources.shared import shared_path
from ..streaming.feed_stream import load_available, sales_stream
from .build import build_gold, gold_layer, load_increment, load_masters, read_quarantine, read_silver, refresh_grain, wide_frame

Query = Callable[[SparkSession, str], DataFrame]

LABELS = {"brand": tables.PARENT_BRAND, "category": tables.PARENT_CATEGORY}
YEAR = Period.of_year(tables.REPORT_YEAR)
MONTH = Period.of_month(tables.REPORT_MONTH)
PANEL = ["Client"]
CLIENTS, CITIES, BRANDS = ["ASIA", "EUROPE", None], ["Unknown", "NATION_2", "NATION_8", "NATION_12"], ["Brand#1", "Brand#12"]
TUNING_GRID = [{"maxIter": trees, "maxDepth": depth} for trees, depth in ((20, 2), (20, 3), (100, 3))]
TUNING_CUTOFF = "2000-11-01"
CSV_FILES = {"header": "true", "escape": '"', "compression": "gzip"}  # feeds as files
ROLLING_CUTOFFS = ["2000-05-01", "2000-11-01", "2001-05-01"]
# A kept model as fixed values: per leaf the tree, the bounds of its features and what it adds.
KEPT_MODEL = [
    (0, {"Lag_1": (None, 1.2e10)}, 1.0e10),
    (0, {"Lag_1": (1.2e10, 1.8e10)}, 1.5e10),
    (0, {"Lag_1": (1.8e10, None)}, 2.2e10),
    (1, {"Rolling_Mean": (None, 1.5e10), "Month": (None, 2.5)}, -5e8),
    (1, {"Rolling_Mean": (None, 1.5e10), "Month": (2.5, None)}, 2.5e9),
    (1, {"Rolling_Mean": (1.5e10, None), "Lag_2": (None, 2.0e10)}, 1.25e9),
    (1, {"Rolling_Mean": (1.5e10, None), "Lag_2": (2.0e10, None)}, -4.5e9),
    (2, {"Time_Index": (None, 84.5)}, 1e8),
    (2, {"Time_Index": (84.5, None)}, -2.5e8),
]

_stored: dict[tuple[str, str, str], str] = {}
_opened: dict[tuple[str, str], Snapshot] = {}
_writing = threading.RLock()


def _once(spark: SparkSession, folder: str, name: str, write: Callable[[str], object]) -> str:
    """Path of a table written once per session and input folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    with _writing:
        if key not in _stored:
            path = shared_path(spark, name)
            write(path)
            _stored[key] = path
        return _stored[key]


def _gold_root(spark: SparkSession, folder: str) -> str:
    return _once(
        spark, folder, "gold", lambda root: build_gold(spark, tables.feeds(spark, folder), root, **LABELS)
    )


def _snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The tables below ``root``, whose loads are all done; opened once, so that their files are listed once."""
    key = (spark.sparkContext.applicationId, root)
    with _writing:
        if key not in _opened:
            _opened[key] = open_snapshot(spark, root)
        return _opened[key]


def star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return _snapshot(spark, _gold_root(spark, folder)).star()


def wide(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot(spark, _gold_root(spark, folder)).table("Sales_Wide")


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot(spark, _gold_root(spark, folder)).table("Sales_Daily")


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver.clean_sales(tables.sales_feed(spark, folder))


def _csv(spark: SparkSession, folder: str) -> str:
    def write(root: str) -> None:
        for feed, df in tables.feeds(spark, folder).items():
            df.write.options(**CSV_FILES).csv(f"{root}/{feed}.csv")

    return _once(spark, folder, "feeds", write)


def _schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned sales from files of three contract versions."""
    def write(root: str) -> None:
        for version, df in tables.versions_of_sales(spark, folder).items():
            df.write.options(**CSV_FILES).csv(f"{root}/{version}")

    path = _once(spark, folder, "feed-versions", write)
    return silver.clean_sales(read_bronze_by_name(spark, path, "Sales", tables.RENAMED))


def _bronze(feed: str) -> Query:
    return lambda spark, folder: read_bronze(spark, f"{_csv(spark, folder)}/{feed}.csv", feed)


def _gold(name: str) -> Query:
    return lambda spark, folder: gold_layer(tables.feeds(spark, folder), **LABELS)[name]


def _gold_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder)["Fact_Sales"]


def _unmapped_items(spark: SparkSession, folder: str) -> DataFrame:
    items = silver.clean_items(tables.items_feed(spark, folder))
    return gold.unmapped_items(_silver(spark, folder), items, **LABELS)


def _store_city(spark: SparkSession, folder: str) -> DataFrame:
    return tables.store_feed(spark, folder).select("StoreID", "Store", city_of(F.col("Store")).alias("City"))


def _wide_city_fallback(spark: SparkSession, folder: str) -> DataFrame:
    stored = star(spark, folder)
    return wide_frame({**stored, "Dim_Store": stored["Dim_Store"].drop("City")})


def _on_daily(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: operator(daily(spark, folder), *args, **kwargs)


def _in_period(operator: Callable[..., DataFrame], period: Period, *args, **kwargs) -> Query:
    return lambda spark, folder: operator(
        context.apply_period(daily(spark, folder), period), *args, **kwargs
    )


def _lines_in(period: Period) -> Query:
    return lambda spark, folder: context.apply_period(wide(spark, folder), period)


def _forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The fitted forecast is stored, so that the three queries on it share one fit."""
    path = _once(
        spark, folder, "forecast", lambda root: fc.forecast(daily(spark, folder)).write.parquet(root)
    )
    return spark.read.parquet(path)


def _forecast_panel(spark: SparkSession, folder: str) -> DataFrame:
    return fc.forecast(daily(spark, folder), PANEL)


def kept_model(spark: SparkSession) -> DataFrame:
    rows = []
    for number, (tree, bounds, value) in enumerate(KEPT_MODEL):
        low, high = zip(*[bounds.get(feature, (None, None)) for feature in fc.FEATURES])
        rows.append((tree, number, list(low), list(high), value))
    return spark.createDataFrame(rows, trees.LEAVES)


def _forecast_kept(spark: SparkSession, folder: str) -> DataFrame:
    return fc.forecast(daily(spark, folder), PANEL, model=kept_model(spark))


def _dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    stored = star(spark, folder)
    return {name: stored[name] for name in ("Dim_Date", "Dim_Item", "Dim_Store")}


def _dq_keys(spark: SparkSession, folder: str) -> DataFrame:
    keys = {"Dim_Date": ["DateKey"], "Dim_Item": ["ITEMCODE"], "Dim_Store": ["StoreID"]}
    audited = {name: (table, keys[name]) for name, table in _dims(spark, folder).items()}
    feeds = tables.feeds(spark, folder)
    audited["Items"] = (feeds["Items"], ["ITEMCODE"])
    audited["Client"] = (feeds["Client"], ["Cliente", "BannerID"])
    return quality.audit_keys(audited)


def _dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    audited = {**_dims(spark, folder), "Items": tables.items_feed(spark, folder)}
    return quality.audit_duplicates(audited)


def _dq_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Against the item master before unmapped items are added, where orphans exist, and against the dimensions."""
    stored = star(spark, folder)
    return quality.audit_orphan_scopes(stored["Fact_Sales"], _orphan_scopes(spark, folder, stored))


def _orphan_scopes(
    spark: SparkSession, folder: str, stored: dict[str, DataFrame]
) -> dict[str, dict[str, tuple[DataFrame, str]]]:
    def dims(items: DataFrame) -> dict[str, tuple[DataFrame, str]]:
        return {
            "Date": (stored["Dim_Date"], "DateKey"), "Item": (items, "ITEMCODE"), "Store": (stored["Dim_Store"], "StoreID")
        }

    return {
        "dimensions": dims(stored["Dim_Item"]), "master": dims(silver.clean_items(tables.items_feed(spark, folder)))
    }


def _dq_orphans_stored(spark: SparkSession, folder: str) -> DataFrame:
    """After two increments, from what the loads keep for each code and month."""
    now = _snapshot(spark, _increments(spark, folder))
    return quality.stored_orphans(now.table("Sold_Months"), _orphan_scopes(spark, folder, now.star()))


def _dq_rejects_stored(spark: SparkSession, folder: str) -> DataFrame:
    return quality.stored_rejects(_snapshot(spark, _increments(spark, folder)).table("Sold_Months"))


def _dq_grain_stored(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot(spark, _increments(spark, folder)).table("Audit_Grain").drop("Ano", "Mes")


def _control_totals(spark: SparkSession, folder: str) -> DataFrame:
    root = _gold_root(spark, folder)
    return quality.control_totals(read_silver(spark, root), star(spark, folder)["Fact_Sales"], wide(spark, folder))


def _contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.contract_violations(read_bronze_strict(spark, f"{_csv(spark, folder)}/Sales.csv", "Sales"))


def _price_regex(spark: SparkSession, folder: str) -> DataFrame:
    return tables.sales_feed(spark, folder).select(
        "SALESDATE", "StoreID", "ITEMCODE", "PVP", parse_price_any(F.col("PVP")).alias("Price")
    )


def _loaded_before(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Cleaned sales, and the part of them an earlier load has already stored."""
    cleaned = read_silver(spark, _gold_root(spark, folder))
    return cleaned, cleaned.where(F.col("Data") <= F.lit(tables.LOADED_UNTIL).cast("date"))


def _incremental_rows(spark: SparkSession, folder: str) -> DataFrame:
    cleaned, earlier = _loaded_before(spark, folder)
    return incremental.incremental_rows(cleaned, gold.fact_sales(earlier))


def _increments(spark: SparkSession, folder: str) -> str:
    """Tables loaded in two steps: a feed of whole days up to a day, then one of all days, which is tried twice."""
    def write(root: str) -> None:
        feeds = tables.feeds(spark, folder)
        until = F.date_format(F.lit(tables.LOADED_UNTIL).cast("date"), "yyyyMMdd")
        earlier = feeds["Sales"].where(F.col("SALESDATE") <= until)
        load_increment(spark, {**feeds, "Sales": earlier}, root, "first", **LABELS)
        refresh_grain(spark, root)
        for _ in range(2):
            load_increment(spark, feeds, root, "second", **LABELS)
            refresh_grain(spark, root)

    return _once(spark, folder, "incremental", write)


def _incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot(spark, _increments(spark, folder)).table("Fact_Sales")


def _incremental_wide(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot(spark, _increments(spark, folder)).table("Sales_Wide")


def _incremental_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot(spark, _increments(spark, folder)).table("Sales_Daily")


def _late_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of which one store in seven reports after all others: a first load without these stores, then a feed of
    everything, twice. What came late has reached its month or, from before the first day allowed, the quarantine."""
    def write(root: str) -> None:
        feeds = tables.feeds(spark, folder)
        load_increment(spark, {**feeds, "Sales": feeds["Sales"].where(~tables.reports_late())}, root, "first", **LABELS)
        for load in ("second", "second under another name"):
            load_increment(spark, feeds, root, load, lateness=tables.LATENESS_DAYS, **LABELS)

    stored = _snapshot(spark, _once(spark, folder, "late-lines", write)).table("Silver_Sales")
    return stored.select("DateKey", "StoreID", "ITEMCODE", "Vendas_Unidades", "PVP", "Reason", "Line")


def _late_master(spark: SparkSession, folder: str) -> DataFrame:
    """The wide frame after the items, stores and clients that the first load lacked have come into the masters."""
    def write(root: str) -> None:
        feeds = tables.feeds(spark, folder)
        build_gold(spark, {**feeds, **tables.early_masters(feeds)}, root, **LABELS)
        load_masters(spark, feeds, root, "masters", **LABELS)

    return _snapshot(spark, _once(spark, folder, "late-master", write)).table("Sales_Wide")


def _stream_load(spark: SparkSession, folder: str) -> DataFrame:
    def write(root: str) -> None:
        masters = {name: feed for name, feed in tables.feeds(spark, folder).items() if name != "Sales"}
        stream = sales_stream(spark, f"{_csv(spark, folder)}/Sales.csv")
        load_available(stream, masters, root, f"{root}/_progress", **LABELS).awaitTermination()

    return _snapshot(spark, _once(spark, folder, "streamed", write)).table("Fact_Sales")


def _quarantined_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The sales as a file in which some lines have an unquoted thousands comma, some are cut short, and some have a
    month 13; loaded, and what is in quarantine. The file is written as text, a line per sale."""
    def write(root: str) -> None:
        lines = tables.broken_sales(spark, folder)
        lines.select("Line").write.option("compression", CSV_FILES["compression"]).text(f"{root}/Sales.csv")
        feeds = {**tables.feeds(spark, folder), "Sales": read_bronze_strict(spark, f"{root}/Sales.csv", "Sales", header=False)}
        build_gold(spark, feeds, f"{root}/tables", **LABELS)

    return read_quarantine(spark, f"{_once(spark, folder, 'quarantine', write)}/tables").drop("Load")


def _queries() -> dict[str, Query]:
    return {
        # Sources and cleansing
        "bronze_sales": _bronze("Sales"),
        "bronze_items": _bronze("Items"),
        "bronze_store": _bronze("Store"),
        "bronze_client": _bronze("Client"),
        "silver_sales": _silver,
        "silver_items": lambda spark, folder: silver.clean_items(tables.items_feed(spark, folder)),
        # Star schema
        "calendar_bounds": lambda spark, folder: gold.year_bounds(_silver(spark, folder)),
        "gold_fact_sales": _gold("Fact_Sales"),
        "gold_unmapped_items": _unmapped_items,
        "gold_dim_item": _gold("Dim_Item"),
        "gold_dim_store": _gold("Dim_Store"),
        "gold_dim_date": _gold("Dim_Date"),
        "gold_roundtrip": _gold_roundtrip,
        "store_city": _store_city,
        "sales_wide": lambda spark, folder: wide_frame(star(spark, folder)),
        "sales_wide_stored": wide,
        "sales_wide_city_fallback": _wide_city_fallback,
        # Filter context and period
        "filter_options": _on_daily(context.filter_options),
        "filter_context": lambda spark, folder: context.apply_context(wide(spark, folder), CLIENTS, CITIES, BRANDS),
        "period_year": _lines_in(YEAR),
        "period_month": _lines_in(MONTH),
        "period_month_latest": _lines_in(Period.of_month()),
        # KPIs
        "kpi_totals": _on_daily(kpi.kpi_totals),
        "empty_selection": lambda spark, folder: kpi.kpi_totals(
            context.apply_context(daily(spark, folder), brands=["no such brand"])
        ),
        "kpi_totals_year": _in_period(kpi.kpi_totals, YEAR),
        "yoy_ytd": _on_daily(kpi.yoy),
        "yoy_year": _on_daily(kpi.yoy, YEAR),
        "yoy_month": _on_daily(kpi.yoy, MONTH),
        "yoy_month_latest": _on_daily(kpi.yoy, Period.of_month()),
        "best_year": _on_daily(kpi.best_year),
        "gauge_target": _on_daily(kpi.gauge, YEAR),
        "kpi_tile_reference": _on_daily(kpi.tile_reference),
        # Monthly series
        "monthly_last12": _on_daily(series.monthly_last, "Revenue"),
        "monthly_last12_volume": _on_daily(series.monthly_last, "Volume"),
        "monthly_revenue": _on_daily(series.monthly_revenue),
        "monthly_revenue_panel": _on_daily(series.monthly_revenue, ["Brand", "City"]),
        "training_months": _on_daily(series.training_months),
        # Forecast
        "forecast_gate": _on_daily(fc.forecast_gate, PANEL),
        "forecast_features": lambda spark, folder: fc.forecast_features(series.training_months(daily(spark, folder))),
        "forecast_features_leak_free": lambda spark, folder: fc.forecast_features(
            series.training_months(daily(spark, folder), PANEL), PANEL, leak_free=True
        ),
        "forecast_horizon": _on_daily(fc.forecast_horizon),
        "forecast_6m": _forecast,
        "forecast_series": lambda spark, folder: fc.forecast_series(daily(spark, folder), _forecast(spark, folder)),
        "forecast_direction": lambda spark, folder: fc.forecast_direction(_forecast(spark, folder)),
        "forecast_panel": _forecast_panel,
        "forecast_baseline": _on_daily(fc.forecast_baseline),
        "forecast_baseline_series": lambda spark, folder: fc.forecast_series(
            daily(spark, folder), fc.forecast_baseline(daily(spark, folder))
        ),
        "forecast_baseline_direction": lambda spark, folder: fc.forecast_direction(
            fc.forecast_baseline(daily(spark, folder), PANEL), PANEL, fc.forecast_gate(daily(spark, folder), PANEL)
        ),
        "forecast_kept_model": _forecast_kept,
        "forecast_kept_direction": lambda spark, folder: fc.forecast_direction(_forecast_kept(spark, folder), PANEL),
        "forecast_rolling": _on_daily(fc.rolling_origin, TUNING_GRID[:1], ROLLING_CUTOFFS, PANEL),
        "forecast_rolling_baseline": _on_daily(fc.rolling_origin, [], ROLLING_CUTOFFS),
        "forecast_tuning": _on_daily(fc.tune_forecast, TUNING_GRID, TUNING_CUTOFF),
        # Ranking, contribution, positioning
        "top_city": _in_period(pos.top_city, YEAR),
        "top_sku": _in_period(pos.top_sku, YEAR),
        "unmapped_revenue": _in_period(pos.unmapped_revenue, YEAR),
        "insights": lambda spark, folder: pos.insights(
            daily(spark, folder), direction=fc.forecast_direction(fc.forecast_baseline(daily(spark, folder)))
        ),
        "yoy_bridge": _on_daily(pos.yoy_bridge),
        "yoy_bridge_year": _on_daily(pos.yoy_bridge, YEAR),
        "yoy_bridge_sku": _on_daily(pos.yoy_bridge, MONTH, "SKU"),
        "city_map": _on_daily(pos.city_map, CITY_POINTS),
        "pareto_brand": _on_daily(pos.pareto),
        "pareto_sku": _on_daily(pos.pareto, "SKU"),
        "price_volume_brand": _on_daily(pos.brand_positioning),
        "price_volume_sku": _on_daily(pos.sku_positioning),
        # Data quality
        "dq_keys": _dq_keys,
        "dq_dim_duplicates": _dq_duplicates,
        "dq_fact_grain": lambda spark, folder: quality.audit_grain(star(spark, folder)["Fact_Sales"]),
        "dq_orphans": _dq_orphans,
        "dq_rejects": lambda spark, folder: quality.audit_rejects(tables.sales_feed(spark, folder)),
        "dq_orphans_stored": _dq_orphans_stored,
        "dq_rejects_stored": _dq_rejects_stored,
        "dq_grain_stored": _dq_grain_stored,
        "control_totals": _control_totals,
        # Contracts and incremental load
        "contract_violations": _contract_violations,
        "schema_drift": _schema_drift,
        "price_regex_parse": _price_regex,
        "incremental_rows": _incremental_rows,
        "incremental_load": _incremental_load,
        "incremental_wide": _incremental_wide,
        "incremental_daily": _incremental_daily,
        "sales_daily": daily,
        "late_lines": _late_lines,
        "late_master": _late_master,
        "quarantined_sales": _quarantined_sales,
        "stream_fact_load": _stream_load,
    }


# Coordinates for some cities of these tables; the others get the default.
CITY_POINTS = {"NATION_2": (12.5, -45.25), "NATION_8": (33.75, 7.125)}


def queries() -> dict[str, Query]:
    def reported(query: Query) -> Query:
        return lambda spark, folder: report(query(spark, folder))

    return {name: reported(query) for name, query in _queries().items()}
