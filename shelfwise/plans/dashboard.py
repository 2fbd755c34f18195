"""Everything one look at the dashboard shows, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame

from ..operators import forecast as fc, kpi, positioning as pos, series
from ..operators.context import Period, apply_context, apply_period
from ..settings import UNMAPPED_LABEL
from ..sources.shared import materialized


def dashboard(
    daily: DataFrame,
    period: Period = Period(),
    *,
    clients: Sequence[str | None] | None = None,
    cities: Sequence[str | None] | None = None,
    brands: Sequence[str | None] | None = None,
    label: str = UNMAPPED_LABEL,
    with_forecast: bool = True,
    model: Model | DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Result tables for a filter context and period, from the stored daily totals (``plans.build.read_daily``) or any
    frame of their columns, such as the wide one.

    Tiles, growth, targets and monthly series share one frame of day totals, stored because it has at most one row per
    calendar day; the other tables each scan the columns they need. With a ``model`` that ``forecast.fit_forecast`` gave
    after the last load, or its stored table of leaves, no look at the dashboard fits one.
    """
    s = apply_context(daily, clients, cities, brands)
    p = apply_period(s, period)
    days = materialized(kpi.day_totals(s), "day-totals")
    tables = {
        "totals": kpi.kpi_totals(apply_period(days, period)),
        "growth": kpi.yoy(days, period),
        "best_year": kpi.best_year(days),
        "gauge": kpi.gauge(days, period),
        "tiles": kpi.tile_reference(days, period),
        "revenue_months": series.monthly_last(days, "Revenue"),
        "volume_months": series.monthly_last(days, "Volume"),
        "bridge": pos.yoy_bridge(s, period),
        "city_map": pos.city_map(p),
        "pareto": pos.pareto(p),
        "brands": pos.brand_positioning(p),
        "skus": pos.sku_positioning(p),
    }
    direction = None
    if with_forecast:
        predicted = materialized(fc.forecast(days, model=model), "forecast")
        direction = fc.forecast_direction(predicted)
        tables |= {"forecast": fc.forecast_series(days, predicted), "direction": direction}
    return tables | {"insights": pos.insights(p, label, direction)}
