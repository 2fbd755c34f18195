import sys

import pytest

from shelfwise import __main__ as command
from shelfwise.settings import CONTRACTION, GROWTH
from shelfwise.operators import context, forecast as fc, kpi, positioning as pos, series
from shelfwise.operators.context import Period
from shelfwise.plans.build import build_gold, read_silver, read_wide
from shelfwise.plans.dashboard import dashboard
from shelfwise.settings import size_settings
from shelfwise.sources import trade_tables as tables


@pytest.mark.parametrize("period", [Period(), Period.of_year(2000), Period.of_month()])
def test_dashboard_equals_the_single_operators(table_wide, period):
    clients, brands = ["ASIA", "EUROPE"], [f"Brand#{i}" for i in range(1, 13)]
    s = context.apply_context(table_wide, clients, brands=brands)
    p = context.apply_period(s, period)
    shown = dashboard(table_wide, period, clients=clients, brands=brands, with_forecast=False)
    expected = {
        "totals": kpi.kpi_totals(p), "growth": kpi.yoy(s, period), "best_year": kpi.best_year(s),
        "gauge": kpi.gauge(s, period), "tiles": kpi.tile_reference(s, period),
        "revenue_months": series.monthly_last(s), "volume_months": series.monthly_last(s, "Volume"),
        "insights": pos.insights(p), "bridge": pos.yoy_bridge(s, period), "city_map": pos.city_map(p),
        "pareto": pos.pareto(p), "brands": pos.brand_positioning(p), "skus": pos.sku_positioning(p),
    }
    assert set(shown) == set(expected)
    for name, table in expected.items():
        assert sorted(map(str, shown[name].collect())) == sorted(map(str, table.collect())), name


def test_day_totals_give_the_same_series_and_gate(table_wide):
    days = kpi.day_totals(table_wide)
    assert sorted(series.monthly_revenue(days).collect()) == sorted(series.monthly_revenue(table_wide).collect())
    assert fc.forecast_horizon(days).collect() == fc.forecast_horizon(table_wide).collect()


def test_load_and_show_commands(spark, testdata, tmp_path, monkeypatch, capsys):
    raw, stored = tmp_path / "raw", str(tmp_path / "tables")
    for name, feed in tables.feeds(spark, testdata).items():
        feed.write.option("header", True).csv(str(raw / f"{name}.csv"))
    monkeypatch.setattr(sys, "argv", ["shelfwise", "load", str(raw), stored])
    command.main()
    assert read_silver(spark, stored).count() == tables.sales_feed(spark, testdata).count()
    monkeypatch.setattr(sys, "argv", ["shelfwise", "show", stored, "--month", "2000-06", "--brand", "Brand#2", "--no-forecast"])
    command.main()
    assert "pareto" in capsys.readouterr().out


def test_commands_with_another_column_order_and_a_kept_model(spark, testdata, tmp_path, monkeypatch, capsys):
    raw, stored, model = tmp_path / "raw", str(tmp_path / "tables"), str(tmp_path / "model")
    for name, feed in tables.feeds(spark, testdata).items():
        feed = feed.select(*reversed(feed.columns)).withColumnRenamed("SALESDATE", "Day")
        feed.write.option("header", True).csv(str(raw / f"{name}.csv"))
    for line in (["load", str(raw), stored, "--renamed", "Day=SALESDATE"], ["fit", stored, model, "--brand", "Brand#2"]):
        monkeypatch.setattr(sys, "argv", ["shelfwise", *line])
        command.main()
    assert read_silver(spark, stored).count() == tables.sales_feed(spark, testdata).count()
    monkeypatch.setattr(fc, "fit_model", None)
    monkeypatch.setattr(sys, "argv", ["shelfwise", "show", stored, "--brand", "Brand#2", "--model", model])
    command.main()
    shown = capsys.readouterr().out
    assert "direction" in shown and (GROWTH in shown or CONTRACTION in shown)


def test_finer_prices_are_stored_and_summed_exactly(spark, tmp_path):
    from shelfwise import schemas

    feeds = {
        "Sales": spark.createDataFrame([("20200101", "S1", "I1", "3", "0.1254")], schemas.SALES),
        "Items": spark.createDataFrame([("I1", "Cola", "Drinks", "B1", "Small")], schemas.ITEMS),
        "Store": spark.createDataFrame([("S1", "Mart", "Mart - Oslo", "A", "B1")], schemas.STORE),
        "Client": spark.createDataFrame([("B1", "Mart", "Mart", "A")], schemas.CLIENT),
    }
    build_gold(spark, feeds, str(tmp_path), price_scale=4)
    assert str(read_wide(spark, str(tmp_path), 4).first().Revenue) == "0.3762"


def test_size_settings():
    assert size_settings(10**9) == {"spark.sql.shuffle.partitions": "200"}
    assert size_settings(10**12)["spark.sql.shuffle.partitions"] == "4769"
    assert size_settings(100 * 10**12)["spark.sql.shuffle.partitions"] == "476838"
