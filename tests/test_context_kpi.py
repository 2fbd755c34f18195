import pytest

from shelfwise.operators import kpi
from shelfwise.operators.context import Period, apply_context, apply_period, filter_options


@pytest.fixture(scope="module")
def mixed(make_wide):
    return make_wide(
        ("2019-03-01", 10, {"Client": "A", "City": "Oslo", "Brand": "B1"}),
        ("2019-05-01", 20, {"Client": "A", "City": "Bergen", "Brand": None}),
        ("2020-01-15", 30, {"Client": None, "City": "Oslo", "Brand": "B2"}),
        ("2020-02-01", 40, {"Client": "C", "City": "Oslo", "Brand": "B1"}),
    )


def revenues(df):
    return sorted(int(row.Revenue) for row in df.collect())


def test_context_is_a_conjunction_and_matches_null_only_if_listed(mixed):
    assert revenues(apply_context(mixed)) == [10, 20, 30, 40]
    assert revenues(apply_context(mixed, clients=["A", "C"], cities=["Oslo"])) == [10, 40]
    assert revenues(apply_context(mixed, clients=["A", None])) == [10, 20, 30]
    assert revenues(apply_context(mixed, brands=[None])) == [20]
    assert revenues(apply_context(mixed, brands=[])) == []


def test_long_lists_and_frames_give_the_same_rows(spark, mixed):
    many = [f"x{i}" for i in range(500)]
    assert revenues(apply_context(mixed, clients=[*many, "A", "A"])) == [10, 20]
    assert revenues(apply_context(mixed, clients=[*many, "A", None])) == [10, 20, 30]
    assert revenues(apply_context(mixed, clients=spark.createDataFrame([("C",), (None,)], "c string"))) == [30, 40]


def test_options_hold_each_value_once(mixed):
    rows = {(row.Dimension, row.Value): row.Is_Default for row in filter_options(mixed).collect()}
    assert set(rows) == {
        ("Client", "A"), ("Client", None), ("Client", "C"), ("City", "Oslo"), ("City", "Bergen"), ("Brand", "B1"),
        ("Brand", "B2"), ("Brand", None), ("YearMonth", "2019-03"), ("YearMonth", "2019-05"),
        ("YearMonth", "2020-01"), ("YearMonth", "2020-02"),
    }
    assert [key for key, default in rows.items() if key[0] == "YearMonth" and default] == [("YearMonth", "2020-02")]
    assert all(default for key, default in rows.items() if key[0] != "YearMonth")


def test_periods(mixed):
    assert revenues(apply_period(mixed)) == [10, 20, 30, 40]
    assert revenues(apply_period(mixed, Period.of_year())) == [10, 20]
    assert revenues(apply_period(mixed, Period.of_month("2020-01"))) == [30]
    assert revenues(apply_period(mixed, Period.of_month())) == [40]
    for wrong in (("week",), ("year",), ("month", None, "2020-1")):
        with pytest.raises(ValueError):
            Period(*wrong)


def test_totals(mixed):
    row = kpi.kpi_totals(mixed).first()
    assert (float(row.Total_Revenue), row.Total_Volume, row.Avg_Price) == (100.0, 4, 25.0)


def test_everything_is_zero_over_nothing(mixed):
    nothing = mixed.where("false")
    assert [float(value) for value in kpi.kpi_totals(nothing).first()] == [0, 0, 0]
    for period in (Period(), Period.of_year(2020), Period.of_month(), Period.of_month("2020-01")):
        assert [float(value) for value in kpi.yoy(nothing, period).first()] == [0] * 6
        assert [float(value) for value in kpi.gauge(nothing, period).first()] == [0, 0, 0, 100]
        assert [(row.Value, row.Reference) for row in kpi.tile_reference(nothing, period).collect()] == [(0, 0), (0, 0)]
    assert float(kpi.best_year(nothing).first()[0]) == 0


def test_year_to_date_is_cut_at_the_day_of_the_year(make_wide):
    # 2020-03-01 is day 61 of a leap year, and so is 2019-03-02.
    s = make_wide(("2019-01-01", 1), ("2019-03-02", 2), ("2019-03-03", 4), ("2020-01-01", 8), ("2020-03-01", 16))
    row = kpi.yoy(s).first()
    assert (float(row.rev_cy), float(row.rev_py), row.yoy_rev) == (24.0, 3.0, 700.0)
    assert (row.vol_cy, row.vol_py, row.yoy_vol) == (2, 2, 0.0)


def test_year_and_month_compare_with_whole_periods(make_wide):
    s = make_wide(
        ("2018-12-31", 5), ("2019-01-01", 10), ("2019-02-28", 20), ("2020-01-01", 40), ("2020-02-01", 80),
        ("2020-02-02", 100),
    )
    year = kpi.yoy(s, Period.of_year(2019)).first()
    assert (float(year.rev_cy), float(year.rev_py), year.yoy_rev) == (30.0, 5.0, 500.0)
    for month in (Period.of_month(), Period.of_month("2020-02")):
        row = kpi.yoy(s, month).first()
        assert (float(row.rev_cy), float(row.rev_py), row.yoy_rev) == (180.0, 20.0, 800.0)
    first = kpi.yoy(s, Period.of_year(2018)).first()
    assert (float(first.rev_cy), float(first.rev_py), first.yoy_rev) == (5.0, 0.0, 0.0)


def test_best_year_and_gauge(make_wide):
    s = make_wide(("2018-05-01", 300), ("2019-05-01", 100), ("2020-05-01", 200))
    assert float(kpi.best_year(s).first()[0]) == 300
    assert [float(v) for v in kpi.gauge(s, Period.of_year(2019)).first()] == [100, 300, -200, 450]
    assert [float(v) for v in kpi.gauge(s).first()] == [600, 300, 300, 720]


def test_tile_reference(make_wide):
    s = make_wide(("2019-01-10", 100), ("2020-01-20", 150))
    revenue, volume = kpi.tile_reference(s).orderBy("Measure").collect()
    assert (revenue.Value, revenue.Reference) == (250.0, 250 / 1.5)
    assert (volume.Value, volume.Reference, volume.Delta) == (2.0, 2.0, 0.0)
    gone = make_wide(("2019-01-10", 100), ("2020-01-20", 0, {"Volume": 0}))
    assert [row.Reference for row in kpi.tile_reference(gone).collect()] == [None, None]


def test_day_totals_serve_all_tiles(make_wide):
    s = make_wide(("2019-01-10", 1), ("2019-01-10", 2), ("2020-01-20", 4), ("2020-02-20", 8))
    days = kpi.day_totals(s)
    assert days.count() == 3
    for operator in (kpi.yoy, kpi.gauge, kpi.tile_reference):
        for period in (Period(), Period.of_year(2019), Period.of_month()):
            assert operator(days, period).collect() == operator(s, period).collect()
