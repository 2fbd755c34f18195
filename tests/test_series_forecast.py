import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from shelfwise.operators import forecast as fc, series


def months(df, *columns):
    return [tuple(row[c] for c in columns) for row in df.orderBy("YearMonth").collect()]


def month(year, number):
    return dt.date(year, number, 1)


def history(make_wide, count, last_day=28, brand="B1", seed=0, skip=()):
    """One sale per month from January 2018 on, the last one on ``last_day``."""
    random.seed(seed)
    lines = []
    for i in range(count):
        if i not in skip:
            day = last_day if i == count - 1 else 15
            lines.append((f"{2018 + i // 12}-{i % 12 + 1:02d}-{day:02d}", random.randint(100, 900), {"Brand": brand}))
    return make_wide(*lines)


def test_last_months_leave_gaps_and_keep_the_incomplete_one(make_wide):
    s = make_wide(("2019-01-05", 1), ("2019-01-31", 2), ("2019-04-02", 4), ("2019-05-01", 8))
    rows = months(series.monthly_last(s, n=2), "YearMonth", "Revenue")
    assert [(m, float(v)) for m, v in rows] == [(month(2019, 4), 4.0), (month(2019, 5), 8.0)]
    assert months(series.monthly_last(s, "Volume"), "Volume") == [(2,), (1,), (1,)]


def test_gaps_are_filled_and_an_incomplete_last_month_is_not_learned_from(make_wide):
    s = make_wide(("2019-11-05", 1), ("2020-02-02", 4))
    assert [(m, float(v)) for m, v in months(series.monthly_revenue(s), "YearMonth", "Revenue")] == [
        (month(2019, 11), 1.0), (month(2019, 12), 0.0), (month(2020, 1), 0.0), (month(2020, 2), 4.0)
    ]
    assert series.training_months(s).count() == 3
    assert series.training_months(make_wide(("2020-02-29", 4))).count() == 1
    assert series.training_months(make_wide(("2020-02-28", 4))).count() == 0
    assert series.monthly_revenue(s.where("false")).count() == 0


def test_a_panel_is_the_same_as_its_series_one_by_one(make_wide):
    both = history(make_wide, 7, skip=(2, 3)).unionByName(history(make_wide, 9, 30, brand="B2", seed=1))
    both = both.unionByName(make_wide(("2018-01-01", 5, {"Brand": None})))
    panel = series.observed_months(both, ["Brand"])
    assert {row.Brand for row in panel.collect()} == {"B1", "B2"}
    for brand in ("B1", "B2"):
        alone = series.observed_months(both.where(f"Brand = '{brand}'"))
        assert sorted(panel.where(f"Brand = '{brand}'").drop("Brand").collect()) == sorted(alone.collect())


def pandas_features(values, leak_free=False):
    frame = pd.DataFrame({"Revenue": values})
    frame["Lag_1"] = frame.Revenue.shift(1).bfill()
    frame["Lag_2"] = frame.Revenue.shift(2).bfill()
    source = frame.Revenue.shift(1) if leak_free else frame.Revenue
    frame["Rolling_Mean"] = source.rolling(window=3, min_periods=1).mean().fillna(frame.Revenue.iloc[0])
    return frame


@pytest.mark.parametrize("leak_free", [False, True])
def test_features_equal_shift_and_rolling(make_wide, leak_free):
    s = history(make_wide, 14, 27, skip=(4,))
    train = series.training_months(s)
    rows = fc.forecast_features(train, leak_free=leak_free).orderBy("YearMonth").collect()
    expected = pandas_features([float(row.Revenue) for row in train.orderBy("YearMonth").collect()], leak_free)
    assert [row.Time_Index for row in rows] == list(range(13))
    assert [(row.Year, row.Month) for row in rows[:2]] == [(2018, 1), (2018, 2)]
    for name in ("Lag_1", "Lag_2", "Rolling_Mean"):
        assert [float(row[name]) for row in rows] == pytest.approx(list(expected[name]))


def test_gate_needs_more_than_four_months(make_wide):
    complete = history(make_wide, 4, 30)
    incomplete = history(make_wide, 6, 29)
    assert tuple(fc.forecast_gate(complete).first()) == (4, "insufficient data")
    assert tuple(fc.forecast_gate(incomplete).first()) == (5, "trained")
    assert tuple(fc.forecast_gate(complete.where("false")).first()) == (0, "insufficient data")
    nothing = fc.forecast(complete)
    assert nothing.count() == 0
    assert fc.forecast_direction(nothing).first().Direction == "insufficient data"
    assert fc.forecast_series(complete, nothing).count() == 4


def test_horizon_follows_the_last_observed_month(make_wide):
    dropped = fc.forecast_horizon(history(make_wide, 12, 30)).orderBy("Step").collect()
    assert (dropped[0].YearMonth, dropped[0].Time_Index) == (month(2019, 1), 11)
    kept = fc.forecast_horizon(history(make_wide, 12, 31)).orderBy("Step").collect()
    assert (kept[0].YearMonth, kept[0].Time_Index) == (month(2019, 1), 12)
    assert [(row.Year, row.Month) for row in kept] == [(2019, i) for i in range(1, 7)]


@pytest.mark.parametrize("kind,params", [(LinearRegression, {"regParam": 0.1}), (GBTRegressor, {"maxIter": 3, "seed": 1})])
def test_recursion_equals_a_loop_over_months(make_wide, kind, params):
    both = history(make_wide, 16, 15).unionByName(history(make_wide, 24, 31, brand="B2", seed=2))
    keys = ["Brand"]
    train = series.training_months(both, keys)
    model = fc.fit_model(fc.forecast_features(train, keys), kind(**params))
    predicted = fc._predict(model, series.observed_months(both, keys), keys, 6).orderBy("Brand", "Step").collect()
    expected = []
    for brand, observed in (("B1", 16), ("B2", 24)):
        known = [float(row.Revenue) for row in train.where(f"Brand = '{brand}'").orderBy("YearMonth").collect()]
        length = len(known)
        for step in range(6):
            index = observed + step
            at = month(2018 + index // 12, index % 12 + 1)
            features = [at.month, at.year, length + step, known[-1], known[-2], sum(known[-3:]) / 3]
            known.append(model.predict(Vectors.dense(features)))
            expected.append((brand, step + 1, at, known[-1]))
    assert [(row.Brand, row.Step, row.YearMonth) for row in predicted] == [row[:3] for row in expected]
    assert [row.Revenue for row in predicted] == pytest.approx([row[3] for row in expected])


def test_forecast_is_repeatable_and_continues_the_history(make_wide):
    s = history(make_wide, 20, 10)
    first = fc.forecast(s, max_iter=5).orderBy("Step").collect()
    again = fc.forecast(s, max_iter=5)
    assert again.orderBy("Step").collect() == first
    rows = months(fc.forecast_series(s, again), "YearMonth", "Type")
    assert len(rows) == 26 and len({m for m, _ in rows}) == 26
    assert [kind for _, kind in rows] == ["Actual Revenue"] * 20 + ["Machine Learning Forecast"] * 6
    low, high = s.agg({"Revenue": "min"}).first()[0], s.agg({"Revenue": "max"}).first()[0]
    assert all(float(low) * 0.5 <= row.Revenue <= float(high) * 1.5 for row in first)


def test_direction(spark):
    rows = [("up", 1, 5.0), ("up", 6, 6.0), ("down", 1, 6.0), ("down", 6, 5.0), ("flat", 1, 5.0), ("flat", 6, 5.0)]
    predicted = spark.createDataFrame(rows, "k string, Step int, Revenue double")
    gate = spark.createDataFrame([("up",), ("down",), ("flat",), ("short",)], "k string")
    result = {row.k: row.Direction for row in fc.forecast_direction(predicted, ["k"], gate).collect()}
    assert result == {
        "up": "organic growth", "down": "contraction", "flat": "contraction", "short": "insufficient data"
    }


def test_tuning_reports_each_parameter_set(make_wide):
    grid = [{"maxIter": 2, "maxDepth": 1}, {"maxIter": 5, "maxDepth": 2}]
    rows = fc.tune_forecast(history(make_wide, 24, 31), grid, "2019-07-01").collect()
    assert [(row.Trees, row.Depth) for row in rows] == [(0, 0), (2, 1), (5, 2)]
    assert all(row.RMSE > 0 for row in rows)


def test_tuning_does_not_see_what_it_predicts(make_wide):
    s = history(make_wide, 24, 31)
    changed = s.withColumn("Revenue", F.when(F.col("Date") >= "2019-07-01", F.col("Revenue") + 1_000_000).otherwise(F.col("Revenue")))
    grid = [{"maxIter": 2, "maxDepth": 1}]
    plain, shifted = (fc.tune_forecast(frame, grid, "2019-07-01").collect() for frame in (s, changed))
    for before, after in zip(plain, shifted):
        assert after.RMSE > 900_000 > before.RMSE  # the predictions did not follow the change


def test_kept_model_predicts_the_same(make_wide):
    s = history(make_wide, 20, 10)
    kept = fc.fit_forecast(s, max_iter=3)
    assert fc.forecast(s, model=kept).collect() == fc.forecast(s, max_iter=3).collect()


def test_baseline_equals_a_loop(make_wide):
    s = history(make_wide, 16, 15)
    known = [float(row.Revenue) for row in series.training_months(s).orderBy("YearMonth").collect()]
    for row in fc.forecast_baseline(s).orderBy("Step").collect():
        known.append(sum(known[-3:]) / 3)
        assert row.Revenue == pytest.approx(known[-1])
