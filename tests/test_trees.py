"""Tree ensembles as tables of leaves and as SQL, against the models they come from."""

import random

import duckdb
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from shelfwise.operators import forecast as fc, series, trees
from shelfwise.sources.shared import materialized


@pytest.fixture(scope="module")
def features(spark):
    chooser = random.Random(5)
    rows = []
    for i in range(120):
        lags = [chooser.uniform(1e9, 3e10) for _ in range(3)]
        rows.append((chooser.randint(1, 12), 2018 + i // 12, i, *lags, sum(lags) / 3 + i * 1e7))
    return spark.createDataFrame(rows, ", ".join(f"{name} double" for name in [*fc.FEATURES, "Revenue"]).replace(
        "Month double", "Month int").replace("Year double", "Year int").replace("Time_Index double", "Time_Index int"))


@pytest.mark.parametrize("kind,params", [
    (GBTRegressor, {"maxIter": 12, "maxDepth": 3, "stepSize": 0.3, "seed": 1}), (RandomForestRegressor, {"numTrees": 7, "seed": 2}),
    (DecisionTreeRegressor, {"maxDepth": 4}), (DecisionTreeRegressor, {"maxDepth": 0}),
])
def test_leaves_predict_what_the_model_does_in_two_engines(spark, features, kind, params):
    model = fc.fit_model(features, kind(**params))
    leaves = materialized(trees.leaf_table(spark, model), "model").collect()
    sql = trees.prediction_sql(leaves, fc.FEATURES, "f")
    rows = model.transform(fc._assemble(features)).withColumn("leaves", F.expr(sql.replace("f.", ""))).collect()
    assert [row.leaves for row in rows] == pytest.approx([row.prediction for row in rows], rel=1e-12)
    frame = features.toPandas()
    other = duckdb.connect()
    other.register("f", frame)
    columns = ", ".join(fc.FEATURES)
    assert sorted(other.execute(f"SELECT {columns}, {sql} FROM f").fetchall()) == sorted(
        tuple(row[name] for name in [*fc.FEATURES, "leaves"]) for row in rows
    )


def test_every_value_has_one_leaf_per_tree(spark, features):
    model = fc.fit_model(features, GBTRegressor(maxIter=5, maxDepth=3, seed=1))
    leaves = trees.leaf_table(spark, model)
    bounds = [
        F.coalesce(F.col(name) > F.col("low")[i], F.lit(True)) & F.coalesce(F.col(name) <= F.col("high")[i], F.lit(True))
        for i, name in enumerate(fc.FEATURES)
    ]
    held = features.join(leaves, F.forall(F.array(*bounds), lambda one: one)).groupBy("Time_Index", "tree").count()
    assert held.count() == 120 * 5 and held.filter("count <> 1").count() == 0


def test_thresholds_belong_to_the_lower_leaf(spark):
    leaves = [trees.LEAF(0, 0, [None], [1.5], 1.0), trees.LEAF(0, 1, [1.5], [None], -2.0), trees.LEAF(1, 0, [None], [None], 1e20)]
    rows = spark.createDataFrame([(1.5,), (1.6,), (float("nan"),), (None,)], "x double").alias("f")
    found = [row[0] for row in rows.select(F.expr(trees.prediction_sql(leaves[:2], ["x"], "f"))).collect()]
    assert found == [1.0, -2.0, -2.0, None]
    assert rows.limit(1).select(F.expr(trees.prediction_sql(leaves, ["x"], "f"))).first()[0] == 1e20
    with pytest.raises(ValueError):
        trees.prediction_sql([], ["x"], "f")


def test_deep_sums_of_many_trees(spark):
    leaves = [trees.LEAF(i, 0, [None], [None], 1.0) for i in range(1001)]
    assert spark.range(1).alias("f").select(F.expr(trees.prediction_sql(leaves, ["id"], "f"))).first()[0] == 1001


def sales(make_wide, count, brand):
    chooser = random.Random(brand)
    return make_wide(*[
        (f"{2016 + i // 12}-{i % 12 + 1:02d}-28", chooser.randint(100, 900), {"Brand": brand}) for i in range(count)
    ])


def test_recursion_by_leaves_equals_the_loop_over_steps(spark, make_wide):
    both = sales(make_wide, 30, "B1").unionByName(sales(make_wide, 22, "B2")).unionByName(sales(make_wide, 3, "B3"))
    keys = ["Brand"]
    observed = series.observed_months(both, keys)
    model = fc.fit_forecast(both, keys, max_iter=10)
    loop = fc._predict_by_transform(model, fc._series_state(observed, keys), keys, 6).orderBy("Brand", "Step")
    kept = trees.leaf_table(spark, model)
    for given in (model, kept):
        found = fc.forecast(both, keys, model=given).orderBy("Brand", "Step")
        assert found.schema.simpleString() == loop.schema.simpleString()
        assert [tuple(row)[:3] for row in found.collect()] == [tuple(row)[:3] for row in loop.collect()]
        assert [row.Revenue for row in found.collect()] == pytest.approx([row.Revenue for row in loop.collect()])
    assert {row.Brand for row in loop.collect()} == {"B1", "B2"}
    assert fc.forecast(both, keys, steps=0, model=kept).count() == 0
    assert fc.forecast(both.where("false"), keys, model=kept).count() == 0


def test_rolling_origin_equals_one_cutoff_after_the_other(make_wide):
    s = sales(make_wide, 30, "B1").unionByName(sales(make_wide, 24, "B2"))
    cutoffs, grid, keys = ["2017-03-01", "2017-09-01", "2030-01-01", "2016-02-01"], [{"maxIter": 2, "maxDepth": 1}], ["Brand"]
    rows = fc.rolling_origin(s, grid, cutoffs, keys, steps=3).collect()
    assert {(str(row.Cutoff), row.Step, row.Trees, row.Depth) for row in rows} == {
        (cutoff, step, *kind) for cutoff in cutoffs[:2] for step in (1, 2, 3) for kind in ((0, 0), (2, 1))
    }
    assert all(row.Series == 2 for row in rows)
    actual = {(row.Brand, row.YearMonth): float(row.Revenue) for row in series.training_months(s, keys).collect()}
    for cutoff in cutoffs[:2]:
        before = s.where(F.col("Date") < cutoff)
        for trees_, frame in (
            (0, fc.forecast_baseline(before.withColumn("Date", F.last_day("Date")), keys)),
            (2, fc.forecast(before.withColumn("Date", F.last_day("Date")), keys, max_iter=2, max_depth=1)),
        ):
            for step in (1, 2, 3):
                missed = [row.Revenue - actual[row.Brand, row.YearMonth] for row in frame.where(f"Step = {step}").collect()]
                row = next(r for r in rows if (str(r.Cutoff), r.Step, r.Trees) == (cutoff, step, trees_))
                assert row.MAE == pytest.approx(sum(map(abs, missed)) / 2)
                assert row.RMSE == pytest.approx((sum(e * e for e in missed) / 2) ** 0.5)


def test_rolling_origin_does_not_see_what_it_predicts(make_wide):
    s = sales(make_wide, 24, "B1")
    later = F.when(F.col("Date") >= "2017-07-01", F.col("Revenue") + 1_000_000).otherwise(F.col("Revenue"))
    for row in fc.rolling_origin(s.withColumn("Revenue", later), [{"maxIter": 2, "maxDepth": 1}], ["2017-07-01"]).collect():
        assert row.MAE > 900_000


def test_other_models_still_loop(make_wide):
    s = sales(make_wide, 24, "B1")
    assert fc.forecast(s, regressor=LinearRegression(regParam=0.1)).count() == 6
