"""Six-month revenue forecast: features, boosted trees from Spark ML, recursive prediction.

``series_keys`` forecasts many series at once with one model fitted on all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Row, functions as F

from ..settings import (
    ACTUAL_TYPE, CONTRACTION, FORECAST_DEPTH, FORECAST_SEED, FORECAST_STEPS, FORECAST_TREES, FORECAST_TYPE,
    GROWTH, INSUFFICIENT, MIN_TRAINING_MONTHS,
)
from ..sources.shared import materialized
from .series import observed_months, series_window
from .trees import is_tree_model, leaves_of, prediction_sql

FEATURES = ["Month", "Year", "Time_Index", "Lag_1", "Lag_2", "Rolling_Mean"]
TRAINED = "trained"
_LABEL = "_label"


def forecast_gate(s: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Number of training months per series and whether they are enough to train."""
    months = observed_months(s, series_keys).groupBy(*series_keys).agg(
        F.count_if("Is_Complete").alias("Training_Months")
    )
    enough = F.col("Training_Months") >= MIN_TRAINING_MONTHS
    return months.withColumn("Status", F.when(enough, F.lit(TRAINED)).otherwise(F.lit(INSUFFICIENT)))


def forecast_features(
    train: DataFrame, series_keys: Sequence[str] = (), leak_free: bool = False
) -> DataFrame:
    """Calendar, lag and rolling features per training month.

    Lags before the first month take its revenue. The rolling mean covers the month itself and the two before;
    with ``leak_free`` the three before, as it is at prediction time.
    """
    order = series_window(series_keys).orderBy("YearMonth")
    window = order.rowsBetween(-3, -1) if leak_free else order.rowsBetween(-2, 0)
    first = F.first("Revenue").over(order)
    # Sum first, convert after: exact for decimal revenue.
    mean = F.sum("Revenue").over(window).cast("double") / F.count("Revenue").over(window)
    if leak_free:
        mean = F.when(F.count("Revenue").over(window) > 0, mean).otherwise(first.cast("double"))
    return train.select(
        *series_keys,
        "YearMonth",
        "Revenue",
        F.month("YearMonth").alias("Month"),
        F.year("YearMonth").alias("Year"),
        (F.row_number().over(order) - 1).alias("Time_Index"),
        F.coalesce(F.lag("Revenue", 1).over(order), first).alias("Lag_1"),
        F.coalesce(F.lag("Revenue", 2).over(order), first).alias("Lag_2"),
        mean.alias("Rolling_Mean"),
    )


def _trainable(observed: DataFrame, series_keys: Sequence[str]) -> DataFrame:
    """Complete months of the series that have enough of them."""
    months = F.count_if("Is_Complete").over(series_window(series_keys))
    return observed.withColumn("_months", months).where(
        F.col("Is_Complete") & (F.col("_months") >= MIN_TRAINING_MONTHS)
    )


def _series_state(observed: DataFrame, series_keys: Sequence[str]) -> DataFrame:
    """One row per trainable series: last observed month, training length, last three training revenues."""
    order = series_window(series_keys).orderBy("YearMonth")
    months = observed.withColumns({
        "_before": F.lag("Revenue", 1).over(order), "_before_that": F.lag("Revenue", 2).over(order)
    })
    lags = {"_r1": "Revenue", "_r2": "_before", "_r3": "_before_that"}
    tail = F.struct(*[F.col(column).cast("double").alias(name) for name, column in lags.items()])
    return (
        months.groupBy(*series_keys)
        .agg(
            F.max("YearMonth").alias("_last_month"),
            F.count_if("Is_Complete").cast("int").alias("_months"),
            F.max_by(tail, F.when(F.col("Is_Complete"), F.col("YearMonth"))).alias("_tail"),
        )
        .where(F.col("_months") >= MIN_TRAINING_MONTHS)
        .select(*series_keys, "_last_month", "_months", "_tail.*")
    )


def forecast_horizon(
    s: DataFrame, series_keys: Sequence[str] = (), steps: int = FORECAST_STEPS
) -> DataFrame:
    """Months to forecast: they follow the last observed month, even one too incomplete to learn from, while the
    time index continues from the training months."""
    month = F.add_months("_last_month", F.col("Step"))
    state = _series_state(observed_months(s, series_keys), series_keys).withColumn(
        "Step", F.explode(F.sequence(F.lit(1), F.lit(steps)))
    )
    return state.select(
        *series_keys, "Step",
        month.alias("YearMonth"),
        F.month(month).alias("Month"),
        F.year(month).alias("Year"),
        (F.col("_months") + F.col("Step") - 1).alias("Time_Index"),
    )


def _assemble(features: DataFrame) -> DataFrame:
    doubles = features.withColumns({name: F.col(name).cast("double") for name in FEATURES})
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(doubles)


def _boosted_trees(max_iter: int, max_depth: int, seed: int) -> GBTRegressor:
    return GBTRegressor(maxIter=max_iter, maxDepth=max_depth, stepSize=0.3, seed=seed)


def fit_model(features: DataFrame, regressor: Estimator) -> Model:
    """Fit on a stored features frame: stored, its partitions are as few as its size asks for, which is what the
    many small jobs of the fit take their time from."""
    training = _assemble(features).select("features", F.col("Revenue").cast("double").alias(_LABEL))
    return regressor.copy({regressor.getParam("labelCol"): _LABEL}).fit(training)


def _predict(model: Model | DataFrame, observed: DataFrame, series_keys: Sequence[str], steps: int) -> DataFrame:
    """Predict month after month, each prediction becoming the next month's lag.

    Trees, fitted or as a table of leaves, are one expression per series. Other models transform the state of all series,
    one row each, once per step.
    """
    state = _series_state(observed, series_keys)
    if isinstance(model, DataFrame):
        return _predict_by_leaves(model.collect(), state, series_keys, steps)
    if is_tree_model(model):
        return _predict_by_leaves(leaves_of(model), state, series_keys, steps)
    return _predict_by_transform(model, state, series_keys, steps)


def _predict_by_leaves(leaves: Sequence[Row], state: DataFrame, series_keys: Sequence[str], steps: int) -> DataFrame:
    """The recursion as an aggregate over the steps, in the task that holds the series."""
    month = "add_months(_last_month, step)"
    values = {
        "Month": f"month({month})", "Year": f"year({month})", "Time_Index": "_months + step - 1",
        "Lag_1": "last.r1", "Lag_2": "last.r2", "Rolling_Mean": "(last.r3 + last.r2 + last.r1) / 3",
    }
    row = ", ".join(f"'{name}', CAST({values[name]} AS DOUBLE)" for name in FEATURES)
    # An array of one element names what the model reads many times, so that it is worked out once.
    predicted = f"transform(array(named_struct({row})), f -> {prediction_sql(leaves, FEATURES, 'f')})"
    advanced = "named_struct('r1', p, 'r2', last.r1, 'r3', last.r2, 'found', concat(last.found, array(p)))"
    found = F.expr(f"""aggregate(
        {f'sequence(1, {steps})' if steps > 0 else 'CAST(array() AS array<int>)'},
        named_struct('r1', _r1, 'r2', _r2, 'r3', _r3, 'found', CAST(array() AS array<double>)),
        (last, step) -> transform({predicted}, p -> {advanced})[0],
        last -> last.found)""")
    months = state.select(*series_keys, "_last_month", F.posexplode(found).alias("_step", "Revenue"))
    step = F.col("_step") + 1
    return months.select(
        *series_keys, step.alias("Step"), F.add_months("_last_month", step).alias("YearMonth"), "Revenue"
    )


def _predict_by_transform(model: Model, state: DataFrame, series_keys: Sequence[str], steps: int) -> DataFrame:
    kept = [*series_keys, "_last_month", "_months"]
    predictions: list[str] = []
    for step in range(1, steps + 1):
        month = F.add_months("_last_month", step)
        prepared = state.withColumns({
            "Month": F.month(month),
            "Year": F.year(month),
            "Time_Index": F.col("_months") + (step - 1),
            "Lag_1": F.col("_r1"),
            "Lag_2": F.col("_r2"),
            "Rolling_Mean": (F.col("_r3") + F.col("_r2") + F.col("_r1")) / 3,
        })
        name = f"_p{step}"
        state = model.transform(_assemble(prepared)).select(
            *kept, *predictions,
            F.col("prediction").alias(name),
            F.col("prediction").alias("_r1"),
            F.col("_r1").alias("_r2"),
            F.col("_r2").alias("_r3"),
        )
        predictions.append(name)
    months = F.array(*[
        F.struct(
            F.lit(step).alias("Step"),
            F.add_months("_last_month", step).alias("YearMonth"),
            F.col(name).alias("Revenue"),
        )
        for step, name in enumerate(predictions, start=1)
    ])
    return state.select(*series_keys, F.inline(months))


def fit_forecast(
    s: DataFrame,
    series_keys: Sequence[str] = (),
    max_iter: int = FORECAST_TREES,
    max_depth: int = FORECAST_DEPTH,
    seed: int = FORECAST_SEED,
    leak_free: bool = False,
) -> Model:
    """The model :func:`forecast` would fit, to be kept: one for all series of a panel, until new months come."""
    train = _trainable(observed_months(s, series_keys), series_keys)
    features = materialized(forecast_features(train, series_keys, leak_free), "features")
    return fit_model(features, _boosted_trees(max_iter, max_depth, seed))


def forecast(
    s: DataFrame,
    series_keys: Sequence[str] = (),
    steps: int = FORECAST_STEPS,
    max_iter: int = FORECAST_TREES,
    max_depth: int = FORECAST_DEPTH,
    seed: int = FORECAST_SEED,
    leak_free: bool = False,
    regressor: Estimator | None = None,
    model: Model | DataFrame | None = None,
) -> DataFrame:
    """``steps`` predicted months per series; series with too few training months have none.

    ``regressor`` takes any Spark ML regression estimator instead of the default boosted trees. A ``model`` fitted before
    (see :func:`fit_forecast`) is used as it is, also as its table of leaves (``trees.leaf_table``), which can be stored
    like any other table.
    """
    if model is not None:
        return _predict(model, observed_months(s, series_keys), series_keys, steps)
    # The sales are read once; gate, fit and prediction work on the month totals.
    observed = materialized(observed_months(s, series_keys), "months")
    features = materialized(
        forecast_features(_trainable(observed, series_keys), series_keys, leak_free), "features"
    )
    if features.isEmpty():
        nothing = [F.lit(None).cast("int").alias("Step"), F.lit(None).cast("double").alias("Revenue")]
        return observed.where("false").select(*series_keys, nothing[0], "YearMonth", nothing[1])
    model = fit_model(features, regressor or _boosted_trees(max_iter, max_depth, seed))
    return _predict(model, observed, series_keys, steps)


def forecast_baseline(
    s: DataFrame, series_keys: Sequence[str] = (), steps: int = FORECAST_STEPS
) -> DataFrame:
    """The yardstick for any model: each predicted month is the mean of the three before it, predicted or not."""
    return _baseline(observed_months(s, series_keys), series_keys, steps)


def _baseline(observed: DataFrame, series_keys: Sequence[str], steps: int) -> DataFrame:
    def step(state: Column, number: Column) -> Column:
        mean = (state["r3"] + state["r2"] + state["r1"]) / 3
        month = F.struct(number.alias("Step"), mean.alias("Revenue"))
        return F.struct(
            mean.alias("r1"), state["r1"].alias("r2"), state["r2"].alias("r3"), F.concat(state["found"], F.array(month)).alias("found")
        )

    start = F.struct(
        F.col("_r1").alias("r1"), F.col("_r2").alias("r2"), F.col("_r3").alias("r3"),
        F.array().cast("array<struct<Step:int,Revenue:double>>").alias("found"),
    )
    months = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda state: state["found"])
    predicted = _series_state(observed, series_keys).select(*series_keys, "_last_month", F.inline(months))
    return predicted.select(*series_keys, "Step", F.add_months("_last_month", F.col("Step")).alias("YearMonth"), "Revenue")


def forecast_series(s: DataFrame, predicted: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """History, its incomplete last month included, followed by the forecast."""
    columns = [*series_keys, "YearMonth", "Revenue", "Type"]
    history = observed_months(s, series_keys).select(
        *series_keys, "YearMonth", F.col("Revenue").cast("double").alias("Revenue"), F.lit(ACTUAL_TYPE).alias("Type")
    )
    return history.select(columns).unionByName(
        predicted.withColumn("Type", F.lit(FORECAST_TYPE)).select(columns)
    )


def forecast_direction(
    predicted: DataFrame, series_keys: Sequence[str] = (), gate: DataFrame | None = None
) -> DataFrame:
    """Growth if the last predicted month is above the first. Series without a forecast have insufficient data;
    with ``series_keys`` pass the ``gate`` frame to have them listed."""
    last, first = F.max_by("Revenue", "Step"), F.min_by("Revenue", "Step")
    direction = predicted.groupBy(*series_keys).agg(
        F.when(last > first, F.lit(GROWTH))
        .when(last <= first, F.lit(CONTRACTION))
        .otherwise(F.lit(INSUFFICIENT))
        .alias("Direction")
    )
    if gate is None or not series_keys:
        return direction
    return gate.select(*series_keys).join(direction, list(series_keys), "left").fillna(INSUFFICIENT, ["Direction"])


def tune_forecast(
    s: DataFrame,
    grid: Sequence[dict[str, int | float]],
    cutoff: str,
    series_keys: Sequence[str] = (),
    seed: int = FORECAST_SEED,
    leak_free: bool = False,
) -> DataFrame:
    """Error of each parameter set in ``grid``, and of the baseline, which has no trees: what would have been predicted
    at ``cutoff``, month after month from the months before it, against the complete months from it on.

    Only series with enough months before the cut-off take part. The grid is the only loop; every fit and every
    evaluation is a Spark job.
    """
    observed = materialized(observed_months(s, series_keys), "months")
    at = F.lit(cutoff).cast("date")
    before = observed.where(F.col("YearMonth") < at).withColumn("Is_Complete", F.lit(True))
    actual = observed.where((F.col("YearMonth") >= at) & F.col("Is_Complete")).select(
        *series_keys, "YearMonth", F.col("Revenue").cast("double").alias("_actual")
    )
    features = materialized(forecast_features(_trainable(before, series_keys), series_keys, leak_free), "features")
    span = F.months_between(F.max("YearMonth"), F.min("YearMonth")).cast("int") + 1
    steps = observed.where(F.col("YearMonth") >= F.add_months(at, -1)).agg(span).first()[0] or 0

    def error(predicted: DataFrame) -> float | None:
        both = predicted.join(actual, [*series_keys, "YearMonth"])
        return both.agg(F.sqrt(F.avg(F.pow(F.col("Revenue") - F.col("_actual"), 2)))).first()[0]

    rows = [(0, 0, error(_baseline(before, series_keys, steps)))]
    for params in grid:
        model = fit_model(features, _boosted_trees(FORECAST_TREES, FORECAST_DEPTH, seed).copy().setParams(**params))
        rows.append((
            int(params.get("maxIter", FORECAST_TREES)), int(params.get("maxDepth", FORECAST_DEPTH)),
            error(_predict(model, before, series_keys, steps)),
        ))
    return s.sparkSession.createDataFrame(rows, "Trees int, Depth int, RMSE double")


def rolling_origin(
    s: DataFrame,
    grid: Sequence[dict[str, int | float]],
    cutoffs: Sequence[str],
    series_keys: Sequence[str] = (),
    steps: int = FORECAST_STEPS,
    seed: int = FORECAST_SEED,
    leak_free: bool = False,
    parallel_fits: int = 4,
) -> DataFrame:
    """Errors by cut-off and step ahead, of each parameter set in ``grid`` and of the baseline (0 trees of depth 0).

    The months before a cut-off make a fold, which is one more series key: features, states and errors of all folds come
    from the same jobs. Only fits are apart, ``parallel_fits`` at a time, as each is a chain of small jobs that leaves
    most of a cluster idle. A fold takes part with the series that have enough months in it; steps without a complete
    month to compare with are left out, and so are folds in which no series can be learned from.

    ``Series`` is the number of series compared, ``RMSE`` and ``MAE`` are over them.
    """
    spark, keys = s.sparkSession, ["Cutoff", *series_keys]
    observed = materialized(observed_months(s, series_keys), "months")
    folds = F.array(*[F.lit(cutoff).cast("date") for cutoff in sorted(set(cutoffs))])
    later = F.filter(folds, lambda cutoff: F.col("YearMonth") < cutoff)
    before = observed.withColumns({"Cutoff": F.explode(later), "Is_Complete": F.lit(True)})
    actual = observed.where("Is_Complete").select(*series_keys, "YearMonth", F.col("Revenue").cast("double").alias("_actual"))
    features = materialized(forecast_features(_trainable(before, keys), keys, leak_free), "features")
    learnable = [row.Cutoff for row in features.select("Cutoff").distinct().collect()] if grid else []

    def labelled(predicted: DataFrame, trees: int, depth: int) -> DataFrame:
        return predicted.withColumns({"Trees": F.lit(trees), "Depth": F.lit(depth)})

    def fitted(job: tuple) -> DataFrame:
        cutoff, params = job
        regressor = _boosted_trees(FORECAST_TREES, FORECAST_DEPTH, seed).setParams(**params)
        model = fit_model(features.where(F.col("Cutoff") == cutoff), regressor)
        predicted = _predict(model, before.where(F.col("Cutoff") == cutoff), keys, steps)
        return labelled(predicted, regressor.getMaxIter(), regressor.getMaxDepth())

    predicted = labelled(_baseline(before, keys, steps), 0, 0)
    with ThreadPoolExecutor(parallel_fits) as pool:
        for one in pool.map(fitted, [(cutoff, params) for cutoff in sorted(learnable) for params in grid]):
            predicted = predicted.unionByName(one)
    both = predicted.where(F.col("YearMonth") >= F.col("Cutoff")).join(actual, [*series_keys, "YearMonth"])
    error = F.col("Revenue") - F.col("_actual")
    return both.groupBy("Cutoff", "Step", "Trees", "Depth").agg(
        F.count("*").alias("Series"), F.sqrt(F.avg(error * error)).alias("RMSE"), F.avg(F.abs(error)).alias("MAE")
    )
