"""Every registered query against its SQL counterpart, and invariants for those without one."""

import datetime as dt
import math
import re

import duckdb
import pytest

import __spark_entry__ as contract
from shelfwise.settings import CONTRACTION, GROWTH

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def engine(testdata):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{testdata}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, testdata, engine, name):
    df = QUERIES[name](spark, testdata)
    cursor = engine.execute(SQL[name])
    names = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    assert {field.name: SQL_TYPES[field.dataType.simpleString()] for field in df.schema} == types
    expected = sorted(map(repr, cursor.fetchall()))
    assert expected
    assert sorted(repr(tuple(row)) for row in df.select([f"`{column}`" for column in names]).collect()) == expected


def test_only_the_fitted_models_have_no_sql():
    own = {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)}
    assert own - set(SQL) == {
        "forecast_6m", "forecast_series", "forecast_direction", "forecast_panel", "forecast_tuning", "forecast_rolling"
    }


def test_forecast_queries(spark, testdata):
    rows = QUERIES["forecast_6m"](spark, testdata).orderBy("Step").collect()
    assert [row.YearMonth for row in rows] == [dt.datetime(2001, 12, 1)] + [dt.datetime(2002, i, 1) for i in range(1, 6)]
    assert all(math.isfinite(row.Revenue) and row.Revenue > 0 for row in rows)
    history = QUERIES["forecast_series"](spark, testdata)
    assert {row["Type"]: row["count"] for row in history.groupBy("Type").count().collect()} == {
        "Actual Revenue": 83, "Machine Learning Forecast": 6
    }
    direction = QUERIES["forecast_direction"](spark, testdata).first().Direction
    assert direction == (GROWTH if rows[-1].Revenue > rows[0].Revenue else CONTRACTION)


def test_sums_agree_across_queries(spark, testdata):
    def first(name):
        return QUERIES[name](spark, testdata).first()

    total = first("kpi_totals").Total_Revenue
    assert sum(row.Revenue for row in QUERIES["city_map"](spark, testdata).collect()) == pytest.approx(total)
    assert sum(row.Revenue for row in QUERIES["monthly_revenue"](spark, testdata).collect()) == pytest.approx(total)
    layers = {row.Layer: row for row in QUERIES["control_totals"](spark, testdata).collect()}
    assert layers["fact"].Revenue == layers["wide"].Revenue == total
    assert layers["silver"].Lines == layers["fact"].Lines + layers["rejected"].Lines
    bridge = {row.Position: row.Revenue for row in QUERIES["yoy_bridge"](spark, testdata).collect()}
    last = max(bridge)
    assert sum(bridge[i] for i in range(last)) == pytest.approx(bridge[last])
    assert max(row.Cumulative_Pct for row in QUERIES["pareto_brand"](spark, testdata).collect()) == pytest.approx(100)


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
