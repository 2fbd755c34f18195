import random
from decimal import Decimal

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.functions import city_of, growth_pct, parse_day, parse_price, parse_price_any, parse_units, per_column, ranked, ratio


def apply(spark, function, values):
    df = spark.createDataFrame([(i, value) for i, value in enumerate(values)], "i int, s string")
    return [row[0] for row in df.orderBy("i").select(function(F.col("s"))).collect()]


def test_units(spark):
    cases = {
        "7": 7, " 7 ": 7, "1,200": 1200, "1,234,567": 1234567, "-3": -3, "12.7": 13, "12.5": 13, "-12.5": -13,
        ".5": 1, "0.4999999999": 0, "1e3": 1000, "abc": None, "": None, "99999999999": None, None: None, "n/a": None,
    }
    assert apply(spark, parse_units, list(cases)) == list(cases.values())


def test_price(spark):
    cases = {
        "12.50 €": Decimal("12.50"), "€12.50": Decimal("12.50"), "12.50€": Decimal("12.50"), "3": Decimal("3.00"),
        "1,99 €": None, "NaN": None, "inf": None, "abc": None, None: None, "1e3": Decimal("1000.00"),
        "0.125": Decimal("0.125"), "0.1234567": Decimal("0.123457"), "-2.00 €": Decimal("-2.00"),
    }
    assert apply(spark, parse_price, list(cases)) == list(cases.values())


def test_price_of_any_currency(spark):
    cases = {
        "1,99 €": "1.99", "€1.99": "1.99", "USD 1,234.50": "1234.50", "1.234,50 kr": "1234.50", "1,234": "1234.00",
        "1.234.567": "1234567.00", "0.500": "0.50", "¥500": "500.00", "-5,00 €": "-5.00", "1 234,50 €": "1234.50",
        "CHF 1'234.50": "1234.50", "1 234 567,89": "1234567.89", "12.5": "12.50",
    }
    expected = [Decimal(value) for value in cases.values()]
    assert apply(spark, parse_price_any, list(cases)) == expected
    assert apply(spark, parse_price_any, ["free", "", None]) == [None, None, None]


def test_numbers_equal_safe_casts_in_sql(spark):
    """Random texts of digits, marks, signs, blanks and the euro sign."""
    random.seed(11)
    alphabet = "0123456789" * 2 + ".,-+ €\t"
    texts = sorted({"".join(random.choice(alphabet) for _ in range(random.randint(1, 7))) for _ in range(20000)})
    columns = [F.col("s"), parse_units(F.col("s")), parse_price(F.col("s"))]
    ours = spark.createDataFrame([(text,) for text in texts], "s string").select(columns).collect()
    connection = duckdb.connect()
    connection.register("texts", pd.DataFrame({"s": texts}))
    expected = connection.execute("""
        SELECT s, TRY_CAST(replace(s, ',', '') AS INTEGER),
               TRY_CAST(replace(replace(s, ' €', ''), '€', '') AS DECIMAL(18,6)) FROM texts""").fetchall()
    assert sorted(map(tuple, ours), key=lambda row: row[0]) == sorted(expected, key=lambda row: row[0])
    assert sum(row[1] is not None for row in expected) > 1000


def test_city(spark):
    cases = {
        "Mart - Detroit": "Detroit", "Super-Max Supers - Omaha": "Omaha", "Super-Max Supers": "Max Supers",
        "Corner": "Unknown", "Trailing -": "", None: "Unknown", "A- Oslo ": "Oslo",
    }
    assert apply(spark, city_of, list(cases)) == list(cases.values())


def test_malformed_day_fails_unless_lenient(spark):
    assert apply(spark, lambda c: parse_day(c, lenient=True), ["20200230", "x", None]) == [None, None, None]
    assert str(apply(spark, parse_day, ["20200229 ", None])[0]) == "2020-02-29"
    with pytest.raises(Exception, match="20200230"):
        apply(spark, parse_day, ["20200230"])


def test_ratio_and_growth_are_zero_without_a_base(spark):
    df = spark.createDataFrame([(5, 0), (5, 4), (0, 5), (3, -1)], "a int, b int")
    rows = df.select(ratio(F.col("a"), F.col("b")), growth_pct(F.col("a"), F.col("b"))).collect()
    assert [tuple(row) for row in rows] == [(0.0, 0.0), (1.25, 25.0), (0.0, -100.0), (0.0, 0.0)]


def test_ranked_equals_a_global_sort(spark):
    values = [0, 0, 0, 1, -1, 5, 5, 1000000, -1000000, 3, 2, 7, 10**15, 10**15 + 1, -(10**15), 0.01, -0.01, 0.02]
    rows = [(f"k{i:02d}", Decimal(str(value))) for i, value in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, v decimal(29,2)")
    result = {row.k: row for row in ranked(df, "v", ["k"]).collect()}
    expected = sorted(rows, key=lambda row: (-row[1], row[0]))
    running = Decimal(0)
    for position, (key, value) in enumerate(expected, start=1):
        running += value
        assert (result[key].Position, result[key].Running) == (position, running)
        assert result[key].Whole == sum(value for _, value in rows)


def test_ranked_random_groups(spark):
    random.seed(3)
    rows = [(f"k{i}", random.choice([0, 0, random.randint(-5, 5), random.randint(-10**9, 10**12)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v bigint")
    expected = pd.DataFrame(rows, columns=["k", "v"]).sort_values(["v", "k"], ascending=[False, True])
    result = ranked(df, "v", ["k"]).orderBy("Position").toPandas()
    assert list(result.Position) == list(range(1, 3001))
    assert list(result.k) == list(expected.k)
    assert list(result.Running) == list(expected.v.cumsum())


def test_ranked_only_some_rows(spark):
    df = spark.createDataFrame([("a", 5), (None, 9), ("b", 7)], "k string, v int")
    result = ranked(df, "v", ["k"], wholes=["v"], only=F.col("k").isNotNull()).orderBy("Position").collect()
    assert [(row.k, row.Position, row.Running, row.Whole, row.Whole_v) for row in result] == [
        ("b", 1, 7, 12, 21), ("a", 2, 12, 12, 21)
    ]


def test_per_column_groups_each_column_on_its_own(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", None, 7), (None, 1, 9)], "a string, b int, v int")
    rows = per_column(df, {"A": "a", "B": "b"}, {"v": "v"}).collect()
    assert sorted((row.Label, row.Key or "", row.v) for row in rows) == [
        ("A", "", 9), ("A", "x", 12), ("B", "", 7), ("B", "1", 14)
    ]
