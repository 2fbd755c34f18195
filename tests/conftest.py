from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise import session  # noqa: E402
from shelfwise.plans import registry  # noqa: E402

WIDE_SCHEMA = (
    "DateKey string, StoreID string, ITEMCODE string, Revenue decimal(29,2), Volume int, Date date, YearMonth string, "
    "Month int, Year int, MonthName string, Store string, Client string, StoreType string, City string, SKU string, "
    "Category string, Brand string, Segment string"
)
TESTDATA = os.environ.get("SHELFWISE_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def make_wide(spark):
    """Sale lines from (day, revenue) with further wide columns by keyword per line."""

    def make(*lines):
        rows = []
        for line in lines:
            day, revenue, *rest = line
            extra = rest[0] if rest else {}
            date = dt.date.fromisoformat(day)
            row = {
                "DateKey": date.strftime("%Y%m%d"), "StoreID": "S1", "ITEMCODE": "I1", "Revenue": revenue,
                "Volume": 1, "Date": date, "YearMonth": date.strftime("%Y-%m"), "Month": date.month,
                "Year": date.year, "MonthName": date.strftime("%B"), "Store": "X - Oslo", "Client": "X",
                "StoreType": "A", "City": "Oslo", "SKU": "Cola", "Category": "Drinks", "Brand": "B1", "Segment": "Small",
            }
            row.update(extra)
            rows.append(tuple(row.values()))
        from decimal import Decimal

        typed = [tuple(Decimal(str(v)) if i == 3 else v for i, v in enumerate(row)) for row in rows]
        return spark.createDataFrame(typed, WIDE_SCHEMA)

    return make


@pytest.fixture(scope="session")
def table_wide(spark):
    """Wide frame over the driver tables, read from the stored star schema."""
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return registry.wide(spark, TESTDATA)


@pytest.fixture(scope="session")
def testdata():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return TESTDATA
