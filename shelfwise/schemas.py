"""Contracts of the raw feeds (all text) and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

from .settings import PRICE_PRECISION, PRICE_SCALE

TEXT, WHOLE, LONG, DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def _text(*names: str) -> T.StructType:
    return _struct({name: TEXT for name in names})


SALES = _text("SALESDATE", "StoreID", "ITEMCODE", "Vendas Unidades", "PVP")
ITEMS = _text("ITEMCODE", "SKU", "Category", "Brand", "Segment")
STORE = _text("StoreID", "Cliente", "Store", "Store Type", "BannerID")
CLIENT = _text("BannerID", "BannerName", "Cliente", "Store Type")

FEEDS = {"Sales": SALES, "Items": ITEMS, "Store": STORE, "Client": CLIENT}

STAR = ["Fact_Sales", "Dim_Item", "Dim_Store", "Dim_Date"]
# Only tables that grow with sales are split into partitions.
PARTITIONS = {
    "Silver_Sales": ["Ano", "Mes"], "Fact_Sales": ["Ano", "Mes"], "Sold_Months": ["Ano", "Mes"],
    "Sales_Wide": ["Year", "Month"], "Sales_Daily": ["Year", "Month"], "Audit_Grain": ["Ano", "Mes"],
}


def tables(price_scale: int = PRICE_SCALE) -> dict[str, T.StructType]:
    """Cleaned sales, star schema, the star joined once per load, and its totals per day."""
    price = T.DecimalType(PRICE_PRECISION, price_scale)
    # units (int) x price: Spark's own result type for the product, so no sale line can overflow it.
    revenue = T.DecimalType(PRICE_PRECISION + 11, price_scale)
    cleaned = {
        "DateKey": TEXT, "Data": DATE, "StoreID": TEXT, "ITEMCODE": TEXT,
        "Vendas_Unidades": WHOLE, "PVP": price, "Vendas_Valor": revenue,
    }
    return {
        # With the load that brought a line, and for lines in quarantine the reason and the text. They have no month.
        # ``Rejected``: why the fact leaves a line out.
        "Silver_Sales": _struct({**cleaned, "Load": TEXT, "Reason": TEXT, "Line": TEXT, "Rejected": TEXT, "Ano": WHOLE, "Mes": WHOLE}),
        "Cleaned_Sales": _struct(cleaned),
        "Loads": _struct({"Load": TEXT, "Since": DATE}),
        "Fact_Sales": _struct({
            "StoreID": TEXT, "ITEMCODE": TEXT, "DateKey": TEXT,
            "Vendas Unidades": WHOLE, "PVP": price, "Vendas Valor": revenue, "Ano": WHOLE, "Mes": WHOLE,
        }),
        "Dim_Item": ITEMS,
        "Dim_Store": _text("StoreID", "Store", "City", "Cliente", "Client_Name", "Store Type"),
        "Dim_Date": _struct({
            "Data": DATE, "DateKey": TEXT, "Ano": WHOLE, "Mes": WHOLE, "Dia": WHOLE, "Trimestre": WHOLE,
            "Nome_Mes": TEXT, "AnoMes": TEXT,
        }),
        # What each code has in each month: Kind is 'item', 'store', 'day' or, for lines the fact leaves out, 'rejected'
        # with the reason as code. Lines are all understood ones; Sold of them are in the fact, with Units and Revenue.
        "Sold_Months": _struct({
            "Kind": TEXT, "Code": TEXT, "Lines": LONG, "Sold": LONG, "Units": LONG,
            "Revenue": T.DecimalType(38, price_scale), "Ano": WHOLE, "Mes": WHOLE,
        }),
        # Keys of several sale lines, and how many; a day belongs to one month only.
        "Audit_Grain": _struct({
            "StoreID": TEXT, "ITEMCODE": TEXT, "DateKey": TEXT, "Lines": LONG, "Ano": WHOLE, "Mes": WHOLE,
        }),
        # What dashboards add up. A revenue beyond 18 digits is split over several rows, so that sums work on longs.
        "Sales_Daily": _struct({
            "Date": DATE, "YearMonth": TEXT, "Client": TEXT, "City": TEXT, "SKU": TEXT, "Brand": TEXT,
            "Revenue": price, "Volume": LONG, "Lines": LONG, "Year": WHOLE, "Month": WHOLE,
        }),
        "Sales_Wide": _struct({
            "DateKey": TEXT, "StoreID": TEXT, "ITEMCODE": TEXT, "Revenue": revenue, "Volume": WHOLE,
            "Date": DATE, "YearMonth": TEXT, "Month": WHOLE, "Year": WHOLE, "MonthName": TEXT,
            "Store": TEXT, "Client": TEXT, "StoreType": TEXT, "City": TEXT,
            "SKU": TEXT, "Category": TEXT, "Brand": TEXT, "Segment": TEXT,
        }),
    }
