"""Feeds whose files follow different versions of the contract."""

import gzip

import pytest

from shelfwise.operators import silver
from shelfwise.sources.feeds import CORRUPT, file_headers, read_bronze_by_name, read_bronze_strict, read_feeds

NAMES = {"Day": "SALESDATE", "Units": "Vendas Unidades"}
AGREED = "SALESDATE,StoreID,ITEMCODE,Vendas Unidades,PVP\n"


@pytest.fixture
def folder(tmp_path):
    place = tmp_path / "Sales.csv"
    place.mkdir()

    def write(name, text, encoding="utf-8"):
        file = place / name
        file.parent.mkdir(exist_ok=True)
        data = text.encode(encoding)
        file.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
        return str(place)

    return write


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_each_file_by_its_own_header(spark, folder):
    folder("a.csv", AGREED + '20200101,S1,I1,"1,200",2 €\n20200102,S1,,3,\n', "utf-8-sig")
    folder("b.csv", "PVP,StoreID, itemcode ,SALESDATE,Vendas Unidades\n4,S2,I2,20200103,5\n")
    folder("c/c.csv.gz", 'Remark,Day,StoreID,ITEMCODE,Units,PVP,Till\n"x, ""y""",20200104,S3,I3,6,7,T1\n')
    path = folder("c/d.csv", "Remark,Day,StoreID,ITEMCODE,Units,PVP,Till\n,20200105,S3,I3,8,9,\n")
    folder("_SUCCESS", "")
    feed = read_bronze_by_name(spark, path, "Sales", NAMES)
    assert all(row[CORRUPT] is None for row in feed.collect())
    assert rows_of(feed.drop(CORRUPT)) == sorted([
        ("20200101", "S1", "I1", "1,200", "2 €"), ("20200102", "S1", None, "3", None), ("20200103", "S2", "I2", "5", "4"),
        ("20200104", "S3", "I3", "6", "7"), ("20200105", "S3", "I3", "8", "9"),
    ], key=repr)
    assert len(file_headers(spark, path)) == 4


def test_a_single_agreed_file_reads_as_before(spark, folder):
    path = folder("a.csv", AGREED + "20200101,S1,I1,1,2\n20200101,S1\n20200101,S1,I1,1,2,3\n")
    assert rows_of(read_bronze_by_name(spark, path, "Sales")) == rows_of(read_bronze_strict(spark, path, "Sales"))


def test_wrong_field_counts_are_those_of_the_file(spark, folder):
    path = folder("a.csv", "Till,PVP,SALESDATE,StoreID,ITEMCODE,Vendas Unidades\nT,2,20200101,S1,I1,1\n2,20200101,S1,I1,1\nT,2,20200101,S1,I1,1,9\n")
    feed = read_bronze_by_name(spark, path, "Sales")
    assert [row[CORRUPT] is None for row in feed.collect()] == [True, False, False]
    staged = silver.stage_sales(feed).collect()
    assert [row.Reason for row in staged] == [None, silver.WRONG_FIELD_COUNT, silver.WRONG_FIELD_COUNT]


@pytest.mark.parametrize("header,what", [
    ("SALESDATE,StoreID,ITEMCODE,PVP", "missing"), ("SALESDATE,StoreID,ITEMCODE,Vendas Unidades,PVP,Units", "twice"),
])
def test_headers_that_are_not_understood_fail(spark, folder, header, what):
    folder("a.csv", AGREED)
    path = folder("b.csv", header + "\n")
    with pytest.raises(ValueError, match=what):
        read_bronze_by_name(spark, path, "Sales", NAMES)


def test_optional_columns_and_empty_folders(spark, folder):
    path = folder("a.csv", "SALESDATE,StoreID,ITEMCODE,Units\n20200101,S1,I1,1\n")
    feed = read_bronze_by_name(spark, path, "Sales", NAMES, frozenset({"PVP"}))
    assert rows_of(feed) == [("20200101", "S1", "I1", "1", None, None)]
    folder("b/x.csv", "")
    assert read_bronze_by_name(spark, f"{path}/b", "Sales").count() == 0


def test_all_feeds_by_name(spark, tmp_path):
    for name, text in {
        "Sales": "Units,Day,StoreID,ITEMCODE,PVP\n1,20200101,S1,I1,2\n", "Items": "SKU,ITEMCODE,Category,Brand,Segment\nCola,I1,D,B,S\n",
        "Store": "StoreID,Cliente,Store,Store Type,BannerID\nS1,M,M - Oslo,,B1\n", "Client": "BannerID,BannerName,Cliente,Store Type\nB1,M,M,A\n",
    }.items():
        (tmp_path / f"{name}.csv").write_text(text)
    feeds = read_feeds(spark, str(tmp_path), by_name=True, names={"Sales": NAMES})
    assert tuple(feeds["Sales"].first())[:5] == ("20200101", "S1", "I1", "1", "2")
    assert tuple(feeds["Items"].first()) == ("I1", "Cola", "D", "B", "S")
    with pytest.raises(Exception, match="(?i)header"):
        read_feeds(spark, str(tmp_path))["Items"].collect()
