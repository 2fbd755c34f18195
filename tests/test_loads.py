"""Loads that are seen whole or not at all, late lines, changed masters, and the daily totals they maintain."""

import decimal
import os

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import gold, quality
from shelfwise.operators.daily import KEYS, sales_daily
from shelfwise.operators.incremental import beyond_stored
from shelfwise.plans import build
from shelfwise.plans.build import (
    build_gold, load_increment, load_masters, read_daily, read_quarantine, read_wide, refresh_grain, wide_frame,
)
from shelfwise.sources.store import Load, clean_up, open_snapshot, read_star, snapshot_numbers

ITEMS = [("I1", "Cola", "Drinks", "B1", "Small"), ("I3", "Tea", "Drinks", "B1", "Small")]
STORES = [("S1", "X", "X - Oslo", "A", "B1")]


def feeds_of(spark, *lines, items=ITEMS, stores=STORES):
    rows = [(day, store, item, units, "2") for day, store, item, units in lines]
    return {
        "Sales": spark.createDataFrame(rows, schemas.SALES), "Items": spark.createDataFrame(items, schemas.ITEMS),
        "Store": spark.createDataFrame(stores, schemas.STORE),
        "Client": spark.createDataFrame([("B1", "X", "X", "A")], schemas.CLIENT),
    }


def lines(snapshot):
    """The wide lines, which the star of the same snapshot must give too, and the daily totals as well."""
    wide = sorted((row.DateKey, row.StoreID, row.ITEMCODE, row.Volume, row.SKU) for row in snapshot.table("Sales_Wide").collect())
    joined = wide_frame(snapshot.star()).collect()
    assert sorted((row.DateKey, row.StoreID, row.ITEMCODE, row.Volume, row.SKU) for row in joined) == wide
    expected = sales_daily(snapshot.table("Sales_Wide"))
    daily = snapshot.table("Sales_Daily")
    assert sorted(map(str, daily.select(expected.columns).collect())) == sorted(map(str, expected.collect()))
    return wide


def test_readers_see_one_load(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert open_snapshot(spark, root) is None
    build_gold(spark, feeds_of(spark, ("20200101", "S1", "I1", "1")), root)
    before = open_snapshot(spark, root)
    first = [("20200101", "S1", "I1", 1, "Cola")]
    assert lines(before) == first

    # A load that is broken off after it has written most of its tables changes nothing, for old readers and new ones.
    seen = []
    write_wide = build._write_wide

    def broken(run, *args):
        write_wide(run, *args)
        seen.append(lines(open_snapshot(spark, root)))
        raise RuntimeError("lost")

    monkeypatch.setattr(build, "_write_wide", broken)
    more = feeds_of(spark, ("20200101", "S1", "I1", "1"), ("20200201", "S1", "I3", "2"))
    with pytest.raises(RuntimeError):
        load_increment(spark, more, root, "more")
    monkeypatch.undo()
    assert seen == [first] and lines(before) == first == lines(open_snapshot(spark, root))

    load_increment(spark, more, root, "more")
    after = open_snapshot(spark, root)
    both = [*first, ("20200201", "S1", "I3", 2, "Tea")]
    assert lines(after) == both and lines(before) == first

    # The next load removes what only the first one and the broken one need.
    load_increment(spark, feeds_of(spark, ("20200201", "S1", "I3", "3")), root, "third")
    assert snapshot_numbers(spark, root) == [2, 3]
    assert lines(after) == both and lines(open_snapshot(spark, root)) == [*first, ("20200201", "S1", "I3", 3, "Tea")]
    clean_up(spark, root, keep=1)
    current = open_snapshot(spark, root)
    stored = {
        os.path.relpath(folder, root) for folder, _, names in os.walk(root) if any(name.endswith(".parquet") for name in names)
    }
    assert stored <= {folder for name in current.tables for folder in current.folders(name)}
    assert len(lines(current)) == 2


def test_the_second_of_two_loads_at_once_fails(spark, tmp_path):
    root = str(tmp_path)
    build_gold(spark, feeds_of(spark, ("20200101", "S1", "I1", "1")), root)
    one, other = Load(spark, root, "one"), Load(spark, root, "other")
    one.commit()
    with pytest.raises(FileExistsError):
        other.commit()
    assert len(lines(open_snapshot(spark, root))) == 1


def test_late_lines_reach_their_month_or_the_quarantine(spark, tmp_path):
    root = str(tmp_path)
    first = [("20200101", "S1", "I1", "1"), ("20200101", "S1", "I1", "1"), ("20200310", "S1", "I1", "1")]
    load_increment(spark, feeds_of(spark, *first), root, "a")
    # One of the first day's two equal lines again and three in all, a line of a month without sales, one too late.
    late = [("20200101", "S1", "I1", "1")] * 3 + [("20200215", "S1", "I3", "4"), ("20191201", "S1", "I1", "7")]
    feed = feeds_of(spark, *late, ("20200310", "S1", "I1", "1"), ("bad", "S1", "I1", "1"))
    expected = [("20200101", 1)] * 3 + [("20200215", 4), ("20200310", 1)]
    for load in ("b", "b", "the same file again"):
        load_increment(spark, feed, root, load, lateness=80)
        assert [(line[0], line[3]) for line in lines(open_snapshot(spark, root))] == expected
        assert sorted((row.Reason, row.Line) for row in read_quarantine(spark, root).collect()) == [
            ("late", "20191201,S1,I1,7,2.000000"), ("unreadable date", "bad,S1,I1,1,2")
        ]


@pytest.mark.parametrize("merge", [True, False])
def test_merge_adds_what_is_not_stored(spark, tmp_path, merge):
    root = str(tmp_path)
    feed = feeds_of(spark, ("20200101", "S1", "I1", "1"), ("20200101", "S1", "I1", "1"), ("20200301", "S1", "I1", "1"))
    for load in ("a", "b", "c"):
        load_increment(spark, feed, root, load, whole_days=False, merge=merge)
    assert len(lines(open_snapshot(spark, root))) == (3 if merge else 9)


def test_beyond_stored_counts(spark):
    def frame(*keys):
        return spark.createDataFrame([(key, "x") for key in keys], "k string, other string")

    found = beyond_stored(frame("a", "a", "a", "b", None, None), frame("a", "c", None), ["k"])
    assert sorted(map(tuple, found.collect()), key=str) == [("a", "x"), ("a", "x"), ("b", "x"), (None, "x")]


def test_changed_masters_rewrite_their_months_only(spark, tmp_path):
    root, unmapped = str(tmp_path), "⚠️ UNMAPPED (Missing SKU)"
    sales = [
        ("20200101", "S1", "I1", "1"), ("20200201", "S1", "NEW", "2"), ("20200301", "S1", "I3", "3"), ("20200401", "S2", "I1", "4"),
        ("20200501", "S1", "NEW", "0"),
    ]
    build_gold(spark, feeds_of(spark, *sales), root)
    before = open_snapshot(spark, root)
    assert [line[4] for line in lines(before)] == ["Cola", unmapped, "Tea"]
    # NEW is known now, I3 has another brand; I1 is unchanged, in whatever order; a second store opens its old sales.
    items = [("I3", "Tea", "Drinks", "B9", "Small"), ITEMS[0], ("NEW", "Water", "Drinks", "B2", "Big")]
    stores = [*STORES, ("S2", "X", "X - Bergen", "A", "B1")]
    months = load_masters(spark, feeds_of(spark, items=items, stores=stores), root, "masters")
    assert months == [(2020, 2), (2020, 3), (2020, 4), (2020, 5)]
    after = open_snapshot(spark, root)
    assert [line[4] for line in lines(after)] == ["Cola", "Water", "Tea", "Cola"]
    assert after.tables["Sales_Wide"]["Year=2020/Month=1"] == before.tables["Sales_Wide"]["Year=2020/Month=1"]
    assert after.tables["Fact_Sales"] == before.tables["Fact_Sales"]
    assert sorted((row.Brand, row.City) for row in after.table("Sales_Daily").collect()) == [
        ("B1", "Bergen"), ("B1", "Oslo"), ("B2", "Oslo"), ("B9", "Oslo")
    ]
    # Nothing has changed since: no month is written.
    assert load_masters(spark, feeds_of(spark, items=items[::-1], stores=stores), root, "masters again") == []
    # An item that leaves the master is unmapped again.
    load_masters(spark, feeds_of(spark, items=ITEMS, stores=stores), root, "masters back")
    assert [line[4] for line in lines(open_snapshot(spark, root))] == ["Cola", unmapped, "Tea", "Cola"]


def test_daily_totals_after_three_increments(spark, tmp_path):
    root = str(tmp_path)
    feeds = [
        [("20200101", "S1", "I1", "1"), ("20200101", "S1", "I1", "5"), ("20200131", "S1", "I3", "2")],
        [("20200131", "S1", "I3", "3"), ("20200102", "S1", "I1", "9"), ("20200201", "S1", "NEW", "1")],
        [("20200201", "S1", "NEW", "1"), ("20200201", "S1", "NEW", "2")],
        [("20200201", "S1", "NEW", "0"), ("20210101", "S1", "I1", "2")],
    ]
    for number, feed in enumerate(feeds):
        load_increment(spark, feeds_of(spark, *feed), root, f"load {number}")
        lines(open_snapshot(spark, root))
    star = read_star(spark, root)
    again = sales_daily(wide_frame(star))
    assert sorted(map(str, read_daily(spark, root).select(again.columns).collect())) == sorted(map(str, again.collect()))
    assert sorted((str(row.Date), row.Volume, row.Lines) for row in again.collect()) == [
        ("2020-01-01", 6, 2), ("2020-01-02", 9, 1), ("2020-01-31", 3, 1), ("2021-01-01", 2, 1),
    ]


@pytest.mark.parametrize("revenue", ["0.01", "499999999999.99", "500000000000", "98765432109876543210.123456", "-7000000000000.5"])
def test_revenue_beyond_18_digits_is_split_exactly(spark, make_wide, revenue):
    line = make_wide(("2020-01-01", 1)).withColumn("Revenue", F.lit(decimal.Decimal(revenue)).cast("decimal(38,6)"))
    found = sales_daily(line)
    assert dict(found.dtypes)["Revenue"] == "decimal(18,6)"
    sums = found.groupBy(*KEYS).agg(F.sum("Revenue").alias("r"), F.sum("Volume").alias("v"), F.sum("Lines").alias("l"), F.count("*").alias("n"))
    row = sums.first()
    assert (row.r, row.v, row.l) == (decimal.Decimal(revenue), 1, 1)
    assert (row.n > 1) == (abs(decimal.Decimal(revenue)) >= 500_000_000_000)


def audits(spark, root, feed):
    """Stored audits after all loads, and the same from all stored sale lines and the whole feed."""
    now = open_snapshot(spark, root)
    star, months = now.star(), now.table("Sold_Months")
    scopes = {"master": {
        "Item": (feed["Items"], "ITEMCODE"), "Store": (feed["Store"], "StoreID"), "Date": (star["Dim_Date"], "DateKey")
    }}
    keys = ["StoreID", "ITEMCODE", "DateKey", "Lines"]
    stored = quality.stored_orphans(months, scopes), quality.stored_rejects(months), now.table("Audit_Grain").select(keys)
    full = (
        quality.audit_orphan_scopes(star["Fact_Sales"], scopes), quality.audit_rejects(feed["Sales"]),
        quality.audit_grain(star["Fact_Sales"]),
    )

    def rows(frame):
        return sorted(tuple(str(float(v)) if isinstance(v, decimal.Decimal) else str(v) for v in row) for row in frame.collect())

    for one, other in zip(stored, full):
        assert rows(one) == rows(other)
    return [rows(one) for one in stored]


def test_stored_audits_equal_full_ones_after_increments(spark, tmp_path):
    root = str(tmp_path)
    first = [
        ("20200101", "S1", "I1", "1"), ("20200101", "S1", "I1", "3"), ("20200101", "S9", "I1", "n/a"),
        ("20200201", "S1", "NEW", "2"), ("20200201", None, "I1", "0"),
    ]
    load_increment(spark, feeds_of(spark, *first), root, "a")
    assert refresh_grain(spark, root) == [(2020, 1), (2020, 2)]
    assert refresh_grain(spark, root) == []
    assert audits(spark, root, feeds_of(spark, *first))[2] == [("S1", "I1", "20200101", "2")]

    # The last day again and a third month: January's totals and its grain are not made again.
    before = open_snapshot(spark, root)
    more = [("20200201", "S1", "NEW", "2"), ("20200201", "S1", "NEW", "-4"), ("20200201", None, "I1", "5"), ("20200301", "S8", "I3", None)]
    load_increment(spark, feeds_of(spark, *more), root, "b")
    assert refresh_grain(spark, root) == [(2020, 2)]  # March has no sale yet
    after = open_snapshot(spark, root)
    for name in ("Sold_Months", "Audit_Grain"):
        assert after.tables[name]["Ano=2020/Mes=1"] == before.tables[name]["Ano=2020/Mes=1"]
    orphans, rejects, _ = audits(spark, root, feeds_of(spark, *first[:3], *more))
    assert rejects == [("missing units", "1"), ("returned units", "1"), ("unreadable units", "1")]
    assert ("master", "Item", "1", "1", "4.0") in orphans and ("master", "Store", "1", "1", "10.0") in orphans

    # A line that was one of several of its key is gone: so is its month's row.
    load_increment(spark, feeds_of(spark, ("20200301", "S1", "I3", "1"), ("20200301", "S1", "I3", "1")), root, "c")
    assert refresh_grain(spark, root) == [(2020, 3)]
    load_increment(spark, feeds_of(spark, ("20200301", "S1", "I3", "1")), root, "d")
    assert refresh_grain(spark, root) == [(2020, 3)]
    assert [row.DateKey for row in open_snapshot(spark, root).table("Audit_Grain").collect()] == ["20200101"]


def test_late_lines_with_other_reasons_are_other_lines(spark, tmp_path):
    root = str(tmp_path)
    load_increment(spark, feeds_of(spark, ("20200101", "S1", "I1", "0"), ("20200301", "S1", "I1", "1")), root, "a")
    late = feeds_of(spark, ("20200101", "S1", "I1", "0"), ("20200101", "S1", "I1", "?"), ("20200301", "S1", "I1", "1"))
    for load in ("b", "c"):
        load_increment(spark, late, root, load)
    refresh_grain(spark, root)
    assert audits(spark, root, late)[1] == [("unreadable units", "1"), ("zero units", "1")]
