"""From raw feeds to a stored star schema, in loads that are seen whole or not at all (see ``sources.store``)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Collection, Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import zorder
from ..operators import gold, silver
from ..operators.daily import sales_daily
from ..operators.incremental import LINE_KEY, beyond_stored, differing_days
from ..operators.quality import audit_grain
from ..settings import IN_MEMORY_FACTOR, PORTION_BYTES, PORTIONS, PRICE_SCALE, STORED_FILES
from ..sources.shared import discard, materialized, release_shuffles
from ..sources.store import KEPT, Load, month_of, read_table

LATE = "late"
Months = Sequence[tuple[int | None, int | None]]


def gold_layer(feeds: dict[str, DataFrame], sales: DataFrame | None = None, **labels: str) -> dict[str, DataFrame]:
    """The four gold tables as lazy DataFrames. ``sales`` takes an already cleaned sales table."""
    items = silver.clean_items(feeds["Items"])
    sales = silver.clean_sales(feeds["Sales"]) if sales is None else sales
    return {
        "Fact_Sales": gold.fact_sales(sales),
        "Dim_Item": gold.dim_item(sales, items, **labels),
        "Dim_Store": gold.dim_store(feeds["Store"], feeds["Client"]),
        "Dim_Date": gold.dim_date(sales),
    }


def wide_frame(star: dict[str, DataFrame], late: Collection[str] = ()) -> DataFrame:
    return gold.sales_wide(star["Fact_Sales"], star["Dim_Date"], star["Dim_Store"], star["Dim_Item"], late)


def build_gold(
    spark: SparkSession,
    feeds: dict[str, DataFrame],
    root: str,
    *,
    load: str = "full",
    lenient_dates: bool = False,
    price_scale: int = PRICE_SCALE,
    **labels: str,
) -> dict[str, DataFrame]:
    """Full refresh of all tables below ``root``; returns the star as stored.

    The feed is parsed once and stored by month, broken lines in quarantine (see ``silver.stage_sales``). One scan of its
    two code columns gives the months each code was sold in, from which item dimension and calendar follow. The fact
    comes from month files and needs no shuffle. The wide frame is the only join of sale lines there is, and its totals
    per day the only thing dashboards read.
    """
    run = Load(spark, root, load)
    run.tables.clear()
    staged = silver.stage_sales(feeds["Sales"], load, lenient_dates=lenient_dates, price_scale=price_scale)
    # Lines reach their month without the columns that follow from the others.
    run.write(staged, "Silver_Sales", after=_after(load))
    cleaned = _cleaned(run.table("Silver_Sales", price_scale), price_scale)
    _write_sold_months(run, None, price_scale)
    _write_dimensions(run, feeds, cleaned, **labels)
    run.write(gold.fact_sales(cleaned), "Fact_Sales", spread=False)
    _write_wide(run, None, price_scale)
    return run.commit().star(price_scale)


# Of a staged line, what follows from its other columns and is computed again where it has been dealt to.
AFTER = ("Vendas_Valor", "Load")


def _after(load: str) -> dict[str, Column]:
    return dict(zip(AFTER, (silver.revenue(), F.lit(load))))


def sold_months(stored: DataFrame) -> DataFrame:
    """What each item, store and day has in each month, and each reason for which the fact leaves lines out.

    These are mergeable: an increment makes those of its months again, and audits add up months (``quality.stored_orphans``,
    ``stored_rejects``). One scan, added up on the map side. Lines in quarantine are not in it.
    """
    lines, sold = stored.where(F.col("Reason").isNull()), F.col("Rejected").isNull()
    codes = F.array(*[
        F.struct(F.lit(kind).alias("Kind"), F.col(key).alias("Code"))
        for kind, key in (("item", "ITEMCODE"), ("store", "StoreID"), ("day", "DateKey"), ("rejected", "Rejected"))
    ])
    listed = lines.select(
        F.inline(codes), F.year("Data").alias("Ano"), F.month("Data").alias("Mes"), sold.alias("_sold"),
        F.when(sold, F.col("Vendas_Unidades")).alias("_units"), F.when(sold, F.col("Vendas_Valor")).alias("_revenue"),
    )
    return listed.where(~(F.col("_sold") & (F.col("Kind") == "rejected"))).groupBy("Kind", "Code", "Ano", "Mes").agg(
        F.count(F.lit(1)).alias("Lines"), F.count_if("_sold").alias("Sold"),
        F.coalesce(F.sum("_units"), F.lit(0)).alias("Units"), F.coalesce(F.sum("_revenue"), F.lit(0)).alias("Revenue"),
    )


def _write_sold_months(run: Load, months: Months | None, price_scale: int) -> None:
    """What is sold in these months or all, from the cleaned sales that the load has written."""
    stored = run.table("Silver_Sales", price_scale)
    for portion in run.state().portions("Silver_Sales", months, PORTIONS, PORTION_BYTES):
        run.write(sold_months(stored.where(_in_months(portion, "Ano", "Mes"))), "Sold_Months", months=portion)


def _sold_items(sold: DataFrame) -> DataFrame:
    return sold.where(F.col("Kind") == "item").select(F.col("Code").alias("ITEMCODE")).distinct()


def _write_dimensions(run: Load, feeds: dict[str, DataFrame], cleaned: DataFrame, **labels: str) -> None:
    sold = run.table("Sold_Months")
    run.write(gold.dim_item(_sold_items(sold), silver.clean_items(feeds["Items"]), **labels), "Dim_Item")
    run.write(gold.dim_store(feeds["Store"], feeds["Client"]), "Dim_Store")
    run.write(_calendar(sold), "Dim_Date")


def _calendar(sold: DataFrame) -> DataFrame:
    """The days of all years with sales, of which only partition values are read."""
    return gold.dim_date(sold.select(F.make_date(F.col("Ano"), F.col("Mes"), F.lit(1)).alias("Data")))


def _write_wide(run: Load, months: Months | None, price_scale: int) -> None:
    """The wide frame and its daily totals, of these months or all, from the star that the load has written so far."""
    state = run.state()
    star = state.star(price_scale)
    # Joined to broadcast dimensions, lines stay in the tasks that read their month; a sort-merge join deals them anew. Then
    # they go back to their month without the columns of those dimensions that are broadcast.
    most = broadcast_bytes(run.spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    names = {"stores": "Dim_Store", "items": "Dim_Item", "dates": "Dim_Date"}
    small = [dimension for dimension, name in names.items() if state.stored_bytes(name) * IN_MEMORY_FACTOR < most]
    stays = len(small) == len(names)
    late = [] if stays else small
    cell = zorder.cell({
        "Client": star["Dim_Store"].select(F.col("Cliente").alias("Client")), "City": star["Dim_Store"], "Brand": star["Dim_Item"],
    })
    for portion in state.portions("Fact_Sales", months, PORTIONS, PORTION_BYTES):
        lines = star["Fact_Sales"].where(_in_months(portion, "Ano", "Mes"))
        run.write(wide_frame({**star, "Fact_Sales": lines}, late), "Sales_Wide", months=portion, spread=not small, cell=cell)
        wide = run.table("Sales_Wide", price_scale).where(_in_months(portion, "Year", "Month"))
        run.write(sales_daily(wide, price_scale), "Sales_Daily", months=portion, cell=cell)


def broadcast_bytes(threshold: str) -> int:
    """The broadcast threshold as a number, which Spark gives with a unit by default ('10485760b', '256k')."""
    found = re.fullmatch(r"(-?[0-9]+)([kmgtp]?)b?", threshold.strip().lower())
    return max(0, int(found[1])) * 1024 ** " kmgtp".index(found[2] or " ") if found else 0


def _in_months(months: Iterable[tuple[int | None, int | None]], year: str | Column, month: str | Column) -> Column:
    """Of these months: a condition on partition values, as there are few months for even the longest history."""
    year, month = [F.col(column) if isinstance(column, str) else column for column in (year, month)]
    chosen = [year.eqNullSafe(F.lit(y)) & month.eqNullSafe(F.lit(m)) for y, m in months]
    return reduce(or_, chosen, F.lit(False))


def _months_of(df: DataFrame) -> list[tuple[int | None, int | None]]:
    return [tuple(row) for row in df.select("Ano", "Mes").distinct().collect()]


def _with_month(lines: DataFrame) -> DataFrame:
    return lines.withColumns({"Ano": F.year("Data"), "Mes": F.month("Data")})


def load_increment(
    spark: SparkSession,
    feeds: dict[str, DataFrame],
    root: str,
    load: str,
    *,
    whole_days: bool = True,
    merge: bool = False,
    lateness: int | None = None,
    lenient_dates: bool = False,
    price_scale: int = PRICE_SCALE,
    **labels: str,
) -> None:
    """Bring new sales into every table below ``root``, up to the daily totals; the first load builds them.

    With ``whole_days`` the feed holds whole days: its days from the last stored day on replace these days. Its older
    lines are late: those that are not stored yet (``incremental.beyond_stored``) reach their month or, if they are more
    than ``lateness`` days older than the last stored day, the quarantine with the reason 'late'; no line is left out.
    Without ``whole_days`` all lines are added, whatever their date, or with ``merge`` all that are not stored yet, in both
    cases with the same rule for late ones. Lines in quarantine that are there already are not added again.

    Only the months concerned are written again. New item codes enter the item dimension (as unmapped, if the master
    lacks them), new years the calendar. ``load`` names the run; repeated under its name, it starts from the same day and
    replaces its own lines. A run that is broken off changes nothing.
    """
    run = Load(spark, root, load)
    if run.base is None:
        build_gold(spark, feeds, root, load=load, lenient_dates=lenient_dates, price_scale=price_scale, **labels)
        return
    staged = silver.stage_sales(feeds["Sales"], load, lenient_dates=lenient_dates, price_scale=price_scale)
    increment = materialized(staged.drop(*AFTER), "increment", **STORED_FILES)
    staged = increment.withColumns(_after(load)).select(staged.columns)
    stored = run.table("Silver_Sales", price_scale)
    kept = stored.where(F.col("Load") != load)
    since = _since(run, load, price_scale)
    day, dated = F.lit(since), F.col("Ano").isNotNull()
    recent = staged.where(dated & (F.col("Data") >= day)) if whole_days else staged.where(dated)
    late = staged.where(dated & (F.col("Data") < day)) if whole_days else staged.where("false")
    if merge and not whole_days:
        recent, late = recent.where("false"), recent
    if lateness is not None:
        last = day - F.make_dt_interval(days=F.lit(lateness))
        recent, late = _quarantined(recent, last), _quarantined(late, last)

    # Stored lines of the feed's days, in their months or in quarantine, are what late lines are compared with. Line by line
    # only on days that differ; of a feed that has been loaded before, none does.
    in_quarantine = kept.where(F.col("Ano").isNull() & (F.col("Reason") == LATE))

    def held(days: DataFrame) -> DataFrame:
        return kept.where(_in_months(_months_of(_with_month(days)), "Ano", "Mes")).unionByName(in_quarantine)

    late_key = [*LINE_KEY, "Rejected"]
    differ = materialized(differing_days(late, held(late), late_key), "differing-days")
    stored_late, undated = held(differ), kept.where(F.col("Ano").isNull())
    fresh_parts: list[DataFrame] = []
    for portion in run.state().portions("Silver_Sales", _months_of(_with_month(differ)), PORTIONS, PORTION_BYTES // 4):
        days = F.broadcast(differ.where(_in_months(portion, F.year("Data"), F.month("Data"))))
        part = beyond_stored(late.join(days, "Data", "left_semi"), stored_late.join(days, "Data", "left_semi"), late_key)
        if not fresh_parts:
            others = beyond_stored(staged.where(~dated), undated, [*LINE_KEY, "Reason", "Line"])
            part = recent.unionByName(part).unionByName(others)
        fresh_parts.append(materialized(part, "fresh", **STORED_FILES))
        if portion:
            release_shuffles(spark)
    discard(increment, differ)
    fresh = reduce(DataFrame.unionByName, fresh_parts)
    if whole_days:
        understood = dated | (F.col("Reason") == LATE)
        days = fresh.where(understood & (F.col("Data") >= day)).select("Data").distinct()  # calendar days
        kept = kept.join(F.broadcast(days), "Data", "left_anti")
    months = sorted({*_months_of(fresh), *_months_of(stored.where(F.col("Load") == load))}, key=str)
    run.write(kept.where(_in_months(months, "Ano", "Mes")).unionByName(fresh), "Silver_Sales", months=months)
    discard(*fresh_parts)

    silver_now = run.table("Silver_Sales", price_scale).where(_in_months(months, "Ano", "Mes"))
    cleaned = _cleaned(silver_now, price_scale)
    _write_sold_months(run, months, price_scale)
    known = run.table("Dim_Item").select(F.col("ITEMCODE").alias("_known"))
    codes = cleaned.select("ITEMCODE").distinct()
    new_codes = codes.join(known, codes["ITEMCODE"].eqNullSafe(known["_known"]), "left_anti")
    items = silver.clean_items(feeds["Items"])
    new_items = gold.unmapped_items(new_codes, items, **labels).unionByName(items.join(new_codes, "ITEMCODE", "left_semi"))
    run.write(new_items, "Dim_Item", add=True)
    calendar = _calendar(run.table("Sold_Months"))
    run.write(calendar.join(run.table("Dim_Date"), "DateKey", "left_anti"), "Dim_Date", add=True)
    run.write(gold.fact_sales(cleaned), "Fact_Sales", months=months, spread=False)
    _write_wide(run, months, price_scale)
    run.commit()


def _quarantined(lines: DataFrame, last: Column) -> DataFrame:
    """Lines of days before ``last`` without a month and with the reason, as lines in quarantine are."""
    is_late = F.col("Data") < last
    text = F.to_csv(F.struct("DateKey", "StoreID", "ITEMCODE", "Vendas_Unidades", "PVP"))
    return lines.withColumns({
        "Reason": F.when(is_late, F.lit(LATE)).otherwise(F.col("Reason")),
        "Line": F.when(is_late, text).otherwise(F.col("Line")),
        "Ano": F.when(~is_late, F.col("Ano")), "Mes": F.when(~is_late, F.col("Mes")),
    })


def load_masters(
    spark: SparkSession, feeds: dict[str, DataFrame], root: str, load: str, *, price_scale: int = PRICE_SCALE, **labels: str
) -> list[tuple[int | None, int | None]]:
    """Bring changed item, store and client masters into the dimensions and into the old rows they concern.

    Codes whose rows differ from the stored ones, such as an item that was sold unmapped and is in the master now, are
    looked up among the months each code was sold in; only these months of the wide frame and its daily totals are
    written again, from the fact as stored. Returns them.
    """
    run = Load(spark, root, load)
    if run.base is None:
        raise FileNotFoundError(f"nothing is loaded below {root}")
    sold = run.table("Sold_Months")
    before = {"item": run.table("Dim_Item"), "store": run.table("Dim_Store")}
    run.write(gold.dim_item(_sold_items(sold), silver.clean_items(feeds["Items"]), **labels), "Dim_Item")
    run.write(gold.dim_store(feeds["Store"], feeds["Client"]), "Dim_Store")
    after = {"item": run.table("Dim_Item"), "store": run.table("Dim_Store")}
    changed = reduce(DataFrame.unionByName, [
        _changed(before[kind], after[kind], key).select(F.lit(kind).alias("Kind"), F.col(key).alias("Code"))
        for kind, key in (("item", "ITEMCODE"), ("store", "StoreID"))
    ])
    months = sorted(_months_of(sold.join(changed, ["Kind", "Code"], "left_semi")), key=str)
    if months:
        _write_wide(run, months, price_scale)
    run.commit()
    return months


def refresh_grain(spark: SparkSession, root: str) -> list[tuple[int | None, ...]]:
    """Bring the stored audit of the fact's grain up to date; returns the months that were audited again.

    The manifest lists the folders of each month that the audit was made from. Loads write a changed month into new ones,
    so that only these are read and grouped, and a load itself does not wait for it.
    """
    run = Load(spark, root, "grain audit")
    if run.base is None:
        raise FileNotFoundError(f"nothing is loaded below {root}")
    fact = run.tables["Fact_Sales"]
    parts = [part for part in {**fact, **run.audited} if fact.get(part) != run.audited.get(part)]
    months = sorted(map(month_of, parts), key=str)
    if months:
        for portion in run.state().portions("Fact_Sales", months, PORTIONS, PORTION_BYTES):
            changed = run.table("Fact_Sales").where(_in_months(portion, "Ano", "Mes"))
            run.write(audit_grain(changed, ["StoreID", "ITEMCODE", "DateKey", "Ano", "Mes"]), "Audit_Grain", months=portion)
        run.audited = {part: list(versions) for part, versions in fact.items()}
        run.commit(KEPT + 1)  # an audit changes no sales: the snapshots that a load keeps stay
    return months


def _changed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose rows are not the same on both sides, counted, so that repeated rows matter too."""
    both = before.withColumn("_n", F.lit(-1)).unionByName(after.withColumn("_n", F.lit(1)))
    rows = both.groupBy(*before.columns).agg(F.sum("_n").alias("_n"))
    return rows.where("_n <> 0").select(key).distinct()


def _since(run: Load, load: str, price_scale: int) -> dt.date:
    """The day from which a load replaces what is stored. It is stored with the load, so that a load that is repeated
    does not take its own lines for stored ones."""
    if run.base.has("Loads"):
        noted = run.table("Loads").where(F.col("Load") == load).first()
        if noted:
            return noted.Since
    day = last_stored_day(run.table("Sales_Daily", price_scale))
    run.write(run.spark.createDataFrame([(load, day)], schemas.tables()["Loads"]), "Loads", add=True)
    return day


def last_stored_day(daily: DataFrame) -> dt.date:
    """The day of the last stored sale, from the newest month only."""
    month = F.col("Year") * 12 + F.col("Month")
    newest = daily.select(F.max(month)).scalar()
    return daily.where(month == newest).agg(F.max("Date")).first()[0] or dt.date.min


def _cleaned(stored: DataFrame, price_scale: int) -> DataFrame:
    """The cleaned sales, without lines in quarantine."""
    return stored.where(F.col("Reason").isNull()).select(schemas.tables(price_scale)["Cleaned_Sales"].fieldNames())


def read_silver(spark: SparkSession, root: str, price_scale: int = PRICE_SCALE) -> DataFrame:
    return _cleaned(read_table(spark, root, "Silver_Sales", price_scale), price_scale)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Lines that the loads did not understand or that came too late: which load, why, and their text."""
    stored = read_table(spark, root, "Silver_Sales").where(F.col("Ano").isNull() & F.col("Reason").isNotNull())
    return stored.select("Load", "Reason", "Line")


def read_wide(spark: SparkSession, root: str, price_scale: int = PRICE_SCALE) -> DataFrame:
    return read_table(spark, root, "Sales_Wide", price_scale)


def read_daily(spark: SparkSession, root: str, price_scale: int = PRICE_SCALE) -> DataFrame:
    """What ``plans.dashboard`` shows: totals per day, client, city, SKU and brand."""
    return read_table(spark, root, "Sales_Daily", price_scale)
